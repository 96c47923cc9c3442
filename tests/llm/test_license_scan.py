import random

import pyarrow as pa
from llm_help import ALNUM, lowered

from farelight.llm import license_scan


def places(text):
    words = ALNUM.findall(lowered(text))
    found = []
    for phrase, label in license_scan.PHRASES:
        phrase = phrase.split()
        found += [(i, label) for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def mixed_texts():
    random.seed(8)
    pieces = [p for p, _ in (*license_scan.PHRASES, *license_scan.TEMPLATES)] + ["foo", "the", "of", "MIT", "License.", "GNU General", "é", "cc-by"]
    return [" ".join(random.choices(pieces, k=random.randint(0, 12))) for _ in range(400)] + ["", None, "Apache  LICENSE apache\nlicense"]


def test_places_of_phrases():
    texts = mixed_texts()
    for text, found in zip(texts, license_scan.Matcher().scan(pa.array(texts)), strict=True):
        assert found[:5] == places(text)
        assert set(filter(None, found[4].split(","))) <= set(filter(None, found[5].split(","))) and 0 <= found[6] <= 1


def test_matches_are_the_longest():
    matcher = license_scan.Matcher()
    random.seed(2)
    for _ in range(60):
        numbers = []
        for _ in range(4):
            template = random.choice(matcher.templates)
            at = random.randrange(len(template))
            numbers += template[at : at + random.randint(1, 9)]
        longest = []
        for end in range(1, len(numbers) + 1):
            held = 0
            while held < end and any(
                t[i : i + held + 1] == numbers[end - held - 1 : end] for t in matcher.templates for i in range(len(t) - held)
            ):
                held += 1
            longest.append(held)
        # A match ends where the next word does not make it longer.
        expected = [
            (end, held) for end, held in enumerate(longest)
            if held >= license_scan.MIN_MATCH and (end + 1 == len(longest) or longest[end + 1] <= held)
        ]
        assert [(end, held) for end, held, _ in matcher.stream(numbers, 0)] == expected


def labels(text):
    return next(license_scan.Matcher().scan(pa.array([text])))[5:]


def test_whole_notices_get_their_label():
    for template, label in license_scan.TEMPLATES:
        found, score = labels(f"zzz {template.capitalize()}, zzz")
        assert label in found.split(",") and score == 1.0


def test_chains_bridge_changed_words_and_drop_stray_ones():
    text = "Permission is hereby granted, free of charge, to any PERSON OR BODY obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"
    assert labels(text)[0] == "mit" and labels(text)[1] > 0.8
    assert labels("free of charge and a copy of the license")[0] == ""
    assert labels("Licensed under CC BY-NC 4.0.")[0] == "cc-by,cc-by-nc"


def test_odd_rows(odd_docs, odd_rows, no_docs):
    found = license_scan.scan_licenses(odd_docs).collect()
    assert len(found) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in found}
    assert tuple(by_id[1])[1:] == (0, 0, None, None, "", "", 0.0) and by_id[6]["n_words"] == 120_000
    assert license_scan.scan_licenses(no_docs).count() == 0


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in license_scan.op4_license_scan(spark, sf_dir).collect():
        assert tuple(r)[1:6] == places(texts[r["doc_id"]])
