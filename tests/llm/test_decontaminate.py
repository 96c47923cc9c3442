import random

import pytest
from llm_help import ALNUM, shingles

from farelight.llm import decontaminate


def brute(docs, items, width=5, percent=80):
    out = []
    for i, text in docs:
        whole = shingles(text, width, ALNUM)
        for j, item in items:
            wanted = shingles(item, width, ALNUM)
            common = len(wanted & whole)
            if wanted and 100 * common >= percent * len(wanted):
                out.append((i, j, len(wanted), common))
    return sorted(out, key=str)


def made(seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(random.choices(vocabulary, k=random.choice([1, 3, 5, 9, 20, 60])))) for k in range(40)] + [(40, ""), (41, None), (5, "a b c d e f")]
    docs = []
    for i in range(150):
        body = random.choices(vocabulary, k=random.choice([0, 2, 30, 400]))
        for _ in range(random.randint(0, 2)):
            item = (random.choice(items)[1] or "").split()
            item = [w if random.random() > 0.03 else "other" for w in item]
            at = random.randint(0, len(body))
            body[at:at] = item
        docs.append((i, random.choice([" ", ", ", "\n"]).join(body).upper() if i % 9 == 0 else " ".join(body)))
    return docs + [(None, items[3][1]), (7, items[4][1]), (7, items[4][1])], items


@pytest.mark.parametrize("block", [decontaminate.BLOCK_SHINGLES, 100])
def test_all_leaks_and_no_other(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", block)
    docs, items = made(3)
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(d, b)
    rows = sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_common"]) for r in found.collect()), key=str)
    assert rows == brute(docs, items) and len(rows) > 20
    assert all(r["containment"] == r["n_common"] / r["n_shingles"] for r in found.collect())
    kept = sorted((tuple(r) for r in decontaminate.remove_leaks(d, b).collect()), key=str)
    assert kept == sorted((r for r in docs if not brute([r], items)), key=str)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    items = spark.createDataFrame([(1, "the same text for two ids and more"), (None, "word7 straße word8 straße word9"), (3, None)], "item_id long, text string")
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(odd_docs, items).collect()]
    assert sorted(found, key=str) == sorted([(4, 1)] * 3 + [(5, 1), (6, None)], key=str)
    left = decontaminate.remove_leaks(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == len(odd_rows) - 5
    assert decontaminate.find_leaks(no_docs, items).count() == 0
    assert decontaminate.find_leaks(odd_docs, items.limit(0)).count() == 0
    assert decontaminate.remove_leaks(odd_docs, items.limit(0)).count() == len(odd_rows)
