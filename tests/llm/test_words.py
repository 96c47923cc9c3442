import random

import numpy as np
import pyarrow as pa
from llm_help import ALNUM, SPACED, shingles

from farelight.llm import words


def texts(n=800):
    random.seed(1)
    out = [None, "", " ", "\n\t", "é"]
    parts = ["A", "bé", "CC", "dd!", "ü", "AbC", "a-b", "7x"]
    for _ in range(n):
        gap = random.choice([" ", "  ", "\t", "\x0b"])
        out.append(random.choice(["", " "]) + gap.join(random.choices(parts, k=random.choice([1, 2, 3, 4, 5, 30]))) + random.choice(["", "\n"]))
    return out


def test_shingle_sets_are_those_of_the_definition(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 500)
    for letters, pattern in ((words.SPACED, SPACED), (words.ALNUM, ALNUM)):
        for width in (1, 4, 5):
            forward, back = {}, {}
            given = texts()
            found = dict(words.shingle_sets(pa.array(given), width, letters))
            assert sorted(found) == list(range(len(given)))
            for i, text in enumerate(given):
                expected = frozenset(shingles(text, width, pattern))
                assert len(found[i]) == len(expected)
                assert forward.setdefault(expected, found[i].tobytes()) == found[i].tobytes()
                assert back.setdefault(found[i].tobytes(), expected) == expected


def test_no_word_reaches_into_the_next_text():
    found = dict(words.shingle_sets(pa.array(["a b", "c d e f"]), 4))
    alone = dict(words.shingle_sets(pa.array(["c d e f"]), 4))
    assert np.array_equal(found[1], alone[0]) and len(found[0]) == 1


def test_no_rows():
    assert dict(words.shingle_sets(pa.array([], pa.string()), 4)) == {}
