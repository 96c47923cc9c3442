import random

import numpy as np
import pyarrow as pa
import pytest
from llm_help import shingles

from farelight.llm import setsketch
from farelight.llm.setsketch import band_keys, joint_similarity, likely, merge_sketches, near_duplicates, sketch_sets


def brute(rows, width, percent):
    """(id, set size, smallest id reachable, kept) per row, from all pairs."""
    sets = [shingles(text, width) for _, text in rows]
    head = list(range(len(rows)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                head[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, ((doc_id, _), x) in enumerate(zip(rows, sets, strict=True)):
        component = least.get(find(i)) if x else doc_id
        out.append((doc_id, len(x), component, doc_id == component))
    return out


def near(seed, copies=(40, 30, 25)):
    """Copies of some texts with words changed: some link with each other, some with the first one only."""
    random.seed(seed)
    out = []
    for n, size, changes in zip(copies, (120, 60, 300), (3, 2, 9), strict=True):
        base = [f"w{random.randrange(5000)}" for _ in range(size)]
        out.append(" ".join(base))
        for _ in range(n):
            text = list(base)
            for _ in range(random.randint(0, changes)):
                text[random.randrange(size)] = f"x{random.randrange(10**6)}"
            out.append(" ".join(text))
    return out + out[:9] + ["", "one two", "one  two", "One TWO", "three"]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


# The usual way; all buckets in small blocks; the same with every block confirmed inside.
WAYS = [(setsketch.HOT, setsketch.BLOCK, setsketch.LOOSE), (2, 8, 4), (2, 8, -1)]


@pytest.mark.parametrize("hot,block,loose", WAYS)
def test_components_of_all_pairs(spark, monkeypatch, hot, block, loose):
    for name, value in (("HOT", hot), ("BLOCK", block), ("LOOSE", loose)):
        monkeypatch.setattr(setsketch, name, value)
    rows = list(enumerate(near(hot)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ordered(near_duplicates(docs, 5, 85).collect()) == ordered(brute(rows, 5, 85))


def test_second_round_fetches_texts_once(spark, monkeypatch):
    """Pairs of small buckets, of blocks and of dense blocks share one table of texts and are confirmed together."""
    written = []

    def write(df, name, write=setsketch.materialize):
        written.append(name)
        return write(df, name)

    for name, value in (("HOT", 2), ("BLOCK", 8), ("LOOSE", 0.01), ("materialize", write)):
        monkeypatch.setattr(setsketch, name, value)
    rows = list(enumerate(near(7)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ordered(near_duplicates(docs, 5, 85).collect()) == ordered(brute(rows, 5, 85))
    assert "block_links" in written
    assert written.count("texts") == written.count("links") == 2


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = [r[:2] for r in odd_rows]
    assert ordered(near_duplicates(odd_docs).collect()) == ordered(brute(rows, 5, 80))
    assert near_duplicates(no_docs).count() == 0


def pair(n, similarity, seed):
    common = round(2 * n * similarity / (1 + similarity))
    found = np.random.default_rng(seed).integers(0, 2**63, 2 * n - common, dtype=np.uint64)
    return np.sort(found[:n]), np.sort(found[n - common :])


def test_registers_by_definition():
    """The registers do not depend on the bound, on what else is sketched, or on how elements are cut into groups."""
    sets = [*pair(3, 0.5, 1), *pair(700, 0.5, 2), np.zeros(0, np.uint64), *pair(40_000, 0.9, 3)]
    whole = sketch_sets(sets)
    assert not whole[4].any()
    for i, s in enumerate(sets):
        assert (sketch_sets([s])[0] == whole[i]).all()
        parts = [sketch_sets([p])[0] for p in np.array_split(s, 3) if len(p)]
        merged = parts[0] if parts else whole[i]
        for p in parts[1:]:
            merged = merge_sketches(merged, p)
        assert (merged == whole[i]).all()


def test_small_groups_of_elements(monkeypatch):
    sets = [*pair(500, 0.5, 2), *pair(5, 0.5, 4)]
    whole = sketch_sets(sets)
    monkeypatch.setattr(setsketch, "ELEMENTS", 37)
    assert (sketch_sets(sets) == whole).all()


@pytest.mark.parametrize("n", [25, 400, 20_000])
@pytest.mark.parametrize("similarity", [0.5, 0.85, 0.95])
def test_estimate(n, similarity):
    found = [sketch_sets(list(pair(n, similarity, seed))) for seed in range(30)]
    true = np.mean([len(np.intersect1d(*p)) / len(np.union1d(*p)) for p in (pair(n, similarity, s) for s in range(30))])
    above, below = (np.array([(a > b).sum() for a, b in found]), np.array([(a < b).sum() for a, b in found]))
    best, _ = joint_similarity(np.full(30, n), np.full(30, n), above, below)
    assert abs(best.mean() - true) < 0.03
    kept, _ = likely(np.full(30, n), np.full(30, n), above, below, 85)
    assert kept.all() if similarity >= 0.85 else not kept.any()


def test_pairs_at_the_limit_share_a_band():
    for seed in range(150):
        keys = band_keys(sketch_sets(list(pair(200, 0.86, seed))))
        assert keys.shape == (2, 42) and (keys[0] == keys[1]).any()


def test_sizes_that_cannot_reach_the_similarity():
    a, b = np.sort(pair(100, 0.5, 1)[0]), np.sort(pair(200, 0.5, 1)[0])
    one, two = sketch_sets([a, b])
    kept, _ = likely(np.array([100]), np.array([200]), np.array([(one > two).sum()]), np.array([(one < two).sum()]), 85)
    assert not kept[0]


def test_blocks_give_spanning_links(monkeypatch):
    """A block returns fewer links than it has members, and they connect what all its links connect."""
    texts = near(5, (30, 0, 0))[:31]
    sets = [s for _, s in setsketch.words.shingle_sets(pa.array(texts), 5)]
    registers = sketch_sets(sets)
    names = [bytes([k]) for k in range(len(texts))]
    table = pa.table({
        "node": names, "label": names, "n": [len(s) for s in sets], "sketch": [r.astype("<u2").tobytes() for r in registers],
        "band": [0] * len(texts), "text": texts, "pair": [1] * len(texts),
    })
    found = setsketch._block_links(5, 85)(table).to_pylist()
    assert len(found) < len(texts)
    rows = list(enumerate(texts))
    head = {n: n for n in names}
    for link in found:
        a, b = sorted((link["a"], link["b"]))
        head = {k: (head[a] if v == head[b] else v) for k, v in head.items()}
    expected = {}
    for i, _, component, _ in brute(rows, 5, 85):
        expected.setdefault(component, set()).add(names[i])
    got = {}
    for k, v in head.items():
        got.setdefault(v, set()).add(k)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))
