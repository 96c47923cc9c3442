import hashlib

import numpy as np
import pytest
from llm_help import SPACED

from farelight.llm import mixing


def filled(sizes, weights, share=1.5, most=2):
    """Targets by the rule itself: cut what is above its limit, share that again by weight, until none is above."""
    total, capped = share * sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        open_ = [i for i in range(len(sizes)) if i not in capped]
        per = rest / sum(weights[i] for i in open_) if open_ else 0
        over = [i for i in open_ if weights[i] * per > most * sizes[i]]
        if not over:
            return [most * s if i in capped else weights[i] * per for i, s in enumerate(sizes)]
        capped.update(over)


@pytest.mark.parametrize("sizes", [[10], [100, 1, 1, 1], [0, 5, 0, 7], [1, 1000, 30, 500, 2, 77, 0], [0, 0], [50] * 20])
def test_targets(spark, sizes):
    rows = [(f"s{i:03d}", s) for i, s in enumerate(sizes)]
    found = mixing.source_targets(spark.createDataFrame(rows, "_source string, source_size long")).orderBy("_source").collect()
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    assert [r["target"] for r in found] == pytest.approx(filled(sizes, weights))


def expected_takes(rows):
    """(id, size, source size, taken) with each source laid out in the order of its hash."""
    sized = [(i, s, len(SPACED.findall(t or ""))) for i, t, s in rows]
    sources = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    totals = [sum(n for _, s, n in sized if s == source) for source in sources]
    targets = filled(totals, [mixing.WEIGHTS[k % 3] for k in range(len(sources))])
    out = []
    for source, total, target in zip(sources, totals, targets, strict=True):
        ids = {i for i, s, _ in sized if s == source}
        order = sorted(ids, key=lambda i: (int(hashlib.md5(f"{mixing.SEED}-{'' if i is None else i}".encode()).hexdigest()[:8], 16), i is not None, i))
        start = 0
        for i in order:
            own = [n for j, s, n in sized if s == source and j == i]
            times = sum(start + total * p + sum(own) / 2 < target for p in range(2))
            out += [(i, n, total, n * times) for n in own]
            start += sum(own)
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    mix = mixing.Mix(odd_docs)
    found = [(r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in mix.takes().collect()]
    assert sorted(found, key=key) == sorted(expected_takes([(r[0], r[1], r[3]) for r in odd_rows]), key=key)
    assert mix.rows().columns == odd_docs.columns
    assert mixing.Mix(no_docs).takes().count() == 0 and mixing.Mix(no_docs).rows().count() == 0


def test_rows_are_those_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mix = mixing.Mix(docs, shard_words=4000)
    times = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else None for r in mix.takes().collect()}
    rows = mix.rows()
    found = {}
    for r in rows.collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
    assert all(found.get(i, 0) == n for i, n in times.items() if n is not None)
    again = [r["doc_id"] for r in mixing.Mix(docs.repartition(5), shard_words=4000).rows().collect()]
    assert [r["doc_id"] for r in rows.collect()] == again


def test_rows_without_words_are_taken(spark):
    blank = [(i, [None, "", " \t"][i % 3], ["b", None][i % 2]) for i in range(20)]
    rows = [*blank, *[(i, "some words here" if i % 3 else "", "a") for i in range(100, 160)]]
    for part in (rows, blank):
        mix = mixing.Mix(spark.createDataFrame(part, "doc_id long, text string, source string"), shard_words=20)
        found = [r["doc_id"] for r in mix.rows().collect()]
        assert sorted(i for i in found if i < 100) == list(range(20))
    # Rows of a source with words, by the rule itself.
    docs = [(i, "w " * (i % 4), s) for i, s in enumerate("ab" * 60)]
    mix = mixing.Mix(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    found = [r["doc_id"] for r in mix.rows().collect()]
    targets = {r["_source"]: (r["source_size"], r["target"]) for r in mix.targets.collect()}
    for source, (total, target) in targets.items():
        own = sorted((int(hashlib.md5(f"{mixing.SEED}-{i}".encode()).hexdigest()[:8], 16), i, i % 4) for i, _, s in docs if s == source)
        start = 0
        for _, i, n in own:
            times = sum(start + total * p + n / 2 < target or (p == 0 and n == 0 and start == target) for p in range(2))
            assert found.count(i) == times, (source, i)
            start += n


def test_quotas_add_up_and_are_drawn_fairly():
    blocks = np.array([400, 3, 0, 77, 120])
    for shards in (1, 2, 5, 16):
        quotas = mixing.split_quotas(blocks, shards)
        assert (quotas.sum(axis=0) == blocks).all() and (quotas >= 0).all()
        assert np.ptp(quotas.sum(axis=1)) <= 1
    # A shard's share of a source follows the hypergeometric mean.
    drawn = np.mean([mixing.split_quotas(blocks, 4, seed)[0, 0] for seed in range(200)])
    assert drawn == pytest.approx(100, abs=2)


def test_runs_are_the_quotas(spark):
    """Subtrees split by tasks give what one loop gives, and runs of a source follow each other."""
    blocks = np.array([4000, 3, 0, 77, 1200])
    for shards in (1, 3, 150):
        quotas = mixing.split_quotas(blocks, shards, 5)
        runs = sorted(tuple(r) for r in mixing.split_runs(spark, blocks, shards, 5, subtrees=8).collect())
        found = np.zeros_like(quotas)
        ends = [0] * len(blocks)
        for shard, source, low, high in runs:
            found[shard, source - 1] = high - low
            assert low == ends[source - 1]
            ends[source - 1] = high
        assert (found == quotas).all() and ends == blocks.tolist()
    assert mixing.split_runs(spark, np.zeros(0, dtype=np.int64), 1).count() == 0


@pytest.mark.parametrize("cell_rows,span", [(mixing.CELL_ROWS, mixing.SPAN), (3, 7)])
def test_shards_hold_their_quotas(spark, monkeypatch, cell_rows, span):
    """Words of a source in a shard: those of its blocks, up to a document at each end of a block; seeds change the shards alone."""
    monkeypatch.setattr(mixing, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(mixing, "SPAN", span)
    rows = [(i, "w " * (i * 7 % 50), "abc"[i % 5 % 3]) for i in range(1500)] + [(None, "w w w", "a"), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    held = {}
    for seed in (1, 2):
        mix = mixing.Mix(docs, shard_words=3000, seed=seed)
        found = mix.places().collect()
        owners = {(r["rank"], r["number"]): r["shard"] for r in mix.owners().collect()}
        targets = {r["_source"]: r for r in mix.targets.collect()}
        quotas = mixing.split_quotas(np.array([targets[s]["blocks"] for s in ("a", "b", "c", None)]), mix.shards, seed)
        words = {}
        for r in found:
            assert owners[targets[r["source"]]["rank"], r["block"]] == r["shard"]
            words[r["shard"], r["source"]] = words.get((r["shard"], r["source"]), 0) + r["size"]
        for source, t in targets.items():
            numbers = {b: s for (rank, b), s in owners.items() if rank == t["rank"]}
            assert sorted(numbers) == list(range(t["blocks"]))
            for shard in range(mix.shards):
                own = [b for b, s in numbers.items() if s == shard]
                assert len(own) == quotas[shard, t["rank"] - 1]
                # The last block of a source may be cut short by the target.
                want = sum(min(mix.block, max(0, t["target"] - b * mix.block)) for b in own)
                assert abs(words.get((shard, source), 0) - want) <= 50 * max(1, len(own))
        assert all(sorted(r["position"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found))) for s in range(mix.shards))
        held[seed] = sorted(((r["doc_id"] is None, r["doc_id"]), r["pass"], r["block"]) for r in found), {(r["doc_id"], r["pass"]): r["shard"] for r in found}
    assert held[1][0] == held[2][0] and held[1][1] != held[2][1]


def test_many_cells_do_not_change_the_takes(spark, monkeypatch, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few = sorted(map(tuple, mixing.Mix(docs).takes().collect()))
    monkeypatch.setattr(mixing, "CELL_ROWS", 2)
    assert sorted(map(tuple, mixing.Mix(docs, shard_words=500).takes().collect())) == few


def test_registered_shards(spark, sf_dir):
    found = mixing.mixing_shards(spark, sf_dir).collect()
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.op3_mixing_sources(spark, sf_dir).collect()}
    words = {}
    for r in found:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + r["size"]
    assert words == {i: t for i, (_, t) in taken.items() if i in words} and all(not t for i, (_, t) in taken.items() if i not in words)


def test_taken_words_come_near_the_target(spark):
    takes = mixing.op3_mixing_sources(spark, "/root/testdata/sf0.01").toPandas()
    assert (takes.taken <= 2 * takes["size"]).all()
    for (size, target), rows in takes.groupby(["source_size", "target"]):
        assert abs(rows.taken.sum() - target) <= rows["size"].max() / 2 + 1
