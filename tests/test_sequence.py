import hashlib
import random

import pytest
from pyspark.sql import functions as F

from farelight.operators import sequence, stats


def test_running_values_across_blocks(spark):
    random.seed(7)
    values = [(g, i, random.randint(0, 1000)) for g in ("a", "b") for i in range(300)]
    rows = spark.createDataFrame(values, "g string, i int, v int").repartition(5)
    got = sequence.running_before(
        rows, F.floor(F.col("i") / 7), ["i"], {"s": ("sum", F.col("v")), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))}, ("g",)
    ).collect()
    for r in got:
        before = [v for g, i, v in values if g == r["g"] and i < r["i"]]
        assert r["s"] == sum(before)
        assert r["hi"] == (max(before) if before else None) and r["lo"] == (min(before) if before else None)
    assert len(got) == len(values)


@pytest.mark.parametrize("bound", [10, 50])
def test_running_values_over_a_tree_of_blocks(spark, monkeypatch, bound):
    monkeypatch.setattr(sequence, "BLOCKS_PER_RANGE", bound)
    sizes, write = [], sequence.materialize
    monkeypatch.setattr(sequence, "materialize", lambda df, name: sizes.append(write(df, name)) or sizes[-1])
    random.seed(bound)
    values = [(g, i, random.randint(-50, 1000)) for g, n in (("a", 300), ("b", 3), (None, 1)) for i in range(n) if random.random() < 0.9]
    rows = spark.createDataFrame(values, "g string, i int, v int").repartition(5)
    kinds = {"s": ("sum", F.col("v")), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))}
    for by in (("g",), ()):
        some = [r for r in values if by and r[0] is not None or r[0] == "a"]
        sizes.clear()
        kept = rows.filter("g is not null" if by else "g = 'a'")
        got = sequence.running_before(kept, F.floor(F.col("i") / 2), ["i"], kinds, by).collect()
        assert len(got) == len(some)
        for r in got:
            before = [v for g, i, v in some if g == r["g"] and i < r["i"]]
            assert (r["s"], r["hi"], r["lo"]) == (sum(before), max(before, default=None), min(before, default=None))
        # Every level but the last is cut into ranges of a bounded number of blocks.
        assert len(sizes) >= (2 if bound == 10 else 1)
        for level in sizes:
            assert level.groupBy(level.columns[-1]).count().agg(F.max("count")).first()[0] <= 2 * bound


def test_file_index_over_many_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sequence, "BLOCKS_PER_RANGE", 4)
    spark.range(0, 97, 1, 20).write.parquet(str(tmp_path / "t"))
    rows = sequence.file_row_index(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert sorted(r["row_index"] for r in rows) == list(range(97))


def history(spark, rmses):
    return spark.createDataFrame([(i, float(r)) for i, r in enumerate(rmses, 1)], "chunk_id bigint, rmse double")


def test_patience_as_logged(spark):
    scores = history(spark, [9, 8, 7, 6, 7, 7, 7, 7, 7, 7])
    wrapped = [r["patience"] for r in sequence.patience_counter(scores, wrap=5).orderBy("chunk_id").collect()]
    assert wrapped == [0, 0, 0, 0, 1, 2, 3, 4, 0, 1]
    plain = [r["patience"] for r in sequence.patience_counter(scores).orderBy("chunk_id").collect()]
    assert plain == [0, 0, 0, 0, 1, 2, 3, 4, 5, 6]
    grown = [r["growth_step"] for r in sequence.growth_steps(scores).orderBy("chunk_id").collect()]
    assert grown == [0, 0, 0, 0, 0, 0, 0, 0, 1, 1]


def loop_steps(rmses):
    """Growth steps chunk by chunk: patience is looked at before the fit, and counts chunks since the last best."""
    best, patience, step, steps = float("inf"), 0, 0, []
    for number, rmse in enumerate(rmses):
        if number and patience >= 5:
            patience, step = 0, step + 1
        if rmse < best:
            best, patience = rmse, 0
        patience += 1
        steps.append(step)
    return steps


def test_growth_when_a_chunk_improves_as_patience_runs_out(spark):
    rmses = [10, 11, 11, 11, 11, 9, 12, 12]
    grown = [r["growth_step"] for r in sequence.growth_steps(history(spark, rmses)).orderBy("chunk_id").collect()]
    assert grown == [0, 0, 0, 0, 0, 1, 1, 1] == loop_steps(rmses)


def test_growth_follows_the_loop(spark):
    random.seed(3)
    for _ in range(4):
        level, rmses = 100.0, []
        for _ in range(40):
            improves = not rmses or random.random() < 0.15
            level = level - 1 if improves else level
            rmses.append(level if improves else level + 5)
        grown = [r["growth_step"] for r in sequence.growth_steps(history(spark, rmses)).orderBy("chunk_id").collect()]
        assert grown == loop_steps(rmses)


def test_shuffle_blocks_follow_the_rows():
    assert sequence.block_digits(0) == sequence.block_digits(10) == 1
    for rows in (10**7, 10**8, 10**9, 10**12):
        assert rows / 16 ** sequence.block_digits(rows) <= sequence.ROWS_PER_BLOCK


def test_improvement_needs_a_strictly_lower_score(spark):
    rows = sequence.improvement_pct(history(spark, [10, 10, 8, 8, 9, 5])).orderBy("chunk_id").collect()
    assert [r["percentage_improvement"] for r in rows] == [0.0, 0.0, 20.0, 0.0, 0.0, 50.0]
    assert stats.best_score(sequence.improvement_pct(history(spark, [10, 5, 5]))).first()["chunk_id"] == 2


def test_never_improving(spark):
    rows = sequence.improvement_pct(history(spark, [1, 2, 3]))
    assert stats.nonzero_improvement(rows).count() == 0


def test_checkpoints_only_rise(spark):
    pages = spark.createDataFrame([(0, 5), (1, 3), (2, 5), (3, 9), (4, 8)], "page_id int, max_date int")
    assert sorted(r["page_id"] for r in sequence.running_max_checkpoint(pages).collect()) == [0, 3]


def test_file_index_over_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 7).write.parquet(path)
    scan = spark.read.parquet(path)
    rows = sequence.file_row_index(scan).collect()
    assert sorted(r["row_index"] for r in rows) == list(range(1000))
    chunks = sequence.row_index_chunks(scan, 300).groupBy("chunk_id").count().collect()
    assert {tuple(r) for r in chunks} == {(1, 300), (2, 300), (3, 300), (4, 100)}
    plan = sequence.row_index_chunks(scan, 300)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(id" not in plan


def test_shuffled_index_with_many_copies(spark):
    rows = spark.createDataFrame([("hot",)] * 1000 + [(str(i),) for i in range(500)], "k string")
    got = sequence.shuffled_index(rows, ["k"], slice_rows=64, digits=1).collect()
    assert sorted(r["row_index"] for r in got) == list(range(1500))
    hot = sorted(r["row_index"] for r in got if r["k"] == "hot")
    assert len(hot) == 1000 and hot[-1] - hot[0] == 999
    again = sequence.shuffled_index(rows, ["k"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    other = sequence.shuffled_index(rows, ["k"], seed=1).collect()
    assert sorted(map(tuple, got)) != sorted(map(tuple, other))


def test_exact_split_size(spark):
    indexed = spark.range(103).withColumnRenamed("id", "row_index")
    assert sequence.exact_split(indexed, 0.2).filter("is_train").count() == 21


def test_hash_split_and_folds(spark):
    rows = spark.range(20000)
    share = sequence.hash_split(rows, ["id"], 0.2).filter("is_train").count() / 20000
    assert abs(share - 0.2) < 0.02
    folds = sequence.kfold_assign(rows, ["id"]).groupBy("fold").count().collect()
    assert len(folds) == 10 and all(abs(r["count"] - 2000) < 300 for r in folds)


def test_page_slice(spark):
    indexed = spark.range(100).withColumnRenamed("id", "row_index")
    assert [r[0] for r in sequence.page_slice(indexed, 10, 3).orderBy("row_index").collect()] == [10, 11, 12]


def test_shuffle_is_counted_and_stored_once(spark):
    """What the numbers are made of is read from a table: the rows are not aggregated again."""
    rows = spark.range(300).select((F.col("id") % 90).cast("string").alias("k"), F.lit(1.5).alias("v"))
    indexed = sequence.shuffled_index(rows, ["k"], seed=7)
    files = indexed.inputFiles()
    assert files and all("/counted-" in f for f in files)
    digests = sorted((hashlib.md5(f"{r['k']}|7".encode()).hexdigest(), r["k"]) for r in rows.collect())
    assert [r["k"] for r in indexed.orderBy("row_index").collect()] == [k for _, k in digests]


def test_exact_split_reads_a_stored_index(spark):
    rows = spark.range(90).select(F.col("id").cast("string").alias("k"))
    split = sequence.exact_split(sequence.shuffled_index(rows, ["k"]), 0.2)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and split.filter("is_train").count() == 19
