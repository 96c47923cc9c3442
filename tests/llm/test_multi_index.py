import numpy as np
import pytest
from pyspark.sql import functions as F

from farelight.llm import multi_index


def exact(ids, vectors, queries, k=5):
    out = {}
    for q in queries:
        scores = sorted(
            (-float(np.dot(vectors[q], v) / np.sqrt(np.dot(vectors[q], vectors[q]) * np.dot(v, v))), i)
            for i, v in zip(ids, vectors, strict=True) if i != ids[q]
        )
        out[ids[q]] = [i for _, i in scores[:k]]
    return out


def test_cells_come_by_summed_distance():
    rng = np.random.default_rng(1)
    one, two = rng.random(7), rng.random(9)
    order = list(multi_index.cells_by_distance(one, two))
    sums = [one[i] + two[j] for i, j in order]
    assert sums == sorted(sums) and len(set(order)) == 63


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_small_tables_are_searched_whole(spark, name):
    found = multi_index.op8_approximate_neighbours(spark, f"/root/testdata/{name}").toPandas()
    rows = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet").toPandas()
    ids, vectors = rows.vec_id.tolist(), [np.array(v, dtype=float) for v in rows.embedding]
    wanted = exact(ids, vectors, [i for i, v in enumerate(ids) if v % 50 == 0])
    for query, group in found.groupby("query_id"):
        group = group.sort_values("rank")
        assert group.vec_id.tolist() == wanted[query] and group["rank"].tolist() == [1, 2, 3, 4, 5]
    assert found.query_id.nunique() == len(wanted)


def test_recall_when_only_a_share_is_visited(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = multi_index.nearest(rows, F.col("vec_id") % 50 == 0, least_visited=1).toPandas()
    table = rows.toPandas()
    ids, vectors = table.vec_id.tolist(), [np.array(v, dtype=float) for v in table.embedding]
    wanted = exact(ids, vectors, [i for i, v in enumerate(ids) if v % 50 == 0])
    got = found.groupby("query_id").vec_id.apply(set)
    hits = sum(len(got[q] & set(w)) for q, w in wanted.items())
    assert hits / sum(map(len, wanted.values())) >= 0.9


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [3.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]),
        (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]), (9, [inf, 0.0, 0.0]), (10, [1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (50, [-1.0, 0.0, 0.0]),
        (100, None), (11, [1.0, 0.0, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [1e-200, 0.0, 1e-200]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "cell", "asks", "score")})
    found = multi_index.nearest(vectors, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    first = [(r["vec_id"], round(r["score"], 6)) for r in found if r["query_id"] == 0]
    assert first[:4] == [(1, 1.0), (2, 1.0), (11, 1.0), (11, 1.0)]
    assert {r["query_id"] for r in found} == {0, 50} and {r["vec_id"] for r in found} <= {0, 1, 2, 3, 11, 12, 50}
    assert multi_index.nearest(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    two = vectors.filter("vec_id in (0, 3)")
    assert [(r["query_id"], r["vec_id"]) for r in multi_index.nearest(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 3)]
