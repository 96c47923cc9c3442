"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length one and cut into two halves, and each half is quantised by its own codebook. A pair
of centroids is a cell. A query goes through the cells by the sum of its two squared distances, from a heap
over the two sorted lists of centroids, until the cells it has seen hold a share of all entries; these entries are
reranked by the cosine of the original vectors.

Codebooks are fitted on a bounded sample; every vector is indexed. The index is a table in the order of its cells, and
range partitions split a hot cell. Queries are taken in blocks of a bounded number, each sent to all tasks; a
task computes a cell only for the queries that reach it and keeps the best entries of each query.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelight.llm.tables import batch_map
from farelight.session import materialize

#: Vectors the codebooks are fitted on, those of the smallest hashes, and rounds of fitting.
FIT_ROWS = 16_384
FIT_ROUNDS = 12
#: Centroids of a codebook.
CENTROIDS = 64
#: Entries in the cells a query goes through: this share of all, and at least so many.
VISITED = 0.45
LEAST_VISITED = 2_000
#: Queries of a block.
BLOCK_QUERIES = 4_096


def usable(vector: Column) -> Column:
    """Not null, not empty, without null or non-finite components, not zero."""
    limit = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither overflow nor vanish; cosines stay the same bit by bit."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one."""
    rows = _scaled(rows)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(axis=1)[:, None] - 2 * rows @ centroids.T + (centroids * centroids).sum(axis=1)


def codebook(rows: np.ndarray, k: int, rounds: int = FIT_ROUNDS, seed: int = 3) -> np.ndarray:
    """Lloyd's algorithm from distinct rows."""
    rows = np.unique(rows, axis=0)
    rng = np.random.Generator(np.random.PCG64(seed))
    centroids = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        nearest = _squared(rows, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        n = np.bincount(nearest, minlength=len(centroids))
        centroids[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centroids


def _halves(dimension: int) -> tuple[slice, slice]:
    middle = max(1, dimension // 2)
    return slice(0, middle), slice(middle, dimension)


def _assign(books):
    def run(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column(1))) if batch.num_rows else np.zeros((0, 1))
            first, second = _halves(unit.shape[1])
            if batch.num_rows:
                cell = _squared(unit[:, first], books[0]).argmin(axis=1) * len(books[1]) + _squared(unit[:, second], books[1]).argmin(axis=1)
            else:
                cell = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32))], names=["id", "vector", "cell"])

    return run


def cells_by_distance(one: np.ndarray, two: np.ndarray):
    """Pairs (i, j) in the order of one[i] + two[j], from a heap over both sorted lists."""
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    heap = [(float(one[a[0]] + two[b[0]]), 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        # Each pair has one predecessor: to the left in its row, or above it in the first column.
        if j + 1 < len(b):
            heapq.heappush(heap, (float(one[a[i]] + two[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (float(one[a[i + 1]] + two[b[0]]), i + 1, 0))


def _traverse(books, counts: np.ndarray, wanted: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column(1)))
            first, second = _halves(unit.shape[1])
            one, two = _squared(unit[:, first], books[0]), _squared(unit[:, second], books[1])
            visits = []
            for x, y in zip(one, two, strict=True):
                seen, held = np.zeros(len(counts), dtype=bool), 0
                for i, j in cells_by_distance(x, y):
                    cell = i * len(books[1]) + j
                    seen[cell] = True
                    held += counts[cell]
                    if held >= wanted:
                        break
                visits.append(np.packbits(seen).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(visits, pa.binary())], names=["id", "vector", "visits"])

    return run


def _rerank(sent, k: int):
    def run(batches):
        ids, vectors, visits = sent.value
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        best = np.full((len(ids), k), -np.inf)
        names = np.full((len(ids), k), np.iinfo(np.int64).max)
        for batch in batches:
            if not batch.num_rows:
                continue
            entry, rows, cell = batch.column(0).to_numpy(), _scaled(_matrix(batch.column(1))), batch.column(2).to_numpy()
            lengths = np.sqrt((rows * rows).sum(axis=1))
            score = np.full((len(ids), len(entry)), -np.inf)
            for c in np.unique(cell):
                here, asking = np.flatnonzero(cell == c), np.flatnonzero(visits[:, c])
                if len(asking):
                    # Sums in one order for all pairs, so that equal vectors have equal scores.
                    dots = np.einsum("qd,rd->qr", vectors[asking], rows[here])
                    score[np.ix_(asking, here)] = dots / (norms[asking][:, None] * lengths[here])
            score[ids[:, None] == entry[None, :]] = -np.inf
            for q in np.flatnonzero((score >= best[:, -1:]).any(axis=1) & (score.max(axis=1) > -np.inf)):
                new = np.flatnonzero((score[q] >= best[q, -1]) & (score[q] > -np.inf))
                both, who = np.concatenate([best[q], score[q, new]]), np.concatenate([names[q], entry[new]])
                order = np.lexsort((who, -both))[:k]
                best[q], names[q] = both[order], who[order]
        kept = best > -np.inf
        query = np.repeat(ids, kept.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(names[kept]), pa.array(best[kept])], names=["query_id", "vec_id", "score"])

    return run


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    centroids: int = CENTROIDS, visited: float = VISITED, least_visited: int = LEAST_VISITED,
) -> DataFrame:
    """The k entries of largest cosine found for each row that ``queries`` (a condition) selects, but for rows of its own id.

    Returns query_id, rank from 1, vec_id, score; ties go to the smaller id, and all entries if there are fewer.
    Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do those
    without an id or of another length than most (the longer one of equally many). Rows that share an id are entries of
    their own, and such queries are asked once for each distinct vector. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"), queries.alias("asks")
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = materialize(rows, "vectors")
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return empty
    rows = rows.filter(F.size("vector") == lengths.d)
    sample = rows.orderBy(F.xxhash64("vector"), "id").limit(FIT_ROWS).select("vector").toArrow()
    unit = _unit(_matrix(sample.column("vector").combine_chunks()))
    books = [codebook(unit[:, half], centroids) if unit[:, half].shape[1] else np.zeros((1, 0)) for half in _halves(lengths.d)]
    assigned = batch_map(rows.select("id", "vector"), _assign(books), "id long, vector array<double>, cell int")
    index = materialize(assigned.repartitionByRange(F.col("cell"), F.xxhash64("id")).sortWithinPartitions("cell"), "index")
    counts = np.zeros(len(books[0]) * len(books[1]), dtype=np.int64)
    for row in index.groupBy("cell").count().collect():
        counts[row.cell] = row["count"]
    wanted = int(max(least_visited, visited * counts.sum()))
    asked = rows.filter("asks").select("id", "vector").distinct()
    asked = materialize(batch_map(asked, _traverse(books, counts, wanted), "id long, vector array<double>, visits binary"), "queries")
    blocks = -(-asked.count() // BLOCK_QUERIES)
    found = None
    for b in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)) == b).orderBy("id", "vector").toArrow()
        if not block.num_rows:
            continue
        ids = block.column("id").to_numpy()
        matrix = _scaled(_matrix(block.column("vector").combine_chunks()))
        visits = np.unpackbits(np.frombuffer(b"".join(block.column("visits").to_pylist()), np.uint8).reshape(len(ids), -1), axis=1)
        sent = spark.sparkContext.broadcast((ids, matrix, visits[:, : len(counts)].astype(bool)))
        part = batch_map(index, _rerank(sent, k), "query_id long, vec_id long, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return empty
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_approximate_neighbours(spark, sf_dir):
    """The five nearest found of every vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 50 == 0)
