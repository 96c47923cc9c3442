"""Benchmark decontamination by size-partitioned MinHash containment search.

A benchmark item leaks into a document when at least a given percentage of the item's word shingles occur
anywhere in the document. Long documents make the Jaccard similarity of such pairs tiny, so the search is
for containment, from the items' side:

* Items are partitioned by size, a power of two per partition. An item with n shingles keeps the
  n - ceil(c * n) + 1 smallest hashes of its shingles as MinHash sketch. A document with the containment c
  lacks fewer shingles than that, so it holds at least one hash of the sketch: the search misses nothing.
* Hashes of a document beyond the largest sketch value of a partition are not looked up in it.
* Every hit is verified with the whole sets of the item and of the document.

Items are taken in blocks of a bounded number of shingles, so what is sent to the executors is bounded;
documents are read once per block and never shuffled.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelight.llm import words
from farelight.llm.tables import batch_map, documents
from farelight.session import materialize

#: A block of items has at most about so many shingles (8 bytes each); larger benchmarks make more blocks.
BLOCK_SHINGLES = 2_000_000

_FILTER_BITS = 22


def _block(ids: list, sets: list[np.ndarray], percent: int) -> SimpleNamespace:
    """Items by size class: their sketches as sorted hashes with the item each one is of, and a filter of these hashes."""
    classes: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        classes.setdefault(int(len(s)).bit_length(), []).append(i)
    partitions = []
    known = np.zeros(1 << _FILTER_BITS, dtype=bool)
    for members in classes.values():
        sketches = [sets[i][: len(sets[i]) - -(-percent * len(sets[i]) // 100) + 1] for i in members]
        hashes, owners = np.concatenate(sketches), np.repeat(members, [len(s) for s in sketches])
        order = np.argsort(hashes, kind="stable")
        partitions.append(SimpleNamespace(hashes=hashes[order], items=owners[order]))
        known[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return SimpleNamespace(ids=ids, sets=sets, partitions=partitions, known=known)


def _leaks(texts: pa.Array, block: SimpleNamespace, width: int, percent: int):
    """(row, item, common) of all leaks into these texts."""
    with np.errstate(over="ignore"):
        for row, end, data, offsets in words.text_slices(texts):
            data = words.lower(data)
            starts, ends, first = words.word_spans(data, offsets, words.ALNUM)
            hashes, begin = words.shingle_hashes(words.word_hashes(data, starts, ends), first, width)
            at = np.flatnonzero(block.known[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            owners = np.searchsorted(begin, at, side="right") - 1
            hits = set()
            for part in block.partitions:
                low = hashes[at] <= part.hashes[-1]
                here, of = hashes[at][low], owners[low]
                left = np.searchsorted(part.hashes, here, side="left")
                right = np.searchsorted(part.hashes, here, side="right")
                for k in np.flatnonzero(right > left):
                    hits.update((int(of[k]), int(i)) for i in part.items[left[k] : right[k]])
            whole = (None, None)
            for i, item in sorted(hits):
                if whole[0] != i:
                    whole = (i, np.unique(hashes[begin[i] : begin[i + 1]]))
                wanted = block.sets[item]
                place = np.minimum(np.searchsorted(whole[1], wanted), len(whole[1]) - 1)
                common = int((whole[1][place] == wanted).sum())
                if 100 * common >= percent * len(wanted):
                    yield row + i, item, common


def item_blocks(items: DataFrame, width: int, percent: int, id_column: str = "item_id", text_column: str = "text"):
    """Blocks of items with shingles, one after the other; each has a bounded number of shingles."""
    kind = items.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, s in words.shingle_sets(batch.column(1), width, words.ALNUM):
                if len(s):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), pa.array([len(s)], pa.int64()), pa.array([s.view(np.int64)], pa.list_(pa.int64()))],
                        names=["id", "n", "shingles"],
                    )

    sets = materialize(batch_map(items.select(id_column, text_column), run, f"id {kind}, n long, shingles array<long>"), "items")
    total = sets.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // BLOCK_SHINGLES)
    for b in range(blocks):
        rows = sets.filter(F.pmod(F.xxhash64("shingles"), F.lit(blocks)) == b).orderBy("id", "n").collect()
        if rows:
            yield _block([r.id for r in rows], [np.sort(np.array(r.shingles, dtype=np.int64).view(np.uint64)) for r in rows], percent)


def find_leaks(
    docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item it holds: id, item id, ``n_shingles`` of the item, ``n_common``, ``containment``.

    Words are runs of digits, letters and all characters beyond ASCII, A-Z lowered. A text with fewer words
    than ``width`` is one shingle, so a shorter item is found only as a whole text. Null and empty texts and
    texts without words, on either side, are in no pair. Null ids are carried along; repeated rows of either
    side give repeated pairs. Empty tables give an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    doc_type = docs.schema[id_column].dataType.simpleString()
    item_type = items.schema[item_column].dataType
    out = None
    for block in item_blocks(items, width, percent, item_column, item_text):
        sent = spark.sparkContext.broadcast(block)
        out = _merge(out, batch_map(docs.select(id_column, text_column),
            _find(sent, width, percent), f"id {doc_type}, item long, n_shingles long, n_common long, item_id {item_type.simpleString()}"
        ))
    if out is None:
        out = spark.createDataFrame([], f"id {doc_type}, item long, n_shingles long, n_common long, item_id {item_type.simpleString()}")
    return out.select(
        F.col("id").alias(id_column), F.col("item_id").alias(item_column), "n_shingles", "n_common",
        (F.col("n_common") / F.col("n_shingles")).alias("containment"),
    )


def _merge(one, two):
    return two if one is None else one.unionByName(two)


def _find(sent, width: int, percent: int):
    def run(batches):
        block = sent.value
        ids = pa.array(block.ids)
        for batch in batches:
            found = list(_leaks(batch.column(1), block, width, percent))
            if found:
                rows, at, common = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                sizes = pa.array([len(block.sets[i]) for _, i, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), at, sizes, common, ids.take(at)],
                    names=["id", "item", "n_shingles", "n_common", "item_id"],
                )

    return run


def remove_leaks(
    docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80,
    text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows are only filtered, nothing is joined."""
    at = docs.columns.index(text_column)
    for block in item_blocks(items, width, percent, item_column, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        docs = batch_map(docs, _drop(sent, at, width, percent), docs.schema)
    return docs


def _drop(sent, at: int, width: int, percent: int):
    def run(batches):
        for batch in batches:
            kept = np.ones(batch.num_rows, dtype=bool)
            kept[[row for row, _, _ in _leaks(batch.column(at), sent.value, width, percent)]] = False
            yield batch.filter(pa.array(kept))

    return run


def op6_benchmark_decontamination(spark, sf_dir):
    """All pairs of a document and a benchmark item of which it holds 80 % of the 5-word shingles or more."""
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP6_SQL = """
    WITH spelled AS (
      SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
    lists AS (
      SELECT kind, id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM spelled),
    cut AS (
      SELECT kind, id, unnest(CASE WHEN len(w) >= 5
               THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
      FROM lists),
    sets AS (SELECT DISTINCT kind, id, shingle FROM cut),
    sizes AS (SELECT id, count(*) AS n FROM sets WHERE kind = 'b' GROUP BY id),
    pairs AS (
      SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_common
      FROM sets b JOIN sets d ON d.shingle = b.shingle AND d.kind = 'd' WHERE b.kind = 'b' GROUP BY ALL)
    SELECT doc_id, item_id, n AS n_shingles, n_common, n_common / n AS containment
    FROM pairs JOIN sizes ON item_id = id WHERE 100 * n_common >= 80 * n"""
