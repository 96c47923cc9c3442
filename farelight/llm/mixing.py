"""Mixing sources to target weights, with a multivariate-hypergeometric splitting tree.

1. Every source gets a target of words: a share of the whole by weight, but no more than a multiple of its
   own size; what that cuts off is shared again by weight.
2. The documents of a source are laid end to end in the order of a hash, once per pass. The mix takes what
   lies before the target, so a source that is asked for more than it has is repeated.
3. The laid out words are cut into blocks, and a tree splits the block quotas of all sources among
   the output shards: at each node the left half draws its blocks from the blocks of the node without
   replacement, a multivariate hypergeometric draw. Every shard has the same number of blocks, up to one.
4. Blocks of a source, in permuted order, go to the shards by these quotas; a document is in the block its own start lies in.
   Each shard is shuffled locally.

Positions are running sums, taken in two levels: over cells of the hash, then inside each cell. Every cell keeps the first and last
key of each block in it, so a row finds its blocks by its cell, without a join on ids. Sources are few: the driver holds one number
of blocks for each, and the upper nodes of the tree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelight.llm import words
from farelight.llm.tables import batch_map, documents, fresh, hint_small
from farelight.operators.sequence import block_offsets, running_before
from farelight.session import materialize

SEED = 11
SHARE = 1.5
MOST = 2
#: Weights of the sources in code point order, repeated.
WEIGHTS = (3, 1, 2)
#: Words of an output shard, about, and blocks it is drawn from.
SHARD_WORDS = 5_000_000
BLOCKS_PER_SHARD = 32
#: Rows of a cell, and blocks that are listed or ranked at once, about; results do not depend on them.
CELL_ROWS = 2000
SPAN = 100_000


def _order(id_column: str) -> Column:
    """32 bits of a hash of the id; with the id itself it orders a source."""
    text = F.concat(F.lit(f"{SEED}-"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _count_words(batches):
    for batch in batches:
        sizes = [
            np.diff(words.word_spans(data, offsets, words.SPACED)[2])
            for _, _, data, offsets in words.text_slices(batch.column(2))
        ]
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(size, pa.int64())], names=["_id", "_source", "size"]
        )


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows (_source, source_size), one per source.

    Sources are ordered by how soon their limit is met. The first one that stays below its limit when all
    before it are at theirs fixes the words per weight of all after it.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())))
    named = named.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    named = named.withColumn("limit", (F.col("source_size") * most).cast("double"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    named = named.withColumn("all", F.sum("source_size").over(whole) * F.lit(share))
    named = named.withColumn(
        "level", (F.col("all") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    )
    named = named.withColumn("fits", F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level")))
    named = named.withColumn("per_weight", F.max("fits").over(whole))
    return named.select(
        "_source", "rank", "source_size", F.coalesce(F.least("limit", F.col("weight") * F.col("per_weight")), "limit").alias("target")
    )


class Mix:
    """A mix of ``docs``: sizes, targets and positions, from which takes and shards are read.

    Null and empty texts have size 0 and are taken without words, all of them from a source without any. A null source is a source of its own. Rows that
    share an id and a source, repeated rows and null ids among them, are taken together. Empty tables
    give empty results. Other columns, whatever their names, are kept and not looked at.
    """

    def __init__(
        self, docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
        shard_words: int = SHARD_WORDS, seed: int = SEED,
    ):
        self.docs, self.id_column, self.source_column, self.seed = docs, id_column, source_column, seed
        kinds = [docs.schema[c].dataType.simpleString() for c in (id_column, source_column)]
        sized = batch_map(docs.select(id_column, source_column, text_column),
            _count_words, f"_id {kinds[0]}, _source {kinds[1]}, size long"
        )
        self.sized = materialize(sized.withColumn("h", _order("_id")), "sized")
        totals = self.sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
        targets = source_targets(totals)
        whole = F.sum("target").over(Window.partitionBy())
        self.shards = F.greatest(F.ceil(whole / F.lit(shard_words)), F.lit(1)).cast("long")
        block = F.greatest(F.ceil(whole / (self.shards * F.lit(BLOCKS_PER_SHARD))), F.lit(1)).cast("long")
        blocks = F.greatest(F.ceil(F.col("target") / F.col("block")), F.lit(1)).cast("long")
        targets = targets.withColumns({"shards": self.shards, "block": block}).withColumn("blocks", blocks)
        self.targets = materialize(targets, "targets")
        first = self.targets.select("shards", "block").first()
        self.shards, self.block = (first["shards"], first["block"]) if first else (1, 1)
        self._place()

    def _place(self) -> None:
        """Start of every key in its source, and from them the edges of the blocks in every cell."""
        rows = self.sized.count()
        self.bits = min(31, max(2, math.ceil(math.log2(max(1, rows) / CELL_ROWS + 1))))
        ranked = hint_small(self.targets).select(F.col("_source").alias("_ranked"), "rank")
        known = self.sized.join(ranked, self.sized["_source"].eqNullSafe(F.col("_ranked")))
        keys = known.groupBy("rank", "h", "_id").agg(F.sum("size").alias("size"))
        keys = materialize(keys.withColumn("cell", F.shiftright("h", 32 - self.bits)), "keys")
        cells = keys.groupBy("rank", "cell").agg(F.sum("size").alias("at"))
        inner = Window.partitionBy("rank", "cell").orderBy("h", "_id").rowsBetween(Window.unboundedPreceding, -1)
        placed = keys.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
        placed = placed.join(block_offsets(cells, ("rank",), {"at": "sum"}, "cell"), ["rank", "cell"])
        placed = placed.withColumn("start", F.coalesce("at", F.lit(0)) + F.col("inside"))
        joined = placed.join(hint_small(self.targets).drop("_source"), "rank")
        # A document is in a pass when the middle of its words lies before the target; without words also at the target, in the first pass.
        passes = F.explode(F.array([F.lit(p) for p in range(MOST)])).alias("pass")
        joined = joined.select("rank", "cell", "h", "_id", "size", "start", "source_size", "target", "block", "blocks", passes)
        start = F.col("start") + F.col("source_size") * F.col("pass")
        empty = (F.col("size") == 0) & (F.col("start") == F.col("target")) & (F.col("pass") == 0)
        taken = joined.filter((start + F.col("size") / 2 < F.col("target")) | empty)
        number = F.least(F.floor(start / F.col("block")), F.col("blocks") - 1)
        key = F.struct("h", F.col("_id").isNotNull().alias("known"), "_id")
        edges = taken.groupBy("rank", "cell", "pass", number.alias("number")).agg(F.min(key).alias("first"), F.max(key).alias("last"))
        self.edges = materialize(edges, "edges")

    def owners(self) -> DataFrame:
        """Rows (rank, number, shard, turn): the shard that draws a block of a source, and which of its draws of the source that is.

        Blocks of a source are ranked by a hash; the tree gives every shard a run of ranks.
        """
        spark = self.docs.sparkSession
        held = self.targets.orderBy("rank").select("rank", "blocks").collect()
        drawn = split_runs(spark, np.array([r["blocks"] for r in held], dtype=np.int64), self.shards, self.seed)
        runs = drawn.withColumn("place", F.explode(F.sequence("low", F.col("high") - 1)))
        runs = runs.select(F.col("source").alias("rank"), "place", "shard", (F.col("place") - F.col("low")).alias("turn"))
        spans = [F.floor((F.col("blocks") - 1) / F.lit(SPAN)), F.lit(0)]
        parts = self.targets.select("rank", "blocks", F.explode(F.sequence(spans[1].cast("long"), spans[0].cast("long"))).alias("part"))
        stop = F.least(F.col("blocks"), (F.col("part") + 1) * SPAN) - 1
        blocks = parts.repartition("rank", "part").select("rank", F.explode(F.sequence(F.col("part") * SPAN, stop)).alias("number"))
        blocks = blocks.withColumn("mixed", F.xxhash64(F.lit(self.seed), "rank", "number"))
        per = max(1, sum(r["blocks"] for r in held) // SPAN).bit_length()
        found = running_before(
            materialize(blocks, "blocks"), F.shiftrightunsigned(F.col("mixed").bitwiseXOR(F.lit(-(2**63))), 64 - per),
            ["mixed", "number"], {"place": ("sum", F.lit(1))}, ("rank",),
        )
        found = found.withColumn("place", F.col("place").cast("long")).join(runs, ["rank", "place"])
        return materialize(found.select("rank", "number", "shard", "turn"), "owners")

    def _met(self, rows: DataFrame, source: str, h: str, key: str) -> DataFrame:
        """``rows`` with ``_met``: of each take the pass, the number of the block and the shard. Names are those of source, hash and id."""
        owned = self.edges.join(hint_small(self.owners()), ["rank", "number"])
        ranked = self.targets.select("rank", F.col("_source").alias("_to_source"))
        edge = F.struct("first", "last", F.struct("pass", "number", "shard").alias("take"))
        cells = owned.join(hint_small(ranked), "rank").groupBy("_to_source", F.col("cell").alias("_to_cell")).agg(F.collect_list(edge).alias("_edges"))
        cells = hint_small(materialize(cells, "cell_edges"))
        cell = F.shiftright(rows[h], 32 - self.bits)
        joined = rows.join(cells, rows[source].eqNullSafe(F.col("_to_source")) & (cell == F.col("_to_cell")), "left")
        at = F.struct(rows[h].alias("h"), rows[key].isNotNull().alias("known"), rows[key].alias("_id"))
        within = F.filter(F.coalesce("_edges", F.array()), lambda e: (e["first"] <= at) & (at <= e["last"]))
        return joined.withColumn("_met", F.transform(within, lambda e: e["take"])).drop("_to_source", "_to_cell", "_edges")

    def takes(self) -> DataFrame:
        """Per row: id, ``size``, ``source_size``, ``target`` of its source, ``taken`` words: those in blocks that a shard draws."""
        met = self._met(self.sized, "_source", "h", "_id")
        sizes = hint_small(self.targets).select(F.col("_source").alias("_of_source"), "source_size", "target")
        joined = met.join(sizes, met["_source"].eqNullSafe(F.col("_of_source")))
        return joined.select(
            F.col("_id").alias(self.id_column), "size", "source_size", "target", (F.col("size") * F.size("_met")).alias("taken")
        )

    def _drawn(self, rows: DataFrame, source: str, h: str, key: str) -> DataFrame:
        """``rows`` once for each take, with ``_take`` and the key its shard is shuffled by."""
        found = self._met(rows, source, h, key).withColumn("_take", F.explode("_met")).drop("_met")
        return found.withColumn("_key", F.xxhash64(h, key, "_take.pass", F.lit(self.seed)))

    def places(self) -> DataFrame:
        """One row per take: id, source, ``size``, ``pass``, ``block`` of the source, ``shard`` and ``position`` in the shard's shuffled order."""
        found = self._drawn(self.sized, "_source", "h", "_id")
        order = Window.partitionBy("_take.shard").orderBy("_key", "_id", "_source", "_take.pass", "size")
        return found.select(
            F.col("_id").alias(self.id_column), F.col("_source").alias(self.source_column), "size", "_take.pass",
            F.col("_take.number").alias("block"), "_take.shard", (F.row_number().over(order) - 1).alias("position"),
        )

    def rows(self) -> DataFrame:
        """The mix itself: rows of ``docs``, as often as they are taken; each shard is one partition, in shuffled order."""
        h, source, key = fresh(self.docs, "_mix_h"), fresh(self.docs, "_mix_source"), fresh(self.docs, "_mix_id")
        names = {name: fresh(self.docs, f"_mix_{k}") for k, name in enumerate(self.docs.columns)}
        held = self.docs.select(
            *[F.col(f"`{c}`").alias(n) for c, n in names.items()], _order(self.id_column).alias(h),
            F.col(self.source_column).alias(source), F.col(self.id_column).alias(key),
        )
        dealt = self._drawn(held, source, h, key).repartitionById(self.shards, F.col("_take.shard").cast("int"))
        dealt = dealt.sortWithinPartitions("_key", "_take.pass")
        return dealt.select(*[F.col(n).alias(c) for c, n in names.items()])


def _split(low: int, high: int, held: np.ndarray, before: np.ndarray, edges, seed: int):
    """Both halves of a node: runs of shards with the blocks they hold, and those of earlier shards. The draw is the node's own."""
    middle = (low + high) // 2
    rng = np.random.Generator(np.random.PCG64([seed, low, high]))
    left = rng.multivariate_hypergeometric(held, edges(middle) - edges(low), method="marginals")
    return (low, middle, left, before), (middle, high, held - left, before + left)


def _leaves(stack: list, edges, seed: int):
    while stack:
        low, high, held, before = stack.pop()
        if high - low == 1:
            yield low, held, before
        else:
            left, right = _split(low, high, held, before, edges, seed)
            stack += [right, left]


def split_quotas(blocks: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of every source (columns) in every shard (rows); columns add up to ``blocks``, rows are equal up to one.

    One node of the tree has the blocks of a run of shards. Its left half of the shards draws as many blocks as it
    holds from the node's, without replacement.
    """
    total = int(blocks.sum())
    out = np.zeros((shards, len(blocks)), dtype=np.int64)
    for shard, held, _ in _leaves([(0, shards, blocks, np.zeros_like(blocks))], lambda s: total * s // shards, seed):
        out[shard] = held
    return out


def split_runs(spark, blocks: np.ndarray, shards: int, seed: int = SEED, subtrees: int = 256) -> DataFrame:
    """The quotas of ``split_quotas`` as rows (shard, source, low, high): the run of ranks of a source's blocks that a shard draws.

    The driver splits the upper nodes; subtrees are split by tasks. Sources are numbered from 1, runs without blocks left out.
    """
    total = int(blocks.sum())
    nodes = [(0, shards, blocks, np.zeros_like(blocks))] if len(blocks) else []
    while nodes and len(nodes) < subtrees and any(high - low > 1 for low, high, *_ in nodes):
        nodes = [x for n in nodes for x in (_split(*n, lambda s: total * s // shards, seed) if n[1] - n[0] > 1 else (n,))]

    def run(batches):
        for batch in batches:
            for node in batch.to_pylist():
                held, before = (np.array(node[c], dtype=np.int64) for c in ("held", "before"))
                found = [
                    (shard, k + 1, int(b[k]), int(b[k] + q[k]))
                    for shard, q, b in _leaves([(node["low"], node["high"], held, before)], lambda s: total * s // shards, seed)
                    for k in np.flatnonzero(q).tolist()
                ]
                columns = zip(*found, strict=True) if found else ([], [], [], [])
                arrays = [pa.array(list(c), kind) for c, kind in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["shard", "source", "low", "high"])

    rows = [(low, high, held.tolist(), before.tolist()) for low, high, held, before in nodes]
    frame = spark.createDataFrame(rows, "low long, high long, held array<long>, before array<long>")
    return frame.repartition(max(1, min(len(rows), 64))).mapInArrow(run, "shard long, source int, low long, high long")


def op3_mixing_sources(spark, sf_dir):
    """Words that the mix of all sources takes of each document."""
    return Mix(documents(spark, sf_dir)).takes()


def mixing_shards(spark, sf_dir):
    """Where the mix of all documents puts each take: shards of about 20,000 words, drawn by the splitting tree."""
    return Mix(documents(spark, sf_dir), shard_words=20_000).places()


OP3_SQL = f"""
    WITH sized AS (
      SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
             ('0x' || substr(md5('{SEED}-' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
      FROM documents),
    totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM totals),
    weighted AS (
      SELECT *, (CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS weight,
             (2 * source_size)::DOUBLE AS cap
      FROM ranked),
    levels AS (
      SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM weighted),
    shared AS (SELECT *, max(CASE WHEN level <= cap / weight THEN level END) OVER () AS per_weight FROM levels),
    targets AS (SELECT source, source_size, coalesce(least(cap, weight * per_weight), cap) AS target FROM shared),
    placed AS (
      SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM sized)
    SELECT p.doc_id, p.size, t.source_size, t.target,
           (p.size * ((start + p.size / 2.0::DOUBLE < target)::BIGINT
                      + (start + source_size + p.size / 2.0::DOUBLE < target)::BIGINT))::BIGINT AS taken
    FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source"""
