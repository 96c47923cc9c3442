"""Running values, row indexes, chunks, shuffles and splits over a global order.

None of these sorts the whole data into one task. A running value is computed over a tree: totals per
block of the order, a running value over the blocks, and a window inside every block. More blocks than one task should
order are gathered into ranges, whose totals are run over in the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farelight.session import broadcast_if_small, materialize

ROWS_PER_BLOCK = 100_000

#: Blocks of a group whose totals one task runs over.
BLOCKS_PER_RANGE = 100_000

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, before: Column, within: Column) -> Column:
    if kind == "sum":
        return F.coalesce(before, F.lit(0)) + F.coalesce(within, F.lit(0))
    return F.greatest(before, within) if kind == "max" else F.least(before, within)


def block_offsets(totals: DataFrame, by: tuple[str, ...], kinds: dict[str, str], block: str = "_block") -> DataFrame:
    """Rows (*by, block, value...), as a side to join: of each block the aggregate of all earlier blocks of its group.

    ``totals`` has one row per group and block, ``kinds`` maps its value columns to ``sum``, ``max`` or ``min``; a first block has null. Groups
    of up to ``BLOCKS_PER_RANGE`` blocks are one window each. Beyond that blocks are sorted into ranges, a written table keeps which
    block is in which range, and the ranges are the blocks of the next level: fewer by ``BLOCKS_PER_RANGE`` with every level.
    """
    kept = totals.persist()
    try:
        counted = kept.groupBy(*by).agg(F.count("*").alias("k")).agg(F.max("k"), F.sum("k")).first()
        largest, blocks = counted[0] or 0, counted[1] or 0
        if largest <= BLOCKS_PER_RANGE:
            earlier = W.partitionBy(*by).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
            return broadcast_if_small(kept.select(*by, block, *[_AGGREGATES[kind](n).over(earlier).alias(n) for n, kind in kinds.items()]))
        # Ranges are cut by a sample and not quite equal.
        upper = f"{block}_range"
        placed = kept.repartitionByRange(-(-2 * blocks // BLOCKS_PER_RANGE), *by, block).withColumn(upper, F.spark_partition_id())
        placed = materialize(placed, "ranges")
    finally:
        kept.unpersist()
    totals = placed.groupBy(*by, upper).agg(*[_AGGREGATES[kind](n).alias(n) for n, kind in kinds.items()])
    before = block_offsets(totals, by, kinds, upper).withColumnsRenamed({n: f"_r_{n}" for n in kinds})
    earlier = W.partitionBy(*by, upper).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    values = [_combine(kind, F.col(f"_r_{n}"), _AGGREGATES[kind](n).over(earlier)).alias(n) for n, kind in kinds.items()]
    return broadcast_if_small(placed.join(before, [*by, upper]).select(*by, block, *values))


def running_before(
    df: DataFrame, block: Column, order: list[str], values: dict[str, tuple[str, Column]], by: tuple[str, ...] = ()
) -> DataFrame:
    """Add, per row, the running aggregate of all earlier rows.

    ``values`` maps a new column to (``sum`` | ``max`` | ``min``, expression). ``block`` has
    to grow with ``order`` and to hold a bounded number of rows; ``order`` identifies a row
    within ``by``. Without an earlier row a maximum or minimum is null and a sum 0.
    """
    rows = df.withColumn("_block", block)
    totals = rows.groupBy(*by, "_block").agg(*[_AGGREGATES[kind](e).alias(f"_b_{n}") for n, (kind, e) in values.items()])
    offsets = block_offsets(totals, by, {f"_b_{n}": kind for n, (kind, _) in values.items()})
    earlier_rows = W.partitionBy(*by, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    joined = rows.join(offsets, [*by, "_block"], "left")
    added = {n: _combine(kind, F.col(f"_b_{n}"), _AGGREGATES[kind](e).over(earlier_rows)) for n, (kind, e) in values.items()}
    return joined.withColumns(added).drop("_block", *[f"_b_{n}" for n in values])


# Checkpoints and score histories ---------------------------------------------------------


def running_max_checkpoint(pages: DataFrame, seq: str = "page_id", value: str = "max_date") -> DataFrame:
    """Pages whose maximum exceeds every earlier one: the checkpoint rows to append."""
    block = F.floor(F.col(seq) / ROWS_PER_BLOCK)
    rows = running_before(pages, block, [seq], {"_best": ("max", F.col(value))})
    return rows.filter(F.col("_best").isNull() | (F.col(value) > F.col("_best"))).drop("_best")


def improvement_pct(scores: DataFrame, seq: str = "chunk_id") -> DataFrame:
    """Add ``improved`` and the percentage gained over the first chunk when a score is a new best."""
    block = F.floor(F.col(seq) / ROWS_PER_BLOCK)
    rows = running_before(scores, block, [seq], {"_best": ("min", F.col("rmse"))})
    first = scores.agg(F.min_by("rmse", seq)).scalar()
    better = F.col("rmse") < F.col("_best")
    gain = F.round((1 - F.col("rmse") / first) * 100, 2)
    return rows.withColumns(
        {
            "improved": F.col("_best").isNull() | better,
            "percentage_improvement": F.when(better, gain).otherwise(0.0),
        }
    ).drop("_best")


def patience_counter(scores: DataFrame, seq: str = "chunk_id", wrap: int | None = None) -> DataFrame:
    """Add rows since the last improvement; non-linear models start again after ``wrap``."""
    block = F.floor(F.col(seq) / ROWS_PER_BLOCK)
    rows = improvement_pct(scores, seq)
    rows = running_before(rows, block, [seq], {"_position": ("sum", F.lit(1))})
    here = F.when(F.col("improved"), F.col("_position"))
    rows = running_before(rows, block, [seq], {"_last": ("max", here)})
    since = F.col("_position") - F.greatest(F.col("_last"), here)
    patience = since if wrap is None else since % wrap
    return rows.withColumn("patience", patience.cast("int")).drop("_position", "_last")


def growth_steps(scores: DataFrame, seq: str = "chunk_id", wrap: int = 5) -> DataFrame:
    """Add how often patience ran out up to this chunk: its fit uses hyper-parameters grown that often.

    Patience is looked at before a chunk is fitted: it has run out when the last improvement of an earlier chunk is
    ``wrap`` chunks back, or a multiple of that. Whether the chunk itself then improves makes no difference.
    """
    block = F.floor(F.col(seq) / ROWS_PER_BLOCK)
    rows = improvement_pct(scores, seq)
    rows = running_before(rows, block, [seq], {"_position": ("sum", F.lit(1))})
    rows = running_before(rows, block, [seq], {"_last": ("max", F.when(F.col("improved"), F.col("_position")))})
    ran_out = F.coalesce(((F.col("_position") - F.col("_last")) % wrap == 0).cast("int"), F.lit(0))
    rows = rows.withColumn("_ran_out", ran_out)
    rows = running_before(rows, block, [seq], {"growth_step": ("sum", F.col("_ran_out"))})
    rows = rows.withColumn("growth_step", (F.col("growth_step") + F.col("_ran_out")).cast("int"))
    return rows.drop("_position", "_last", "_ran_out")


# Row indexes -----------------------------------------------------------------------------


def file_row_index(scan: DataFrame, name: str = "row_index") -> DataFrame:
    """Index the rows of a stored parquet table in file order, from 0.

    Rows carry their position in the file; only the row counts of the files are added up.
    Nothing is sorted or shuffled, and a retried task yields the same numbers. ``scan`` is
    the table as read, before any filter.
    """
    rows = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_position"))
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_start"))
    return (
        rows.join(block_offsets(sizes, (), {"_start": "sum"}, "_file"), "_file")
        .withColumn(name, F.coalesce("_start", F.lit(0)) + F.col("_position"))
        .drop("_file", "_position", "_start")
    )


def ordered_index(df: DataFrame, block: Column, order: list[str], name: str = "row_index") -> DataFrame:
    """Index rows from 0 by a unique order, for frames that are not a stored table."""
    return running_before(df, block, order, {name: ("sum", F.lit(1))}).withColumn(name, F.col(name).cast("bigint"))


def chunk_id(index: Column, size: int) -> Column:
    """Chunk number from 1."""
    return F.floor(index / size) + 1


def row_index_chunks(scan: DataFrame, size: int = 500_000) -> DataFrame:
    """Fixed-size chunks of a stored table: every row in exactly one, all full but the last."""
    rows = file_row_index(scan)
    return rows.withColumn("chunk_id", chunk_id(F.col("row_index"), size))


def page_slice(indexed: DataFrame, offset: int, limit: int, index: str = "row_index") -> DataFrame:
    return indexed.filter((F.col(index) >= offset) & (F.col(index) < offset + limit))


def digest(keys: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))).cast("binary"))


def block_digits(rows: int, per_block: int = ROWS_PER_BLOCK) -> int:
    """Hex digits of a digest that cut ``rows`` into blocks of at most ``per_block`` rows on average."""
    digits = 1
    while 16**digits * per_block < rows:
        digits += 1
    return digits


def shuffled_index(
    df: DataFrame, keys: list[str], seed: int = 1234, name: str = "row_index", digits: int | None = None,
    slice_rows: int = 1_000_000,
) -> DataFrame:
    """Index rows from 0 in a seeded pseudo-random order of their digest.

    Identical rows are counted before the shuffle and get consecutive numbers, so however
    many copies a row has, they travel as one; long runs of copies are expanded in slices
    spread over tasks. ``digits`` hex digits of the digest make 16^digits blocks; by default as many
    as keep a block near ``ROWS_PER_BLOCK`` rows or below. The numbers do not depend on it.

    The counted rows are stored, as totals of blocks and numbers are both made of them; the order is that of the 16 bytes of
    the digest, which is the one of its hex digits.
    """
    columns = df.columns
    if digits is None:
        digits = block_digits(df.count())
    counted = materialize(df.groupBy(*columns).agg(F.count("*").alias("_copies")), "counted")
    counted = counted.withColumn("_digest", F.unhex(digest(keys, seed)))
    block = F.substring(F.hex("_digest"), 1, digits)
    placed = running_before(counted, block, ["_digest", *columns], {"_start": ("sum", F.col("_copies"))})
    end = F.col("_start") + F.col("_copies")
    few = placed.filter(F.col("_copies") <= slice_rows).select(
        *columns, F.explode(F.sequence(F.col("_start"), end - 1)).alias(name)
    )
    slices = placed.filter(F.col("_copies") > slice_rows).select(
        *columns, end.alias("_end"), F.explode(F.sequence(F.col("_start"), end - 1, F.lit(slice_rows))).alias("_from")
    )
    many = slices.repartition("_from").select(
        *columns, F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + slice_rows, F.col("_end")) - 1)).alias(name)
    )
    return few.unionByName(many)


# Splits ----------------------------------------------------------------------------------


def hash_bucket(keys: list[str], buckets: int, seed: int) -> Column:
    """Stable bucket 0..buckets-1 of a row; no shuffle, no state."""
    head = F.conv(F.substring(digest(keys, seed), 1, 8), 16, 10).cast("bigint")
    return (head % buckets).cast("int")


def hash_split(df: DataFrame, keys: list[str], train_fraction: float = 0.2, seed: int = 1234) -> DataFrame:
    """Add ``is_train`` for about ``train_fraction`` of the rows."""
    return df.withColumn("is_train", hash_bucket(keys, 10_000, seed) < int(round(train_fraction * 10_000)))


def exact_split(indexed: DataFrame, train_fraction: float = 0.2, index: str = "row_index") -> DataFrame:
    """Add ``is_train`` for the rows up to position floor(fraction * n), that one included.

    The rows are stored: they are counted and then read, and an index is not worked out twice.
    """
    indexed = materialize(indexed, "indexed")
    limit = indexed.agg(F.floor(F.count("*") * F.lit(train_fraction))).scalar()
    return indexed.withColumn("is_train", F.col(index) <= limit)


def kfold_assign(df: DataFrame, keys: list[str], folds: int = 10, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", hash_bucket(keys, folds, seed))
