"""Sharding with fixed virtual slots.

Records are hashed into a fixed number of slots, the bytes of every slot are added up, and a stored map says
which shard a slot is in. The map has versions: the first deals slots in turn, each later one is the map before
with edits that move slots from heavy shards to light ones. Records never need to be hashed again: a
new map moves whole slots. Only DataFrame functions touch records; the map has one row per slot.

Records that are equal in id, size and checksum share a hash. Where all of them together are heavier than a slot should be they are
counted and cut into pieces, each with a slot of its own. There are fewer such groups than slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelight.llm.tables import documents, fresh
from farelight.session import materialize

#: Virtual slots, whatever the input; also the bound of the map's rows.
SLOTS = 4096
SHARDS = 8

#: Copies of a record that are listed at once.
SLICE = 100_000


def slot_of(id_column: Column, checksum: Column, slots: int = SLOTS) -> Column:
    """The slot of a record, from its id and the checksum of its text."""
    return F.pmod(F.xxhash64(id_column, checksum), F.lit(slots)).cast("int")


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def checksum_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def heavy_groups(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Groups of equal ``records`` (_id, size, text_crc32) whose bytes exceed the mean of a slot: their ``count`` and ``pieces``.

    There are fewer than ``slots`` of them, hence the broadcast hint. Pieces are as heavy as a mean slot at most, or one record each.
    """
    groups = records.groupBy("_id", "size", "text_crc32").agg(F.count("*").alias("count")).filter("count > 1")
    total = records.agg(F.sum("size").alias("total"))
    in_slots = F.col("count").cast("double") * F.col("size") * slots / F.col("total")
    weighed = groups.join(F.broadcast(total), in_slots > 1)
    pieces = F.least(F.col("count"), F.ceil(in_slots), F.lit(slots).cast("long"))
    found = weighed.select(F.col("_id").alias("_heavy_id"), F.col("size").alias("_heavy_size"), F.col("text_crc32").alias("_heavy_crc"), "count", pieces.alias("pieces"))
    return F.broadcast(materialize(found, "heavy"))


def _is_heavy(id_: Column, size: Column, checksum: Column) -> Column:
    return id_.eqNullSafe(F.col("_heavy_id")) & (size == F.col("_heavy_size")) & (checksum == F.col("_heavy_crc"))


def piece_slot(id_column: Column, checksum: Column, piece: Column, slots: int = SLOTS) -> Column:
    """The slot of a piece of a heavy group; the first piece is where the group's records would be."""
    return F.when(piece == 0, slot_of(id_column, checksum, slots)).otherwise(F.pmod(F.xxhash64(id_column, checksum, piece), F.lit(slots)).cast("int"))


def slot_items(records: DataFrame, heavy: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows (_id, size, text_crc32, virtual_slot, n): every record that is not heavy, and every piece of a heavy group with its ``n`` records."""
    id_, size, checksum = F.col("_id"), F.col("size"), F.col("text_crc32")
    light = records.join(heavy, _is_heavy(id_, size, checksum), "left_anti")
    light = light.select(id_, size, checksum, slot_of(id_, checksum, slots).alias("virtual_slot"), F.lit(1).cast("long").alias("n"))
    cut = heavy.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    edge = [F.floor(F.col("count") * (F.col("piece") + k) / F.col("pieces")) for k in (0, 1)]
    pieces = cut.select(
        F.col("_heavy_id").alias("_id"), F.col("_heavy_size").alias("size"), F.col("_heavy_crc").alias("text_crc32"),
        piece_slot(F.col("_heavy_id"), F.col("_heavy_crc"), F.col("piece"), slots).alias("virtual_slot"), (edge[1] - edge[0]).alias("n"),
    )
    return light.unionByName(pieces)


def rebalance(owner: list[int], weight: list[int], shards: int) -> list[tuple[int, int]]:
    """Edits (slot, new shard) after which no move or swap of slots between extreme shards evens out their bytes.

    The heaviest shard gives the lightest one the slot, or the difference of two swapped slots, that comes
    nearest to half of what lies between them.
    """
    owner = list(owner)
    first = list(owner)
    load = [0] * shards
    for slot, shard in enumerate(owner):
        load[shard] += weight[slot]
    for _ in range(4 * len(owner)):
        heavy, light = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[heavy] - load[light]
        give = sorted((weight[s], s) for s in range(len(owner)) if owner[s] == heavy and weight[s])
        take = sorted((weight[s], s) for s in range(len(owner)) if owner[s] == light and weight[s])
        best = min(((abs(gap - 2 * w), s, None) for w, s in give), default=(gap, None, None), key=lambda x: (x[0], x[1]))
        # For each slot given, the slot taken back that brings the difference nearest to half the gap.
        k = 0
        for w, s in give:
            while k < len(take) and w - take[k][0] > gap / 2:
                k += 1
            for j in (k - 1, k):
                if 0 <= j < len(take) and abs(gap - 2 * (w - take[j][0])) < best[0]:
                    best = (abs(gap - 2 * (w - take[j][0])), s, take[j][1])
        if best[1] is None or best[0] >= gap:
            break
        moves = [(best[1], heavy, light)] + ([(best[2], light, heavy)] if best[2] is not None else [])
        for slot, old, new in moves:
            owner[slot] = new
            load[old] -= weight[slot]
            load[new] += weight[slot]
    return [(slot, new) for slot, (old, new) in enumerate(zip(first, owner, strict=True)) if old != new]


def slot_map(records: DataFrame, shards: int = SHARDS, slots: int = SLOTS, before: DataFrame | None = None) -> DataFrame:
    """The stored map of ``records`` (virtual_slot, size, and how many of them if there is an ``n``): rows (version, virtual_slot, shard, first_row).

    Without a map ``before``, version 1 deals the slots in turn. The next version is the last one with the edits
    of ``rebalance``; if there are none it is the same. ``first_row`` is the number of rows
    of the shard in smaller slots, as of this version. The driver sees one row per slot.
    """
    spark = records.sparkSession
    each = F.col("n") if "n" in records.columns else F.lit(1)
    sums = records.groupBy("virtual_slot").agg(F.sum(F.col("size") * each).alias("size"), F.sum(each).alias("n")).collect()
    size, count = [0] * slots, [0] * slots
    for row in sums:
        size[row.virtual_slot], count[row.virtual_slot] = row["size"], row.n
    if before is None:
        versions = [(1, [slot % shards for slot in range(slots)])]
    else:
        newest = before.agg(F.max("version")).first()[0]
        owner = {r.virtual_slot: r.shard for r in before.filter(F.col("version") == newest).collect()}
        versions = [(newest, [owner[slot] for slot in range(slots)])]
    last, owner = versions[-1]
    edited = list(owner)
    for slot, shard in rebalance(owner, size, shards):
        edited[slot] = shard
    versions.append((last + 1, edited))
    rows = []
    for version, owner in versions:
        placed = [0] * max(shards, max(owner) + 1)
        for slot, shard in enumerate(owner):
            rows.append((version, slot, shard, placed[shard]))
            placed[shard] += count[slot]
    return materialize(spark.createDataFrame(rows, "version int, virtual_slot int, shard int, first_row long"), "slot_map")


def newest(stored: DataFrame) -> DataFrame:
    """The newest version of a stored map, one row per slot: small by its number of slots."""
    return F.broadcast(stored.join(F.broadcast(stored.agg(F.max("version").alias("version"))), "version").drop("version"))


def shard_records(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``virtual_slot``, ``shard`` and ``slot``, its place in the shard from 0.

    Bytes of the shards are near equal: they differ by less than the records at hand could even out. A null text has
    size 1 and the checksum of an empty one. Equal texts of different ids are placed by their ids, so they are spread over slots. Null ids,
    repeated rows and ties are placed like others: rows that are equal in id, size and checksum get consecutive places of one slot, or of one
    slot per piece if they are many. An empty table gives an empty result; other columns are not looked at.
    """
    id_, text = F.col(id_column), F.col(text_column)
    records = docs.select(id_.alias("_id"), size_of(text).alias("size"), checksum_of(text).alias("text_crc32"))
    records = materialize(records, "records")
    heavy = heavy_groups(records)
    items = materialize(slot_items(records, heavy), "items")
    stored = slot_map(items, shards)
    inside = Window.partitionBy("virtual_slot").orderBy("_id", "text_crc32", "size", "n").rowsBetween(Window.unboundedPreceding, -1)
    numbered = items.withColumn("row", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(newest(stored), "virtual_slot")
    start = F.col("first_row") + F.col("row")
    names = [F.col("_id").alias(id_column), "size", "text_crc32", "virtual_slot", "shard"]
    single = numbered.filter("n = 1").select(*names, start.alias("slot"))
    # Copies leave a task in slices, so no row of an array holds all of a piece.
    slices = numbered.filter("n > 1").select(
        *names, (start + F.col("n")).alias("_end"), F.explode(F.sequence(start, start + F.col("n") - 1, F.lit(SLICE).cast("long"))).alias("_from")
    )
    spread = slices.repartition(F.col("_from"))
    many = spread.select(id_column, *names[1:], F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + SLICE, F.col("_end")) - 1)).alias("slot"))
    return single.unionByName(many)


def with_shard(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with its columns and ``virtual_slot`` and ``shard`` (under longer names where it has these); no row moves."""
    id_, text = F.col(id_column), F.col(text_column)
    slot, shard = fresh(docs, "virtual_slot"), fresh(docs, "shard")
    row_id, size, crc, turn = (fresh(docs, f"_row_{n}") for n in ("id", "size", "crc", "turn"))
    records = materialize(docs.select(id_.alias("_id"), size_of(text).alias("size"), checksum_of(text).alias("text_crc32")), "records")
    heavy = heavy_groups(records)
    # Copies of a heavy group are dealt to its pieces in turn; which copy goes where makes no difference.
    rows = docs.withColumns({row_id: id_, size: size_of(text), crc: checksum_of(text), turn: F.monotonically_increasing_id()})
    of_id, of_size, of_crc, _, pieces = names = [fresh(docs, f"_of_{c}") for c in heavy.columns]
    same = F.col(row_id).eqNullSafe(F.col(of_id)) & (F.col(size) == F.col(of_size)) & (F.col(crc) == F.col(of_crc))
    rows = rows.join(F.broadcast(heavy.toDF(*names)), same, "left")
    piece = F.coalesce(F.pmod(F.col(turn), F.col(pieces)), F.lit(0).cast("long"))
    rows = rows.withColumn(slot, piece_slot(F.col(row_id), F.col(crc), piece))
    stored = newest(slot_map(slot_items(records, heavy), shards)).select(F.col("virtual_slot").alias("_of_slot"), F.col("shard").alias("_of_shard"))
    joined = rows.join(stored, rows[slot] == stored["_of_slot"])
    return joined.select(*[rows[c] for c in docs.columns], rows[slot], stored["_of_shard"].alias(shard))


def op9_sharding(spark, sf_dir):
    """All documents in shards 0 to 7 of near equal bytes."""
    return shard_records(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
