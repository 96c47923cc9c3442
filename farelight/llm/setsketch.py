"""Near duplicates by SetSketch registers.

A sketch has ``REGISTERS`` registers. Every element of a set has for each register an exponentially distributed value that its
hash determines; a register keeps the least of all elements, truncated to a power of ``BASE``, as the exponent. Registers of a
union are the larger ones of both, and two registers agree about as often as the sets' similarity.

1. An element's values are the points of a Poisson process over all registers. Points beyond a bound that leaves registers
   open in few sets only are not generated; sets with an open register are done again with a higher bound.
   A sketch thus costs about one hash per element and a fixed number of points per set, and is the same for any bound.
2. Bands of ``ROWS`` registers are hashed; sets that share a band meet. At a similarity of 0.85 two sets share none of 42
   bands with a probability of 2e-9, at 0.8 of 3e-6.
3. In every bucket all members meet the one that shares most bands with others. Pairs whose registers are too unlikely under the asked similarity
   (by the joint likelihood of larger, smaller and equal registers, six deviations) are left; all others are confirmed on whole sets.
4. Links make classes. Buckets that hold several classes are looked at again: members outside the largest class with members of
   other classes, so each pair of a bucket is confirmed, unlikely or known to be connected. Buckets beyond ``HOT`` members are dealt
   with in blocks by sketches; blocks with many likely pairs confirm them inside their task, most likely first, and skip what is
   connected by then, so that at most one link per member leaves a block. A pair is looked at in the first band it shares.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelight.llm import words
from farelight.llm.tables import batch_map, components, documents, hint_small, same
from farelight.session import materialize

#: Registers, how many make a band, the base of the truncation, the rate of the values, and the highest register.
REGISTERS = 252
ROWS = 6
BASE = 1.001
RATE = 20
HIGHEST = 2**16 - 2

#: Elements that are worked on at once.
ELEMENTS = 1 << 18

#: Members of a bucket beyond which pairs are made in blocks, members of a block, and pairs per member that leave a block unconfirmed.
HOT = 16
BLOCK = 256
LOOSE = 1

#: A likely pair has equal registers of at least this share of the asked similarity: more than six deviations below what is expected.
AGREE = 0.8

#: Log-likelihood that a pair may lack under the asked similarity against its best one: six deviations.
LACK = 18.0

_LN_BASE = np.log(BASE)
_U53 = 2.0**-53


def _exponentials(hashes: np.ndarray) -> np.ndarray:
    """Exponentially distributed values from the leading bits of hashes."""
    return -np.log(((hashes >> np.uint64(11)).astype(np.float64) + 0.5) * _U53)


def _fill(out: np.ndarray, hashes: np.ndarray, owner: np.ndarray, bound: np.ndarray) -> None:
    """Lower the registers in ``out`` (one after the other, set by set) to the points of some elements up to the ``bound`` of their set.

    Points of an element are numbered; waves of 1, 2, 4 ... points are generated for the elements that are still within their bound.
    """
    at, number, wave = np.zeros(len(hashes)), np.uint64(0), 1
    while len(hashes):
        steps = (np.arange(wave, dtype=np.uint64) + number + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        drawn = words.mix(hashes[:, None] + steps[None, :])
        points = at[:, None] + np.cumsum(_exponentials(drawn), axis=1)
        inside = points <= bound[owner][:, None]
        register = (words.mix(drawn[inside]) >> np.uint64(32)) % np.uint64(REGISTERS)
        place = np.broadcast_to(owner[:, None], points.shape)[inside] * REGISTERS + register.astype(np.int64)
        np.minimum.at(out, place, points[inside])
        going = inside[:, -1]
        hashes, owner, at = hashes[going], owner[going], points[going, -1]
        number, wave = number + np.uint64(wave), min(2 * wave, 1 << 10)


def sketch_sets(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of sets of 64-bit hashes, one row per set; those of an empty set are 0."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    registers = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    todo, spare = np.flatnonzero(sizes), 5.0
    with np.errstate(over="ignore", divide="ignore"):
        while len(todo):
            hashes = words.mix(np.concatenate([sets[i] for i in todo]))
            owner = np.repeat(np.arange(len(todo)), sizes[todo])
            # Points are numbered in units of a mean gap of an element, so n elements make n points a unit.
            bound = REGISTERS * (np.log(REGISTERS) + spare) / sizes[todo]
            least = np.full(len(todo) * REGISTERS, np.inf)
            for k in range(0, len(hashes), ELEMENTS):
                _fill(least, hashes[k : k + ELEMENTS], owner[k : k + ELEMENTS], bound)
            least = least.reshape(-1, REGISTERS)
            full = np.isfinite(least).all(axis=1)
            values = np.floor(1 - np.log(least[full] / (REGISTERS * RATE)) / _LN_BASE)
            registers[todo[full]] = np.clip(values, 0, HIGHEST + 1).astype(np.uint16)
            todo, spare = todo[~full], 2 * spare
    return registers


def merge_sketches(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(one, two)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of each row."""
    with np.errstate(over="ignore"):
        bands = registers[:, : REGISTERS // ROWS * ROWS].reshape(len(registers), -1, ROWS).astype(np.uint64)
        keys = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2])
        for k in range(ROWS):
            keys = words.mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
        return keys.view(np.int64)


def _log_likelihood(similarity, share_a, share_b, above, below, equal):
    """Of registers of a pair: so many larger ones of the first set, of the second set, and equal ones."""

    def larger(x):
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1) / BASE) / _LN_BASE

    up = np.clip(larger(share_a - share_b * similarity), 1e-12, 1.0)
    down = np.clip(larger(share_b - share_a * similarity), 1e-12, 1.0)
    return above * np.log(up) + below * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))


def joint_similarity(sizes_a, sizes_b, above, below, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """The similarity of greatest likelihood of each pair and that log-likelihood.

    Likelihood is concave in the similarity, which can reach the ratio of the sizes at most.
    """
    sizes_a, sizes_b, above, below = (np.asarray(x, dtype=np.float64) for x in (sizes_a, sizes_b, above, below))
    counts = (sizes_a / (sizes_a + sizes_b), sizes_b / (sizes_a + sizes_b), above, below, REGISTERS - above - below)
    low, high = np.zeros(above.shape), np.minimum(sizes_a, sizes_b) / np.maximum(sizes_a, sizes_b)
    for _ in range(rounds):
        third = (high - low) / 3
        left = _log_likelihood(low + third, *counts) < _log_likelihood(high - third, *counts)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    best = (low + high) / 2
    return best, _log_likelihood(best, *counts)


def likely(sizes_a, sizes_b, above, below, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a similarity of ``percent`` is within the allowed lack of likelihood, and the estimate."""
    best, top = joint_similarity(sizes_a, sizes_b, above, below)
    a, b = np.asarray(sizes_a, dtype=np.float64), np.asarray(sizes_b, dtype=np.float64)
    most = np.minimum(a, b) / np.maximum(a, b)
    asked = _log_likelihood(
        np.minimum(percent / 100, most), a / (a + b), b / (a + b), above, below, REGISTERS - np.asarray(above) - np.asarray(below)
    )
    fits = 100 * np.minimum(sizes_a, sizes_b) >= percent * np.maximum(sizes_a, sizes_b)
    return fits & ((best >= percent / 100) | (top - asked <= LACK)), best


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, REGISTERS)


def _sign(width: int):
    """Per row: set size, node (128-bit hash of the set), sketch and band keys."""

    def run(batches):
        salt = np.uint64(0x632BE59BD9B4E019)
        for batch in batches:
            for row, end, sets in _slices(batch.column("_text"), width):
                node = []
                with np.errstate(over="ignore"):
                    for s in sets:
                        mixed = words.mix(s)
                        halves = [mixed.sum(dtype=np.uint64), words.mix(mixed ^ salt).sum(dtype=np.uint64)]
                        node.append(np.array(halves, dtype=">u8").tobytes() if len(s) else None)
                registers = sketch_sets(sets)
                keys = band_keys(registers)
                full = [len(s) > 0 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(row, end - row),
                        batch.column("_hash").slice(row, end - row),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(node, pa.binary()),
                        pa.array([r.astype("<u2").tobytes() if f else None for r, f in zip(registers, full, strict=True)], pa.binary()),
                        pa.array([k if f else None for k, f in zip(keys, full, strict=True)], pa.list_(pa.int64())),
                    ],
                    names=["_id", "_hash", "n", "node", "sketch", "bands"],
                )

    return run


def _slices(texts: pa.Array, width: int):
    """First and last row of each slice of about a megabyte of text, and the shingle sets of its rows."""
    for row, end, _, _ in words.text_slices(texts):
        yield row, end, [s for _, s in words.shingle_sets(texts.slice(row, end - row), width)]


def _likely_pairs(percent: int):
    """Keep pairs of sketches that may reach the similarity."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = _registers(batch.column("sketch_a")), _registers(batch.column("sketch_b"))
            sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            kept, _ = likely(*sizes, (one > two).sum(axis=1), (one < two).sum(axis=1), percent)
            yield batch.filter(pa.array(kept)).select(["a", "b"])

    return run


def reaches(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _confirmed(width: int, percent: int):
    """Keep pairs of texts whose whole sets reach the similarity."""

    def run(batches):
        for batch in batches:
            sets = [dict(words.shingle_sets(batch.column(c), width)) for c in ("text_a", "text_b")]
            kept = [reaches(sets[0][i], sets[1][i], percent) for i in range(batch.num_rows)]
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])

    return run


def _block_pairs(table: pa.Table, percent: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Names, and the likely pairs of different classes of a pair of blocks with the estimates; a node may come twice."""
    first = {node: k for k, node in enumerate(table.column("node").to_pylist())}
    names = sorted(first)
    rows = np.array([first[x] for x in names])
    label = np.unique([x.hex() for x in table.column("label").to_pylist()], return_inverse=True)[1][rows]
    size = table.column("n").to_numpy()[rows]
    registers = _registers(table.column("sketch"))[rows]
    band = table.column("band")[0].as_py()
    found: list[tuple] = []
    for low in range(0, len(names), 64):
        here = slice(low, low + 64)
        agree = (registers[here, None, :] == registers[None, :, :]).sum(axis=2, dtype=np.int32)
        i, j = np.nonzero((agree >= AGREE * percent / 100 * REGISTERS) & (label[here, None] != label[None, :]))
        i = i + low
        i, j = i[i < j], j[i < j]
        i, j = (x[100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])] for x in (i, j))
        for at in range(0, len(i), 1 << 14):
            a, b = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            one, two = registers[a], registers[b]
            # A pair that shares an earlier band is looked at there.
            earlier = (one[:, : band * ROWS] == two[:, : band * ROWS]).reshape(len(a), band, ROWS).all(axis=2).any(axis=1)
            a, b, one, two = (x[~earlier] for x in (a, b, one, two))
            kept, best = likely(size[a], size[b], (one > two).sum(axis=1), (one < two).sum(axis=1), percent)
            found.append((a[kept], b[kept], best[kept]))
    if not found:
        return names, np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return names, *(np.concatenate(x) for x in zip(*found, strict=True))


def _block_candidates(percent: int):
    """The likely pairs of a pair of blocks; where they are many, one row without a pair instead."""

    def run(table: pa.Table) -> pa.Table:
        names, left, right, _ = _block_pairs(table, percent)
        pair = table.column("pair")[0].as_py()
        if len(left) > LOOSE * len(names):
            columns = [pa.array([pair], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())]
        else:
            columns = [pa.array([pair] * len(left), pa.int64())]
            columns += [pa.array([names[k] for k in side], pa.binary()) for side in (left, right)]
        return pa.Table.from_arrays(columns, names=["pair", "a", "b"])

    return run


def _block_links(width: int, percent: int):
    """Confirmed links that connect the classes of a pair of blocks, fewer than it has members."""

    def run(table: pa.Table) -> pa.Table:
        names, left, right, best = _block_pairs(table, percent)
        texts = dict(zip(table.column("node").to_pylist(), table.column("text").to_pylist(), strict=True))
        sets = [s for _, s in words.shingle_sets(pa.array([texts[n] for n in names], pa.string()), width)]
        labels = dict(zip(table.column("node").to_pylist(), table.column("label").to_pylist(), strict=True))
        head = {x: x for x in labels.values()}

        def find(x: bytes) -> bytes:
            while head[x] != x:
                head[x] = x = head[head[x]]
            return x

        kept = []
        for k in np.argsort(-best, kind="stable"):
            i, j = left[k], right[k]
            one, two = find(labels[names[i]]), find(labels[names[j]])
            if one != two and reaches(sets[i], sets[j], percent):
                head[two] = one
                kept.append((i, j))
        columns = [pa.array([names[pair[side]] for pair in kept], pa.binary()) for side in (0, 1)]
        return pa.Table.from_arrays(columns, names=["a", "b"])

    return run


class _Corpus:
    """The nodes of a corpus and its texts, as the steps need them."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, percent: int):
        self.docs, self.nodes, self.width, self.percent = docs, nodes, width, percent

    def texts(self, wanted: DataFrame) -> DataFrame:
        """A written table of the text of one row of each wanted node; ``wanted`` is read from written tables and may repeat nodes."""
        wanted = materialize(self.nodes.select("node", "_id", "_hash").join(hint_small(wanted), "node", "left_semi"), "wanted")
        found = self.docs.alias("d").join(hint_small(wanted).alias("w"), same("d", "w", "_id", "_hash"))
        return materialize(found.groupBy("w.node").agg(F.min("d._text").alias("text")), "texts")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs that may be links by their sketches, among distinct pairs (a, b)."""
        sides = {
            s: self.nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
            for s in "ab"
        }
        pairs = hint_small(materialize(pairs, "pairs"))
        found = pairs.join(sides["a"], "a").join(sides["b"], "b")
        return materialize(batch_map(found, _likely_pairs(self.percent), "a binary, b binary"), "likely")

    def confirm(self, pairs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
        """The links among written pairs (a, b), by whole sets; ``texts`` has those of their nodes if they are written already."""
        texts = self.texts(_both(pairs)) if texts is None else texts
        found = hint_small(pairs).join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
            texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
        )
        return materialize(batch_map(found, _confirmed(self.width, self.percent), "a binary, b binary"), "links")


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b"))


def _bucket_blocks(hot: DataFrame, likely: DataFrame, corpus: _Corpus) -> DataFrame:
    """Links between classes inside of large buckets and among ``likely`` pairs; ``hot`` has rows (key, band, node, label, minor).

    Blocks of nodes that are all in the largest class of their bucket do not meet. All texts are fetched once.
    """
    side = ["key", "minor"]
    counted = hot.groupBy(*side).agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("parts"))
    counted = hint_small(materialize(counted, "counted"))
    split = hot.join(counted, side).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    split = materialize(split.select("node", "label", "band", F.xxhash64(*side, "part").alias("block")), "split")
    blocks = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    blocks = materialize(blocks.select(*side, F.xxhash64(*side, "part").alias("block")), "blocks")
    few = blocks.filter("minor").select("key", F.col("block").alias("block_a"))
    meet = few.join(blocks, "key").filter("not minor or block_a <= block")
    meet = meet.select(F.xxhash64("block_a", "block").alias("pair"), F.explode(F.array_distinct(F.array("block_a", "block"))).alias("block"))
    rows = materialize(split.join(hint_small(materialize(meet, "meet")), "block").select("pair", "node", "label", "band"), "block_rows")
    # Blocks are few bytes and much work: they are dealt out to all tasks, not by their size.
    tasks = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketched = hint_small(rows).join(corpus.nodes.select("node", "n", "sketch"), "node").repartition(tasks, "pair")
    found = sketched.groupBy("pair").applyInArrow(_block_candidates(corpus.percent), "pair long, a binary, b binary")
    found = materialize(found, "block_candidates")
    pairs = likely.union(found.filter("a is not null").select("a", "b"))
    dense = materialize(found.filter("a is null").select("pair"), "dense")
    if dense.isEmpty():
        return corpus.confirm(pairs)
    rows = materialize(rows.join(hint_small(dense), "pair"), "dense_rows")
    texts = corpus.texts(_both(pairs).union(rows.select("node")))
    links = corpus.confirm(pairs, texts)
    whole = rows.join(corpus.nodes.select("node", "n", "sketch"), "node").join(texts, "node")
    inside = whole.repartition(tasks, "pair").groupBy("pair").applyInArrow(_block_links(corpus.width, corpus.percent), "a binary, b binary")
    return links.union(materialize(inside, "block_links"))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Component of every row under "shingle sets have a Jaccard similarity of at least percent / 100".

    Returns per row of ``docs``: the id, ``n_shingles``, ``component_id`` (the smallest id of all rows it is connected with) and
    ``kept`` (whether these two are equal). Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered; a text with
    fewer words than ``width`` is one shingle. Links are confirmed on whole sets; a pair without a common band is missed, see above.

    Null and empty texts and texts without words have no shingles, link with nothing and are their own
    component. Rows with a null id take part; an id is null only where all ids of a component are, and such rows are kept. Rows
    that share an id are judged by their own texts, repeated rows come out repeated. A very long text is one set. An empty table
    gives an empty result; other columns of ``docs``, whatever their names, are not looked at.
    """
    docs = docs.select(F.col(id_column).alias("_id"), F.xxhash64(text_column).alias("_hash"), F.col(text_column).alias("_text"))
    id_type = docs.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, _hash long, n long, node binary, sketch binary, bands array<long>"
    signed = materialize(batch_map(docs, _sign(width), schema), "signed")
    # A node is an equal set; the text of any of its rows stands for it.
    some = signed.filter("n > 0")
    nodes = materialize(
        some.groupBy("node").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_hash", "n", "sketch", "bands")).alias("r"))
        .select("node", "r._id", "r._hash", "r.n", "r.sketch", "r.bands"),
        "nodes",
    )
    corpus = _Corpus(docs, nodes, width, percent)
    listed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = listed.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1")
    shared = hint_small(materialize(shared, "shared"))
    held = materialize(listed.join(shared, "key"), "held")
    spread = hint_small(materialize(held.groupBy("node").agg(F.sum("k").alias("spread")), "spread"))
    ones = held.join(spread, "node").groupBy("key").agg(F.max(F.struct("spread", "node")).alias("one"))
    ones = hint_small(materialize(ones.select("key", F.col("one.node").alias("one")), "ones"))
    stars = held.join(ones, "key").filter("node <> one").select(F.least("one", "node").alias("a"), F.greatest("one", "node").alias("b"))
    links = corpus.confirm(corpus.likely(stars.distinct()))
    labels = components(links)

    classed = held.join(hint_small(labels), "node", "left")
    classed = materialize(classed.select("key", "band", "node", "k", F.coalesce("label", "node").alias("label")), "classed")
    largest = classed.groupBy("key", "label").agg(F.count("*").alias("size"))
    largest = largest.groupBy("key").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("classes"))
    largest = hint_small(materialize(largest.filter("classes > 1").select("key", F.col("top.label").alias("top")), "largest"))
    mixed = classed.join(largest, "key").select("key", "band", "node", "label", "k", (F.col("label") != F.col("top")).alias("minor"))
    mixed = materialize(mixed, "mixed")
    few = mixed.filter(f"k <= {HOT}")
    minor = hint_small(few.filter("minor").select("key", F.col("node").alias("a"), F.col("label").alias("label_a")))
    met = minor.join(few.select("key", F.col("node").alias("b"), "label", "minor"), "key")
    met = met.filter("label_a <> label and (not minor or a < b)")
    likely = corpus.likely(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    hot = materialize(mixed.filter(f"k > {HOT}"), "hot")
    more = corpus.confirm(likely) if hot.isEmpty() else _bucket_blocks(hot, likely, corpus)
    if not more.isEmpty():
        labels = components(links.union(more))

    labels = hint_small(labels)
    least = nodes.select("node", "_id").join(labels, "node").groupBy("label").agg(F.min("_id").alias("component_id"))
    least = hint_small(materialize(least, "least"))
    named = hint_small(materialize(labels.join(least, "label").select("node", "component_id"), "named"))
    # A node without links is a component of its own.
    rows = signed.select("_id", "n", "node").join(nodes.select("node", F.col("_id").alias("first")), "node", "left").join(named, "node", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component_id", "first")).otherwise(F.col("_id"))
    return rows.select(
        F.col("_id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


def op11_setsketch_dedup(spark, sf_dir):
    """Components of all documents by sets of 5-word shingles with a similarity of at least 0.85."""
    return near_duplicates(documents(spark, sf_dir), width=5, percent=85)


OP11_SQL = """
    WITH RECURSIVE tokens AS (
      SELECT doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents),
    elements AS (
      SELECT DISTINCT doc_id, unnest(
               CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS e
      FROM tokens),
    counts AS (SELECT doc_id, count(*) AS n FROM elements GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
      FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
      SELECT x, y FROM common JOIN counts p ON p.doc_id = x JOIN counts q ON q.doc_id = y
      WHERE 100 * k >= 85 * (p.n + q.n - k)),
    paths AS (
      SELECT DISTINCT x AS doc_id, x AS other FROM links
      UNION SELECT paths.doc_id, links.y FROM paths JOIN links ON paths.other = links.x)
    SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(r.least, d.doc_id) AS component_id,
           coalesce(r.least, d.doc_id) = d.doc_id AS kept
    FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id
    LEFT JOIN (SELECT doc_id, min(other) AS least FROM paths GROUP BY doc_id) r ON r.doc_id = d.doc_id"""
