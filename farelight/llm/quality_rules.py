"""Quality classifier: a sparse ensemble of rules over text statistics.

A forest of shallow trees is fitted on a bounded sample of labelled rows. Every path from a root to a
node is a conjunctive rule. A lasso logistic regression over the rules keeps few of them, and what is
left is compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelight.llm import words
from farelight.llm.tables import batch_map, documents, fresh
from farelight.session import materialize

#: At most so many labelled rows are learned from, those of the smallest hashes of their ids.
FIT_ROWS = 20_000

# Exclusive classes of bytes.
_LOWER, _UPPER, _DIGIT, _BLANK, _BREAK, _MARK, _SIGN, _PUNCT, _BEYOND, _CONTROL = range(10)
_CLASS = np.full(256, _PUNCT, dtype=np.uint8)
_CLASS[:32] = _CONTROL
_CLASS[127] = _CONTROL
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = _LOWER, _UPPER, _DIGIT, _BEYOND
_CLASS[[9, 11, 12, 32]] = _BLANK
_CLASS[[10, 13]] = _BREAK
_CLASS[[ord(c) for c in "!?"]] = _MARK
_CLASS[[ord(c) for c in "#$%&*+<=>@^_`|~\\{}[]"]] = _SIGN
_N_CLASSES = 10

_LINE = np.ones(256, dtype=bool)
_LINE[10] = False

STATISTICS = (
    "n_words n_bytes lower upper digit blank marks signs punctuation beyond control "
    "word_bytes longest_word distinct_words top_word bare_words sign_words upper_words "
    "n_lines distinct_lines line_words longest_line"
).split()


def _distinct_and_top(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of distinct hashes and the count of the most frequent one."""
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    begin = np.flatnonzero(new)
    counts = np.diff(np.append(begin, len(h)))
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, o[begin], counts)
    return np.bincount(o[begin], minlength=n), top


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[first[1:]] - total[first[:-1]]


def _largest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(first) - 1, dtype=np.int64)
    np.maximum.at(out, np.repeat(np.arange(len(out)), np.diff(first)), values)
    return out


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text. Shares are of bytes, words or lines; an empty text has zeros."""
    rows = []
    with np.errstate(over="ignore"):
        for row, end, data, offsets in words.text_slices(texts):
            n = end - row
            size = np.diff(offsets)
            kind = _CLASS[data]
            by = np.bincount(np.repeat(np.arange(n) * _N_CLASSES, size) + kind, minlength=n * _N_CLASSES).reshape(n, -1)
            starts, ends, first = words.word_spans(data, offsets, words.SPACED)
            hashes = words.word_hashes(words.lower(data), starts, ends)
            count = np.diff(first)
            distinct, top = _distinct_and_top(hashes, first)
            final = kind[ends - 1]
            letters = np.concatenate([[0], np.cumsum((kind == _LOWER) | (kind == _UPPER) | (kind == _BEYOND))])
            uppers = np.concatenate([[0], np.cumsum(kind == _UPPER)])
            n_letters, n_uppers = letters[ends] - letters[starts], uppers[ends] - uppers[starts]
            line_starts, line_ends, line_first = words.word_spans(data, offsets, _LINE)
            lines = np.diff(line_first)
            line_distinct, _ = _distinct_and_top(words.word_hashes(data, line_starts, line_ends), line_first)
            some, many, rowed = np.maximum(size, 1), np.maximum(count, 1), np.maximum(lines, 1)
            share = [by[:, k] / some for k in (_LOWER, _UPPER, _DIGIT, _BLANK, _MARK, _SIGN, _PUNCT, _BEYOND, _CONTROL)]
            rows.append(
                np.column_stack([
                    count,
                    size,
                    *share,
                    _sums(ends - starts, first) / many,
                    _largest(ends - starts, first),
                    distinct / many,
                    top / many,
                    _sums(n_letters == 0, first) / many,
                    _sums((final == _SIGN) | (final == _MARK), first) / many,
                    _sums((n_uppers == n_letters) & (n_letters > 1), first) / many,
                    lines,
                    line_distinct / rowed,
                    count / rowed,
                    _largest(line_ends - line_starts, line_first),
                ])
            )
    return np.vstack(rows) if rows else np.zeros((0, len(STATISTICS)))


def with_statistics(docs: DataFrame, text_column: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with all its columns and one more, whose name is returned: a struct of ``STATISTICS``."""
    name = fresh(docs, "_statistics")
    at = docs.columns.index(text_column)

    def run(batches):
        for batch in batches:
            found = statistics(batch.column(at))
            fields = [pa.array(np.ascontiguousarray(found[:, k], dtype=np.float64)) for k in range(len(STATISTICS))]
            struct = pa.StructArray.from_arrays(fields, names=STATISTICS)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, name])

    fields = ", ".join(f"{s}: double" for s in STATISTICS)
    schema = F.lit(None).cast(f"struct<{fields}>")
    out = docs.withColumn(name, schema).schema
    return batch_map(docs, run, out), name


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is at most, threshold)."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self, struct: str) -> Column:
        def term(name, at_most, limit):
            value = F.col(f"`{struct}`.{name}")
            return value <= limit if at_most else value > limit

        return reduce(lambda a, b: a & b, [term(*t) for t in self.terms])


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weights: tuple[tuple[float, Rule], ...]

    def score(self, struct: str) -> Column:
        """Probability of label 1 as one expression over the struct of statistics."""
        total = reduce(
            lambda a, b: a + b,
            [F.when(rule.column(struct), F.lit(w)).otherwise(F.lit(0.0)) for w, rule in self.weights],
            F.lit(self.intercept),
        )
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _paths(node, terms=()) -> list[Rule]:
    found = [Rule(tuple(sorted(terms)))] if terms else []
    if node.numDescendants() > 0:
        split = node.split()
        name, limit = STATISTICS[split.featureIndex()], float(split.threshold())
        found += _paths(node.leftChild(), (*terms, (name, True, limit)))
        found += _paths(node.rightChild(), (*terms, (name, False, limit)))
    return found


def fit(rows: DataFrame, struct: str, label: str, trees: int = 16, depth: int = 3, penalty: float = 0.002) -> RuleEnsemble:
    """Fit on ``rows``, a bounded sample. The score is constant, the share of label 1, without both labels or any split."""
    counts = rows.agg(F.count(label).alias("n"), F.sum(label).alias("ones")).first()
    n, ones = counts.n, float(counts.ones or 0)
    share = (ones + 0.5) / (n + 1)
    constant = RuleEnsemble(float(np.log(share / (1 - share))), ())
    if ones in (0.0, float(n)):
        return constant
    inputs = rows.select(F.col(label).cast("double").alias("label"), F.col(struct).alias("s")).select("label", "s", "s.*")
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(inputs)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=5, subsamplingRate=0.8, seed=7)
    model = forest.fit(vectors.select("label", "features"))
    rules = list(dict.fromkeys(r for tree in model.trees for r in _paths(tree._call_java("rootNode"))))
    if not rules:
        return constant
    marked = materialize(
        inputs.select("label", *[rule.column("s").cast("double").alias(f"r{k}") for k, rule in enumerate(rules)]), "rules"
    )
    marked = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(marked)
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, maxIter=60, standardization=True)
    fitted = lasso.fit(marked.select("label", "features").coalesce(1))
    weights = [(float(w), rule) for w, rule in zip(fitted.coefficients.toArray(), rules, strict=True) if w != 0.0]
    return RuleEnsemble(float(fitted.intercept), tuple(weights))


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text modulo 5 is 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(stats: DataFrame, struct: str, labels: DataFrame, id_column: str = "doc_id", fit_rows: int = FIT_ROWS) -> RuleEnsemble:
    """Learn ``labels.quality`` from statistics of labelled rows that are not held out.

    Labels beside 0 and 1 and null ids are passed over, an id with several labels counts as 1 if half of
    them are. ``fit_rows`` bounds the rows learned from: those of the smallest hashes of their ids.
    """
    known = (
        labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").alias("_label_id"))
        .agg(F.avg("quality").alias("q")).select("_label_id", F.when(F.col("q") >= 0.5, 1).otherwise(0).alias("label"))
    )
    rows = stats.select(F.col(id_column).alias("_id"), F.col(struct).alias("s")).filter(~held_out("_id"))
    rows = rows.join(known, F.col("_id") == F.col("_label_id")).select("_id", "label", "s")
    rows = rows.orderBy(F.xxhash64("_id"), "_id", "s").limit(fit_rows).select("label", "s")
    return fit(materialize(rows, "fit"), "s", "label")


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score`` (0 to 1, higher: label 1 is likelier).

    Null and empty texts have the statistics of an empty text and are scored like others. Repeated rows come
    out repeated. A null id is not held out and has no label. An empty table gives an empty result; other
    columns of ``docs`` are not looked at.
    """
    stats, struct = with_statistics(docs.select(F.col(id_column), F.col(text_column)), text_column)
    stats = materialize(stats.drop(text_column), "statistics")
    model = fit_quality(stats, struct, labels, id_column)
    return stats.select(id_column, held_out(id_column).alias("held_out"), model.score(struct).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``least`` or more, all columns as they were."""
    stats, struct = with_statistics(docs.select(F.col(id_column), F.col(text_column)), text_column)
    model = fit_quality(materialize(stats.drop(text_column), "statistics"), struct, labels, id_column)
    rows, struct = with_statistics(docs, text_column)
    return rows.filter(model.score(struct) >= least).select(docs.columns)


def op10_quality_classifier(spark, sf_dir):
    """Scores of all documents for quality, learned from ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = quality_scores(documents(spark, sf_dir), labels)
    return scores.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
