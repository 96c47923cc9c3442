"""URL filter: host-suffix and path-prefix expressions, matched by hashes.

A rule is a host and a path. A URL is expanded into the expressions that rules could have for it: suffixes of its host of as many
labels as a rule has, joined with prefixes of its path of as many characters as that rule's path has. Expressions and
rules meet in an equi-join on a short hash prefix; whole digests confirm, and the longest rule wins. Only
DataFrame functions touch the URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelight.llm.tables import hint_small
from farelight.session import materialize

# Verdict, host and path of the base rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Labels of hosts that are blocked where no rule fits, as whole words between dots and hyphens.
BLOCKED_WORDS = ("ads", "adult", "bets", "casino", "cheap", "pills", "porn", "spam", "track", "warez", "xxx")

#: Shapes (labels of the host, characters of the path) that the rules of one run may have; each is an expression per URL.
MOST_SHAPES = 10_000

#: Hexadecimal digits of the short hash.
SHORT = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://``."""
    rest = _rest(url)
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def labels_of(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The expressions of a URL for rules of the given shapes: labels of the host, characters of the path.

    A host of any number of labels costs one look at it per shape.
    """
    known = F.array(*[F.struct(F.lit(k).alias("labels"), F.lit(n).alias("length")) for k, n in shapes])
    fitting = F.filter(known, lambda s: (s["labels"] <= labels_of(host)) & (s["length"] <= F.length(path)))
    pairs = F.transform(
        fitting,
        lambda s: F.struct(
            F.call_function("substring_index", host, F.lit("."), -s["labels"]).alias("host"), F.substring(path, F.lit(1), s["length"]).alias("path")
        ),
    )
    return F.when(host == "", F.array().cast("array<struct<host: string, path: string>>")).otherwise(pairs)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def short(host: Column, path: Column) -> Column:
    return F.substring(F.md5(F.concat(host, F.lit("\n"), path)), 1, SHORT)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Per row of ``pages``: id, ``host``, ``path``, ``rule`` that fits best, ``verdict``.

    A rule (verdict, host, path) fits its host and all subdomains of it when the path of the URL starts with the
    rule's. The longest rule wins, then the longer host, then block before allow. Without a rule the host decides: one that
    is empty or has a blocked word is blocked, all others are allowed. A null URL has an empty host and
    path, as one without ``://``. Null ids, repeated ids and repeated rows are judged row by row. An empty
    table gives an empty result, without rules every URL is judged by its host; other columns are not looked at.
    """
    url = F.col(url_column)
    rows = pages.select(F.col(id_column).alias("id"), F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"))
    # The same scan gives the same ids again when a task is repeated.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    stored = materialize(
        rules.select("verdict", "host", "path").distinct().select(
            short(F.col("host"), F.col("path")).alias("short"),
            digest(F.col("host"), F.col("path")).alias("digest"),
            F.struct(
                (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
                F.col("verdict"), F.concat("host", "path").alias("rule"), F.length("path").alias("path_length"),
            ).alias("found"),
            labels_of(F.col("host")).alias("labels"),
        ),
        "rules",
    )
    shapes = stored.select("labels", "found.path_length").distinct().orderBy("labels", "path_length").limit(MOST_SHAPES + 1).collect()
    if len(shapes) > MOST_SHAPES:
        raise ValueError(f"rules have more than {MOST_SHAPES} shapes; judge them in several runs")
    asked = rows.withColumn("asked", F.explode_outer(expressions(F.col("host"), F.col("path"), [tuple(r) for r in shapes] or [(1, 0)])))
    asked = asked.withColumn("short", short(F.col("asked.host"), F.col("asked.path")))
    met = asked.join(hint_small(stored), "short", "left")
    sure = F.when(F.col("digest") == digest(F.col("asked.host"), F.col("asked.path")), F.col("found"))
    best = met.groupBy("row", "id", "host", "path").agg(F.max(sure).alias("best"))
    word = "(^|[.-])(" + "|".join(BLOCKED_WORDS) + ")([.-]|$)"
    own = F.when((F.col("host") == "") | F.col("host").rlike(word), "block").otherwise("allow")
    return best.select(
        F.col("id").alias(id_column), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", own).alias("verdict")
    )


def op5_url_filter(spark, sf_dir):
    """Verdicts on all pages."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_table(spark))


OP5_SQL = f"""
    WITH rules AS (SELECT * FROM (VALUES {", ".join(str(r) for r in RULES)}) r(v, h, p)),
    cut AS (
      SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    parts AS (
      SELECT page_id, row_number() OVER () AS row,
             translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM cut),
    fits AS (
      SELECT row, arg_max(h || p, length(h) + length(p)) AS rule, arg_max(v, length(h) + length(p)) AS verdict
      FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY row)
    SELECT page_id, host, path, rule,
           coalesce(verdict, CASE WHEN host = '' OR regexp_matches(host, '(^|[.-])({"|".join(BLOCKED_WORDS)})([.-]|$)')
                             THEN 'block' ELSE 'allow' END) AS verdict
    FROM parts LEFT JOIN fits USING (row)"""
