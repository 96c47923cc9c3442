"""The registered queries of the operators for training data, and equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farelight.llm.decontaminate import OP6_SQL, op6_benchmark_decontamination
from farelight.llm.fill_middle import OP12_SQL, op12_fill_in_middle
from farelight.llm.language_id import op2_language_id
from farelight.llm.license_scan import op4_license_scan
from farelight.llm.mixing import OP3_SQL, mixing_shards, op3_mixing_sources
from farelight.llm.multi_index import op8_approximate_neighbours
from farelight.llm.ngram_join import OP1_SQL, op1_ngram_jaccard_join
from farelight.llm.quality_rules import op10_quality_classifier
from farelight.llm.secret_scan import op7_secret_scan
from farelight.llm.setsketch import OP11_SQL, op11_setsketch_dedup
from farelight.llm.sharding import op9_sharding
from farelight.llm.spelling import OP13_SQL, op13_spelling_variants
from farelight.llm.url_filter import OP5_SQL, op5_url_filter

_ALL = (
    op1_ngram_jaccard_join,
    op2_language_id,
    op3_mixing_sources,
    op4_license_scan,
    op5_url_filter,
    op6_benchmark_decontamination,
    op7_secret_scan,
    op8_approximate_neighbours,
    op9_sharding,
    op10_quality_classifier,
    op11_setsketch_dedup,
    op12_fill_in_middle,
    op13_spelling_variants,
    mixing_shards,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op3_mixing_sources": OP3_SQL,
    "op5_url_filter": OP5_SQL,
    "op6_benchmark_decontamination": OP6_SQL,
    "op11_setsketch_dedup": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
