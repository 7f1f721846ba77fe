"""The registered queries of the corpus operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import op5_byte_bpe
from .common import importable
from .merkle_manifest import OP13_SQL, op13_merkle_manifest
from .mixing import op8_mixing
from .ngram_join import op2_ngram_join
from .pii import op1_pii
from .quality_nbsvm import op4_quality_nbsvm
from .quality_rules import op10_quality_rules
from .spelling_variants import OP11_SQL, op11_spelling_variants
from .token_files import op12_token_files
from .topk_search import OP3_SQL, op3_topk_search
from .toxicity_mil import op9_toxicity_mil
from .url_filters import OP6_SQL, op6_url_filters
from .warc import op7_warc

_BUILDERS = (
    op1_pii, op2_ngram_join, op3_topk_search, op4_quality_nbsvm, op5_byte_bpe, op6_url_filters, op7_warc, op8_mixing,
    op9_toxicity_mil, op10_quality_rules, op11_spelling_variants, op12_token_files, op13_merkle_manifest,
)


def _with_workers(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return build(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {b.__name__: _with_workers(b) for b in _BUILDERS}


def oracle_sql() -> dict[str, str]:
    return {"op3_topk_search": OP3_SQL, "op6_url_filters": OP6_SQL, "op11_spelling_variants": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
