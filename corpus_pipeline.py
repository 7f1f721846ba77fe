"""A corpus pipeline of five stages: quality, near duplicates, personal data, mixing, tokens.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; ``run`` writes what a stage returns as
Parquet into the shared folder and hands the reread table to the next. All stages but the last return the columns of
``documents``:

1. quality_classifier: documents that score below the threshold go.
2. ngram_jaccard_join: of each group of near duplicates the document with the least id stays (of equal ids, the first
   row).
3. pii: every span of personal data becomes its kind in brackets; ``n_chars``, if there, follows the text.
4. mixing: the rows in the order of the mixture of their sources, range by range of files; none is dropped.
5. byte_bpe: doc_id, source, n_tokens, ids (token ids as little-endian unsigned 32-bit integers) and round_trip (whether
   the decoded ids are the text again).

Defined cases, in every stage: a null text counts as an empty one and stays null in the kept rows; rows of equal or null
doc_id are rows of their own (stage 2 keeps the first of equal texts); texts are taken whole, however long; further
columns, whatever their names, go along up to stage 4; a null source is a source; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.llm.byte_bpe import VOCABULARY, bpe_round_trip
from adjudica.llm.common import importable, shared_folder, table
from adjudica.llm.mixing import in_order, mixed
from adjudica.llm.ngram_join import near_duplicates
from adjudica.llm.pii import redacted
from adjudica.llm.quality_nbsvm import keep_quality, train_quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return keep_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    # The row number makes rows of one id, or of none, distinct; it is that of the same scan both times. The row itself
    # is one struct, so no column of the table can be taken for the number.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row"))
    keyed = rows.select(F.struct(F.col("doc.doc_id").alias("doc_id"), "row").alias("key"), F.col("doc.text").alias("text"))
    kept = near_duplicates(keyed, key="key").where(F.col("key.row") == F.col("component_id.row")).select("key.row")
    return rows.join(kept, "row", "left_semi").select("doc.*")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    clean = redacted(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_order(mixed(docs))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    keyed = docs.select(F.struct("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")).alias("_key"), "text")
    encoded = bpe_round_trip(keyed, public_tokenizers.path(VOCABULARY), key="_key")
    return encoded.select(
        "_key.doc_id", "_key.source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.sha2("decoded", 256) == F.col("_key.sha")).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("pii", pii),
    ("mixing", mixing),
    ("byte_bpe", byte_bpe),
]

# A fitted classifier and token ids are beyond SQL; tests/llm compares run() with a plain Python version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
