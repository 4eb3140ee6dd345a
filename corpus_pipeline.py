"""Cleaning of a document corpus in five stages, from toxicity to packed training sequences.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fogon.llm import op1_packing, op5_toxicity, op6_lines, op8_jaccard, op10_secrets
from fogon.llm.store import cut, prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model doesn't call toxic; it is fitted on a bounded sample of labelled ones."""
    prepare(spark)
    model = op5_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op5_toxicity.score(docs, model).filter("not toxic").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows. A document of which no line is left goes."""
    return op6_lines.dedup_lines(docs).filter("n_removed < n_lines").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by similar sets of word shingles, the one of the smallest id; of rows equal in id and text, one.

    A row goes only because of its own text: other rows of its doc_id decide nothing. Rows without an id stay.
    """
    first = op8_jaccard.first_of_classes(docs).withColumnsRenamed({"doc_id": "_doc", "print": "_print"})
    named = docs.join(first, (F.col("doc_id") == F.col("_doc")) & (F.xxhash64("text") == F.col("_print")))
    one = Window.partitionBy("_doc", "_print").orderBy("text")
    kept = named.withColumn("_row", F.row_number().over(one)).filter("_row = 1")
    return kept.select(docs.columns).union(docs.filter("doc_id is null"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark."""
    return op10_secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, along a space-filling curve."""
    import public_tokenizers

    return op1_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("packing", packing),
]

# SQL can express neither the trained model nor the curve, so the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
