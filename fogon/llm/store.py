"""Cutting lineage: tables written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.functions.sizing import plan_bytes
from fogon.session import shared_dir, ship, tune

BUCKET_BYTES = 16 << 20  # of input for each hash bucket
UNKNOWN_BYTES = 1 << 60  # estimates beyond it say nothing


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators, and the package on the executors."""
    ship(spark)
    return tune(spark)


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below spark.checkpoint.dir, so that a lost executor costs no more than a reread."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame, column: str) -> int:
    """Size of one column: what the scan of its files says, or what is counted where the plan has no estimate."""
    estimate = plan_bytes(df.select(column))
    return estimate if estimate < UNKNOWN_BYTES else df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def buckets(df: DataFrame, column: str, per_partition: int = 4) -> int:
    """Number of hash buckets: in proportion to the input, so that a bucket stays as large as it is; at least some for each shuffle partition."""
    return max(per_partition * partitions(df.sparkSession), -(-input_bytes(df, column) // BUCKET_BYTES))
