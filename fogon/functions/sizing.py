"""Size estimates of inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's upper estimate of the size of ``df`` (file sizes scaled by the columns read)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Rows that the driver gathers for a broadcast at most: some 100 bytes each, and as many again in the table it builds of them.
FILAS_A_DIFUNDIR = 500_000


def never_broadcast(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is shuffled whatever its files' size.

    Spark takes the size of a table from its files, where an id takes a byte or two, and more rows made of each (one a source) are not
    counted at all. So a table of millions of ids passes for a small one, and its broadcast takes a hundred times its estimate of the driver's memory.
    """
    return df.hint("merge")


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join with much larger rows: left to Spark where it has few rows, never broadcast otherwise."""
    return df if df.limit(FILAS_A_DIFUNDIR + 1).count() <= FILAS_A_DIFUNDIR else never_broadcast(df)
