"""Ranks, medians and row numbers over groups of any size.

A window over a whole group sorts that group in one task. Here a group is cut into ordered buckets by a
monotone function of the sort key: bucket totals (few rows) give each bucket its offset, and the
window runs inside one bucket only. Equal values are collapsed to one row with a count first, so ties
never pile up either. The results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def numeric_bucket(value: Column, per_octave: int = 64) -> Column:
    """Order-preserving bucket number: steps about 1 % wide in either direction from zero."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * per_octave)).cast("long")


def text_bucket(value: Column, chars: int = 2) -> Column:
    """Order-preserving bucket of a text: its first characters."""
    return F.substring(value, 1, chars)


def _running(df: DataFrame, part: list[str], order: Column, amount: str, out: str) -> DataFrame:
    previas = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(amount).over(previas), F.lit(0)))


def counts_before(df: DataFrame, group: list[str], value: str, descending: bool = False, bucket=numeric_bucket) -> DataFrame:
    """(group…, value, veces, antes): rows holding the value, and rows that sort before it in its group."""
    order = F.desc if descending else F.asc
    hist = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("veces"))
    hist = hist.withColumn("_cubeta", bucket(F.col(value)))
    cubetas = hist.groupBy(*group, "_cubeta").agg(F.sum("veces").alias("_n"))
    cubetas = _running(cubetas, group, order("_cubeta"), "_n", "_desde").drop("_n")
    hist = _running(hist, [*group, "_cubeta"], order(value), "veces", "_dentro")
    return (
        join_nullsafe(hist, cubetas, [*group, "_cubeta"])
        .select(*group, value, "veces", (F.col("_desde") + F.col("_dentro")).alias("antes"))
    )


def join_nullsafe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; the key columns of ``left`` are kept."""
    derecha = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    igual = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    junto = left.join(derecha, igual, how)
    return junto if how in ("left_semi", "left_anti") else junto.drop(*[f"_r_{k}" for k in keys])


def rank_desc(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """SQL ``rank()`` by ``value`` descending inside each group."""
    antes = counts_before(df, group, value, descending=True)
    rangos = antes.select(*group, value, (F.col("antes") + 1).cast("long").alias(out))
    return join_nullsafe(df, rangos, [*group, value])


def row_numbers(df: DataFrame, value: str, out: str, bucket=text_bucket) -> DataFrame:
    """1-based row number of distinct values in ascending order, over the whole DataFrame."""
    antes = counts_before(df, [], value, bucket=bucket)
    return df.join(antes.select(value, (F.col("antes") + 1).alias(out)), value)


def median(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Exact continuous median per group (NULLs ignored)."""
    datos = df.filter(F.col(value).isNotNull())
    antes = counts_before(datos, group, value)
    totales = datos.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    junto = join_nullsafe(antes, totales, group)
    bajo, alto = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)

    def cubre(pos: Column) -> Column:
        return (F.col("antes") <= pos) & (pos < F.col("antes") + F.col("veces"))

    v = F.col(value).cast("double")
    return (
        junto.filter(cubre(bajo) | cubre(alto))
        .groupBy(*group)
        .agg(((F.min(v) + F.max(v)) / 2).alias(out))
    )
