"""Pairs of members of the same group, for operators whose result is those pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Members of one group that are paired inside one cell; larger groups are cut into blocks.
BLOQUE = 256


def pairs_within(df: DataFrame, group: list[str], member: str, block: int = BLOQUE) -> DataFrame:
    """Pairs member1 < member2 of each group; every other column comes as ``<name>1`` and ``<name>2``.

    ``df`` has one row per (group, member). No task has to hold a whole group: members of a group with more
    than ``block`` of them are hashed into blocks, and each pair of blocks is a join key of its own, so a
    group of n members spreads over about (n / block)² / 2 keys of bounded size. Only the rows of large
    groups are copied (once per block).
    """
    large = (
        df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
        .select(*group, F.ceil(F.col("_n") / block).cast("int").alias("_k"))
    )
    k = F.coalesce("_k", F.lit(1))
    rows = (
        df.join(large, group, "left")
        .withColumn("_b", F.pmod(F.xxhash64(member), k).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), k - 1)).alias("_j"))
        .withColumns({"_c1": F.least("_b", "_j"), "_c2": F.greatest("_b", "_j")})
        .drop("_k", "_j")
    )
    cell = [*group, "_c1", "_c2"]
    own = [c for c in rows.columns if c not in cell]
    left, right = (rows.withColumnsRenamed({c: f"{c}{i}" for c in own}) for i in (1, 2))
    once = (F.col("_c1") == F.col("_c2")) | (F.col("_b1") != F.col("_b2"))
    pairs = left.join(right, cell).filter((F.col(f"{member}1") < F.col(f"{member}2")) & once)
    return pairs.drop("_c1", "_c2", "_b1", "_b2")
