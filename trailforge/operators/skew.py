"""Joins that stay spread where one key holds many rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this many rows and this share of all rows on: so at most 1 / SHARE keys are hot.
LEAST, SHARE = 1000, 0.001


def hot_keys(counts: DataFrame, keys: tuple[str, ...], n: str, total: int) -> DataFrame | None:
    """keys and _salts of the hot ones (1 / SHARE rows at most), from each key's number of rows. None if there can't be one."""
    bound = max(LEAST, int(total * SHARE))
    if total <= bound:
        return None
    return counts.where(F.col(n) > bound).select(*keys, F.ceil(F.col(n) / F.lit(bound)).cast("int").alias("_salts"))


def salted_join(rows: DataFrame, table: DataFrame, keys: tuple[str, ...], hot: DataFrame | None, spread: Column, how: str = "inner") -> DataFrame:
    """rows with table (one row for each key). A hot key's rows are dealt by ``spread`` to parts, its row of table is copied to each.

    Only the hot keys are broadcast, whose number is bounded, not their rows of table. Keys that are null match nothing.
    """
    if hot is None:
        return rows.join(table, list(keys), how)
    hot = F.broadcast(hot)
    one = F.lit(1)
    left = rows.join(hot, list(keys), "left").withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_salts", one)).cast("int")).drop("_salts")
    right = table.join(hot, list(keys), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", one) - 1))).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
