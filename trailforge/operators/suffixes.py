"""Registrable domains by a table of suffix rules, for lists too long for an expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.functions.url import etld1


def rules_table(rows: DataFrame) -> DataFrame:
    """suffix, wild of the lines (value) of a suffix file: comments and blank lines left out, exceptions as plain rules."""
    v = F.trim("value")
    lines = rows.select(v.alias("v")).where((v != "") & ~v.startswith("//"))
    return lines.select(F.regexp_replace("v", r"^(?:!|\*\.)", "").alias("suffix"), F.col("v").startswith("*.").alias("wild")).distinct()


def registrable(rows: DataFrame, domain: str, rules: DataFrame, out: str = "etld1") -> DataFrame:
    """rows with the registrable domain, as ``functions.url.etld1`` gives it for the same rules (suffix, wild).

    Each distinct domain's suffixes meet the rules by equality. A plain rule holds where its suffix begins; a wildcard
    holds for the whole domain if that has more labels. The longest suffix goes first.
    """
    d = F.regexp_replace(F.lower(domain), r"^\.+|\.+$", "")
    one = rows.select(domain).where(F.col(domain).isNotNull()).distinct().select(domain, d.alias("_d"), F.split(d, r"\.").alias("_p"))
    parts = one.select("_d", "_p", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("_p")), lambda i: F.array_join(F.slice("_p", i, F.size("_p")), "."))).alias("_i", "suffix"))
    hits = parts.join(rules, "suffix").select("_d", "_p", F.when(~F.col("wild"), F.col("_i")).when(F.col("_i") > 0, 0).alias("_i")).where("_i is not null")
    first = hits.groupBy("_d").agg(F.min("_i").alias("_i"), F.any_value("_p").alias("_p"))
    found = first.select("_d", F.when(F.col("_i") > 0, F.array_join(F.slice("_p", F.col("_i"), F.size("_p")), ".")).otherwise(F.col("_d")).alias("_e"))
    named = one.join(found, "_d", "left").select(domain, F.coalesce("_e", etld1(F.col("_d"), [], [])).alias(out))
    return rows.join(named, domain, "left")
