"""Reproducible samples and splits: order by md5 of seed and key, never by a random generator."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.functions.url import is_youtube
from trailforge.operators.dedup import cut

SEED = 42


def shuffled(key: Column, seed: int | str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def spot_check(rows: DataFrame, key: str, n: int = 10, seed: int = SEED) -> DataFrame:
    return rows.orderBy(shuffled(F.col(key), seed), key).limit(n)


def head(rows: DataFrame, order: str, n: int | None) -> DataFrame:
    """The first n rows in order; all of them for 0 or None."""
    return rows.orderBy(order).limit(n) if n else rows


def per_group(rows: DataFrame, by: str, key: str, n: int, seed: int | str = SEED) -> DataFrame:
    w = Window.partitionBy(by).orderBy(shuffled(F.col(key), seed), key)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def golden(events: DataFrame, size: int = 150, key: str = "event_id", seed: int = SEED) -> DataFrame:
    """Stratified sample of events (key, url, reason, has_meta, has_session) in five stages, then cut to size.

    Each reason gets max(5, size // reasons); then videos with and without data, events with a session, and any others
    fill up, each stage by hashed order. Urls that an earlier stage has are left out. Only the sample's counts reach the
    driver; the sample itself has at most a bounded number of rows.
    """
    e = events.withColumn("reason", F.coalesce("reason", F.lit("NONE")))
    reasons = e.select("reason").distinct().count()
    picked = cut(per_group(e, "reason", key, max(5, size // max(1, reasons)), seed))
    video = is_youtube(F.coalesce("url", F.lit("")))
    stages = [(video & F.col("has_meta"), min(30, size // 5)), (video & ~F.col("has_meta"), 10), (F.col("has_session"), 20), (F.lit(True), size)]
    for i, (which, most) in enumerate(stages):
        room = size - picked.count()
        if room <= 0:
            break
        pool = e.where(which)
        if i == len(stages) - 1:
            pool = pool.join(picked.select("url").distinct(), "url", "left_anti").select(*e.columns)
        new = spot_check(pool, key, min(most, room), seed)
        # A sample of bounded size: written, so that no stage computes the earlier ones again.
        picked = cut(picked.unionByName(new.join(picked.select("url").distinct(), "url", "left_anti").select(*e.columns)))
    return spot_check(picked, key, size, f"{seed}c")


def golden_by_topic(rows: DataFrame, topic: str, order: str, size: int = 100, candidates: int = 200, seed: int = SEED) -> DataFrame:
    """Of the first rows, as many from each topic as fit, in hashed order inside a topic, at most size."""
    head = rows.orderBy(order).limit(candidates)
    topics = max(1, head.select(topic).distinct().count())
    w = Window.partitionBy(topic).orderBy(shuffled(F.col(order), seed), order)
    return head.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= max(1, size // topics)).orderBy(topic, "_n").drop("_n").limit(size)


def shown(rows: DataFrame, by: str, key: str, sample: int = 200, each: int = 3, seed: int = SEED) -> DataFrame:
    """Of a sample of rows, the first few of each group."""
    return per_group(spot_check(rows, key, sample, seed), by, key, each, seed)


def rank_split(rows: DataFrame, domain: str, seed: int = SEED) -> DataFrame:
    """split by domain: of n domains in hashed order int(0.8 n) train, int(0.1 n) val, the rest test; none is in two.

    Domains are counted and ranked by their hash's first byte: counts of 256 groups give each group's offset, so that no
    task has to hold all domains in order.
    """
    domains = rows.select(domain).where(F.col(domain).isNotNull()).distinct().withColumn("_h", shuffled(F.col(domain), seed)).withColumn("_g", F.substring("_h", 1, 2))
    groups = domains.groupBy("_g").count()
    total = groups.agg(F.sum("count")).first()[0] or 0
    offsets = groups.select("_g", (F.sum("count").over(Window.orderBy("_g")) - F.col("count")).alias("_o"))
    ranked = domains.join(F.broadcast(offsets), "_g").withColumn("_r", F.row_number().over(Window.partitionBy("_g").orderBy("_h", domain)) + F.col("_o"))
    a, b = int(total * 0.8), int(total * 0.1)
    split = F.when(F.col("_r") <= a, "train").when(F.col("_r") <= a + b, "val").otherwise("test")
    return rows.join(ranked.select(domain, split.alias("split")), domain, "left")


def mersenne_split(domains: DataFrame, domain: str) -> DataFrame:
    """domain, split of distinct domains, by the first number of Python's generator seeded with the md5. Arrow batches."""

    @F.pandas_udf("string")
    def split(d: pd.Series) -> pd.Series:
        import random

        def one(x: str) -> str:
            r = random.Random(int(hashlib.md5(x.encode()).hexdigest(), 16)).random()
            return "train" if r < 0.8 else "val" if r < 0.9 else "test"

        return d.map(one)

    return domains.select(domain).where(F.col(domain).isNotNull()).distinct().withColumn("split", split(F.col(domain)))
