"""Streams: events joined with stored sessions, first events within a watermark, counts by window. An extension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.functions.constants import SLOP_SECONDS
from trailforge.operators.joins import BIN_SECONDS


def matches(events: DataFrame, sessions: DataFrame, slop: int = SLOP_SECONDS, late: str = "1 hour") -> DataFrame:
    """Stream of events (event_id, t) with the longest stored session (stream, start, end) that each falls into.

    Stream-static join by time bins, then one aggregation by event within the watermark; later events are dropped.
    """
    second = lambda c: F.unix_micros(c) / F.lit(1_000_000)
    s = sessions.withColumn("_bin", F.explode(F.sequence(F.floor((second(F.col("start")) - slop) / BIN_SECONDS), F.floor((F.greatest(second(F.col("end")) + slop, second(F.col("start")))) / BIN_SECONDS))))
    gap = F.expr(f"interval {slop} seconds")
    e = events.withWatermark("t", late).withColumn("_bin", F.floor(second(F.col("t")) / BIN_SECONDS))
    pairs = e.join(s, "_bin").where((F.col("t") >= F.col("start") - gap) & ((F.col("t") < F.col("start")) | (F.col("t") <= F.col("end") + gap)))
    return pairs.groupBy("event_id", "t").agg(F.max(F.struct((second(F.col("end")) - second(F.col("start"))).alias("len"), "start", "stream", "end")).alias("s")).select(
        "event_id", "t", F.col("s.stream").alias("stream"), F.col("s.start").alias("start"), F.col("s.len").cast("long").alias("duration_hint")
    )


def first_visits(events: DataFrame, keys: tuple[str, ...], late: str = "1 hour") -> DataFrame:
    """Each key's first event; its state goes when the watermark passes."""
    return events.withWatermark("t", late).dropDuplicatesWithinWatermark(list(keys))


def counts(events: DataFrame, by: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("t", late).groupBy(F.window("t", window), by).count()
