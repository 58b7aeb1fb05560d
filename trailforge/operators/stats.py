"""Reports: coverage, distributions, length statistics, training settings. One pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.functions.sft import truthy
from trailforge.functions.time import within_calendar_years, within_years
from trailforge.functions.url import is_youtube


def has_meta(events: DataFrame) -> Column:
    """Whether an event has data of its page; an empty object has none. Told by the JSON line where there is one."""
    there = F.col("content_meta").isNotNull()
    if "_raw" in events.columns:
        there = there & (F.size(F.coalesce(F.json_object_keys(F.get_json_object("_raw", "$.content_meta")), F.array())) > 0)
    return there


def rate(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))


def golden_metrics(events: DataFrame) -> DataFrame:
    """One row of counts and shares of a sample."""
    url = F.coalesce("url", F.lit(""))
    meta = has_meta(events)
    counts = events.agg(
        F.count("*").alias("total"), F.count_if(meta).alias("enriched"), F.count_if(is_youtube(url)).alias("youtube_urls"), F.count_if(is_youtube(url) & meta).alias("youtube_enriched"),
        F.count_if(truthy(F.col("session_id"), "string")).alias("with_session"), F.count_if(truthy(F.col("labels.reason"), "string")).alias("with_labels"),
    )
    rates = {"enrichment_rate": ("enriched", "total"), "youtube_enrichment_rate": ("youtube_enriched", "youtube_urls"), "session_join_rate": ("with_session", "total"), "label_coverage": ("with_labels", "total")}
    return counts.withColumns({k: rate(*v) for k, v in rates.items()})


def coverage_percent(events: DataFrame) -> DataFrame:
    """One row of counts and percentages; a share of nothing is 0."""
    url = F.coalesce("url", F.lit(""))
    meta = has_meta(events)
    counts = events.agg(
        F.count("*").alias("total_events"), F.count_if(meta).alias("cache_hits"), F.count_if(truthy(F.col("session_id"), "string")).alias("session_joins"),
        F.count_if(is_youtube(url)).alias("youtube_events"), F.count_if(is_youtube(url) & meta).alias("youtube_enriched"),
    )
    rates = {"cache_coverage_pct": ("cache_hits", "total_events"), "session_coverage_pct": ("session_joins", "total_events"), "youtube_coverage_pct": ("youtube_enriched", "youtube_events")}
    return counts.withColumns({k: rate(*v) * 100 for k, v in rates.items()})


def bad_timestamps(events: DataFrame, as_of: str, order: str, n: int = 5) -> DataFrame:
    """The first few rows whose time is missing, unreadable or more than two calendar years off."""
    return events.where(~within_calendar_years(F.col("visited_at_iso"), as_of)).orderBy(order).limit(n).select(order, "visited_at_iso")


def schema_misses(events: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of the JSON lines that lack a key, which is only a warning: _raw and the keys."""
    missing = F.array_except(F.array(*map(F.lit, keys)), F.coalesce(F.json_object_keys("_raw"), F.array().cast("array<string>")))
    return events.withColumn("missing", missing).where(F.size("missing") > 0)


def first_errors(rows: DataFrame, cols: tuple[str, ...], order: str, n: int = 10) -> DataFrame:
    """kind, order, errors of the first rows with errors of each kind."""
    each = rows.select(order, F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("errors")) for c in cols])).alias("x"))
    bad = each.select("x.kind", order, "x.errors").where(F.size("errors") > 0)
    return bad.withColumn("_n", F.row_number().over(Window.partitionBy("kind").orderBy(order))).where(F.col("_n") <= n).drop("_n")


def coverage(events: DataFrame, as_of: str) -> DataFrame:
    """One row of counts and shares; a share of nothing is 0."""
    url = F.coalesce("url", F.lit(""))
    meta = has_meta(events)
    counts = events.agg(
        F.count("*").alias("total_events"),
        F.count_if(meta).alias("cache_hits"),
        F.count_if(truthy(F.col("session_id"), "string")).alias("session_joins"),
        F.count_if(is_youtube(url)).alias("youtube_urls"),
        F.count_if(is_youtube(url) & meta).alias("youtube_enriched"),
        F.count_if(within_years(F.col("visited_at_iso"), as_of)).alias("valid_timestamps"),
        F.count_if(truthy(F.col("labels.reason"), "string")).alias("labeled_events"),
    )
    return counts.withColumns(
        {
            "cache_hit_rate": rate("cache_hits", "total_events"),
            "session_join_rate": rate("session_joins", "total_events"),
            "youtube_enrichment_rate": rate("youtube_enriched", "youtube_urls"),
            "timestamp_validity_rate": rate("valid_timestamps", "total_events"),
            "label_coverage_rate": rate("labeled_events", "total_events"),
        }
    )


def distribution(rows: DataFrame, col: str, missing: str = "unknown") -> DataFrame:
    """value, n, pct."""
    counts = rows.groupBy(F.coalesce(F.col(col), F.lit(missing)).alias("value")).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def top(rows: DataFrame, col: str, k: int) -> DataFrame:
    return rows.where(F.col(col).isNotNull() & (F.col(col) != "")).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def lengths(rows: DataFrame, context: str = "context", instruction: str = "instruction") -> DataFrame:
    """Least, greatest, mean and upper median of lengths. The median comes from counts by length, not from a list of rows."""
    sized = rows.select(F.length(F.coalesce(context, F.lit(""))).alias("c"), F.length(F.coalesce(instruction, F.lit(""))).alias("i"))
    base = sized.agg(
        F.count("*").alias("total_examples"), F.min("c").alias("context_min"), F.max("c").alias("context_max"), F.avg("c").alias("context_mean"),
        F.min("i").alias("instruction_min"), F.max("i").alias("instruction_max"), F.avg("i").alias("instruction_mean"),
    )
    counts = sized.groupBy("c").agg(F.count("*").alias("n"))
    run = counts.select("c", F.sum("n").over(Window.orderBy("c")).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("total"))
    median = run.where(F.col("upto") > F.expr("total div 2")).agg(F.min("c").alias("context_median"))
    return base.join(F.broadcast(median))


def training_config(stats: DataFrame) -> DataFrame:
    mean = F.coalesce("context_mean", F.lit(500.0))
    pick = lambda a, b, c: F.when(mean < 500, a).when(mean < 2000, b).otherwise(c)
    return stats.select(
        "total_examples",
        (F.col("total_examples") * (mean / 4)).cast("long").alias("estimated_tokens"),
        mean.cast("long").alias("mean_context_length"),
        pick(8, 4, 2).alias("batch_size"),
        pick(2, 4, 8).alias("gradient_accumulation_steps"),
        (mean * 1.5).cast("long").alias("max_seq_length"),
        F.lit(2e-5).alias("learning_rate"),
        F.lit(3).alias("num_epochs"),
    )


def error_counts(rows: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Rows with at least one error, for each array of errors, and whether all are free of errors."""
    counts = rows.agg(*[F.count_if(F.size(c) > 0).alias(c) for c in cols])
    clean = F.lit(True)
    for c in cols:
        clean = clean & (F.col(c) == 0)
    return counts.withColumn("validation_passed", clean)


def perplexity(nll: DataFrame, col: str = "nll", label: str = "label") -> DataFrame:
    """exp of the mean loss over labels that aren't masked."""
    return nll.where(F.col(label) != -100).agg(F.exp(F.avg(col)).alias("perplexity"))
