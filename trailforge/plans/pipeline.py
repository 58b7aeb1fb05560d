"""The whole chain over enriched events: validate, golden sample, examples, statistics and training settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.operators import sampling, stats, validate
from trailforge.plans import layouts


@dataclass
class Prepared:
    errors: DataFrame
    coverage: DataFrame
    golden: DataFrame | None
    examples: DataFrame
    lengths: DataFrame
    config: DataFrame


def prepare(events: DataFrame, as_of: str, golden_size: int = 150, layout: str = "v1", skip_golden: bool = False) -> Prepared:
    """events: rows of the JSON Lines reader. Nothing runs until one of the results is used."""
    checked = validate.layout_a(events, as_of)
    errors = stats.error_counts(checked, ("schema_errors", "youtube_errors", "session_errors", "label_errors"))
    keyed = events.withColumn("event_id", F.sha2("_raw", 256)).withColumns({"reason": F.col("labels.reason"), "has_meta": F.col("content_meta").isNotNull(), "has_session": F.coalesce(F.col("session_id") != "", F.lit(False))})
    golden = None if skip_golden else sampling.golden(keyed, golden_size)
    examples = {"v1": layouts.layout_v1, "v2": layouts.layout_v2, "v3": layouts.layout_v3}[layout](events)
    lengths = stats.lengths(examples)
    return Prepared(errors, stats.coverage(events, as_of), golden, examples, lengths, stats.training_config(lengths))
