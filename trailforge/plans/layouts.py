"""Row drivers: enriched events to instruction examples, in three layouts, and pages to examples directly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.functions import ids, sft, text, url
from trailforge.functions import time as T
from trailforge.functions.constants import MIN_CONTEXT
from trailforge.operators.dedup import cut, exact_first, greedy_kept
from trailforge.operators.sampling import head, mersenne_split, rank_split
from trailforge.operators.validate import example_reason

META = ("title", "channel", "publishDate", "duration", "views", "keywords")


def _meta() -> dict:
    return {k: F.col(f"content_meta.{k}") for k in META}


def layout_v1(events: DataFrame, least: int = 10) -> DataFrame:
    """instruction, context, response, meta; split by the hash of the row's id."""
    e = events.where(sft.truthy(F.col("url"), "string"))
    sid = ids.event_id_v1(*(F.col(c) for c in ("browser", "profile", "url", "visited_at_iso")))
    e = e.withColumn("_id", sid).withColumn("_context", sft.context("v1", F.col("transcript_excerpt"), F.col("title"), F.col("url"), _meta()))
    title = F.when(sft.truthy(F.col("title"), "string"), F.col("title")).otherwise(F.col("content_meta.title"))
    return e.where(F.length("_context") >= least).select(
        sft.instruction(F.coalesce("labels.reason", F.lit("general")), F.col("content_meta.is_shorts"), F.col("content_meta.duration"), "v1").alias("instruction"),
        F.col("_context").alias("context"),
        F.lit("").alias("response"),
        F.struct(
            "url", title.alias("title"), T.normalised(F.col("visited_at_iso")).alias("ts"), url.normal_domain(F.col("url")).alias("domain"),
            sft.reason_topic(F.col("labels.reason")).alias("topic"), F.col("_id").alias("source_id"), ids.chunk_id(F.col("_id"), F.lit(0)).alias("chunk_id"),
            F.lit(False).alias("generated"), F.length("_context").alias("length_chars"), ids.hash_split(F.col("_id")).alias("split_hint"),
        ).alias("meta"),
    )


def layout_v2(events: DataFrame, least: int = 10) -> DataFrame:
    """The second layout; split by domain through the seeded generator, made once for each domain."""
    e = events.where(sft.truthy(F.col("url"), "string")).withColumn("_domain", url.last_two_labels(F.col("url")))
    e = e.join(mersenne_split(e, "_domain").withColumnRenamed("split", "_split"), "_domain", "left")
    return _v2(e, least)


def _v2(e: DataFrame, least: int) -> DataFrame:
    sid = ids.event_id_v2(*(F.col(c) for c in ("browser", "profile", "url", "visited_at_iso")))
    e = e.withColumn("_id", sid).withColumn("_context", sft.context("v2", F.col("transcript_excerpt"), F.col("title"), F.col("url"), _meta()))
    full = lambda c: F.when(sft.truthy(F.col(c), "string"), F.col(c))
    reason = F.coalesce("labels.reason", F.lit("general"))
    return e.where(F.length("_context") >= least).select(
        sft.instruction(reason, F.col("content_meta.is_shorts"), F.col("content_meta.duration"), "v2").alias("instruction"),
        F.col("_context").alias("context"),
        F.lit("").alias("response"),
        F.struct(
            "url", full("title").alias("title"), full("visited_at_iso").alias("ts"), F.col("_domain").alias("domain"), reason.alias("topic"),
            F.col("_id").alias("source_id"), ids.chunk_id(F.col("_id"), F.lit(0)).alias("chunk_id"), F.lit(False).alias("generated"),
            F.length("_context").alias("length_chars"), F.col("_split").alias("split_hint"),
        ).alias("meta"),
    )


def layout_v3(events: DataFrame, first: int | None = None, order: str = "visited_at_iso") -> DataFrame:
    """The short layout: every event (or the first ones in an order), other metadata, no split."""
    return head(events, order, first).select(
        sft.instruction(F.col("labels.reason"), F.col("content_meta.is_shorts"), F.col("content_meta.duration"), "v3").alias("instruction"),
        sft.context("v3", F.col("transcript_excerpt"), F.col("title"), F.col("url"), _meta()).alias("context"),
        F.lit("").alias("response"),
        F.struct("browser", "profile", "url", "domain", "title", "visited_at_iso", F.col("labels.reason").alias("reason"), F.coalesce("labels.topics", F.array().cast("array<string>")).alias("topics"), "duration_hint").alias("meta"),
    )


def of_split(examples: DataFrame, split: str) -> DataFrame:
    """The examples of one split; over a table that is partitioned by it, only that partition is read."""
    return examples.where(F.col("meta.split_hint") == split)


def pages_to_examples(pages: DataFrame, order: str = "page_id", rules: list[str] | None = None, exceptions: list[str] | None = None, mode: str = "compat", limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Examples, and (drop_reason, n). pages: order, url, title, text (null: not cached).

    compat: near duplicates are looked for among all examples, so of a chunk's instructions only the first stays;
    intended: only among first instructions, and a kept chunk has all of them. limit: so many pages that pass all rules
    are taken, and nothing after the last of them. Examples have ord: (order, row, idx, tno), which tells all rows apart.
    """
    p = pages.withColumn("canon", url.canonical(F.col("url")))
    p = p.withColumn("domain", url.etld1(url.authority(F.col("canon")), rules or [], exceptions or []))
    # The text is redacted while it is cleaned, and once more for the flags, which are therefore those that are left.
    p = text.with_redaction(p.withColumn("clean", text.clean(F.col("text"))), "clean", "clean", "pii_flags")
    p = p.withColumn("drop_reason", F.when(F.col("text").isNull(), "no_cache").when(F.length("clean") < MIN_CONTEXT, "too_short").when(text.has_pii(F.col("clean")), "high_risk_pii"))
    # Cleaning is the costly part: its result is written once. The row's number is fixed by that.
    p = cut(p.select(F.struct(F.col(order).alias("order"), F.monotonically_increasing_id().alias("row")).alias("at"), "canon", "title", "domain", "clean", "pii_flags", "drop_reason"))
    if limit:
        last = p.where("drop_reason is null").select("at").orderBy("at").limit(limit).agg(F.count("*").alias("n"), F.max("at").alias("at")).first()
        if last["n"] == limit:
            p = p.where(F.col("at") <= F.struct(F.lit(last["at"]["order"]).alias("order"), F.lit(last["at"]["row"]).alias("row")))
    fine = p.where("drop_reason is null").withColumn("topic", text.topic(F.col("domain"), F.col("clean"))).withColumn("source_id", ids.source_id(F.col("canon"), F.col("title")))
    chunked = fine.withColumn("c", F.explode(text.chunks(F.col("clean"))))
    made = chunked.withColumn("chunk", F.col("c.chunk")).select("*", F.posexplode(text.templates(F.col("topic"), F.col("domain"), F.col("chunk"))).alias("tno", "instruction"))
    made = made.withColumn("ord", F.struct("at.order", "at.row", F.col("c.idx").cast("int").alias("idx"), F.col("tno").cast("int").alias("tno"))).withColumn("reason", example_reason(F.col("instruction"), F.col("chunk")))
    made = cut(made.select("ord", "instruction", "chunk", F.sha2(F.concat("instruction", F.lit("|"), "chunk"), 256).alias("key"), "canon", "title", "domain", "topic", "source_id", "pii_flags", "reason"))
    valid = made.where("reason is null")
    once = cut(exact_first(valid, F.col("key"), "ord"))
    # All instructions of a chunk stand or fall by the chunk alone, and the first one goes before the others. So one that
    # isn't the first of its chunk has an earlier row with the same words, be it of this chunk or of an equal one, and
    # near duplicates need only be looked for among first ones.
    first = once.where("ord.tno = 0")
    kept = first.join(greedy_kept(first, "ord", F.col("chunk")).where("kept").select("ord"), "ord", "left_semi")
    if mode != "compat":
        chunk = F.struct("ord.order", "ord.row", "ord.idx")
        kept = once.withColumn("_chunk", chunk).join(kept.select(chunk.alias("_chunk")), "_chunk", "left_semi").drop("_chunk")
    kept = cut(kept)
    split = rank_split(kept, "domain").withColumnRenamed("split", "split_hint")
    examples = split.select(
        "ord", "instruction", F.col("chunk").alias("context"), F.lit("").alias("response"),
        F.struct(
            F.col("canon").alias("url"), "title", F.lit(None).cast("string").alias("ts"), "domain", "topic", "source_id",
            ids.chunk_id(F.col("source_id"), F.col("ord.idx")).alias("chunk_id"), F.lit(False).alias("generated"),
            F.length("chunk").alias("length_chars"), "split_hint", url.high_risk(F.col("domain")).alias("manual_review"), "pii_flags",
        ).alias("meta"),
    )
    # Rows that repeat a kept example are duplicates; repeats of one that was too similar are too similar, too.
    own = valid.groupBy("key").agg(F.count("*").alias("n")).join(kept.select("key", F.lit(1).alias("k")).distinct(), "key", "left")
    counts = own.agg(F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("dedup"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("near_dup"))
    late = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("drop_reason"), F.col(c).alias("n")) for c in ("dedup", "near_dup")])).alias("x")).select("x.*").where("n > 0")
    early = p.select("drop_reason").unionByName(made.select(F.col("reason").alias("drop_reason"))).where("drop_reason is not null")
    return examples, early.groupBy("drop_reason").agg(F.count("*").alias("n")).unionByName(late)
