"""Rules over enriched events and examples. Each rule set gives an array of error names for a row.

An event is a row with _raw, its JSON line, beside the typed columns: a schema can't tell an absent key from a null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.functions import time as T
from trailforge.functions.constants import MIN_CONTEXT, REASON_TOPIC, REQUIRED_A, REQUIRED_B, SFT_KEYS, SFT_META_KEYS, SPLITS, WEEKDAYS
from trailforge.functions.text import has_pii
from trailforge.functions.url import is_youtube


def errors(*rules: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules]))


def missing_keys(raw: Column, keys: tuple[str, ...]) -> Column:
    return F.array_except(F.array(*map(F.lit, keys)), F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")))


def kind(path: str) -> Column:
    """Type of a value of the row's JSON line (in _v): STRING, BIGINT, OBJECT<...>, VOID for null; null where it is absent."""
    return F.schema_of_variant(F.try_variant_get(F.col("_v"), path, "variant"))


def _parsed(events: DataFrame) -> DataFrame:
    return events.withColumn("_v", F.expr("try_parse_json(_raw)"))


def _not(path: str, *kinds: str, null_ok: bool = False) -> Column:
    """A value that is there and of none of the types."""
    k = kind(path)
    fine = F.lit(False)
    for x in (*kinds, *(["VOID"] if null_ok else [])):
        fine = fine | k.startswith(x)
    return k.isNotNull() & ~fine


#: Types that count as whole numbers; true and false do, as in Python.
_WHOLE = ("BIGINT", "BOOLEAN")


def _there(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def schema_a(as_of: str) -> Column:
    missing = F.transform(missing_keys(F.col("_raw"), REQUIRED_A), lambda k: F.concat(F.lit("missing:"), k))
    has = F.json_object_keys("_raw")
    ts = F.array_contains(has, "visited_at_iso") & ~T.within_years(F.col("visited_at_iso"), as_of)
    object_ = kind("$.labels").startswith("OBJECT")
    reason = object_ & ~F.coalesce(F.array_contains(F.json_object_keys(F.get_json_object("_raw", "$.labels")), "reason"), F.lit(False))
    return F.concat(
        missing,
        errors(
            ("url_not_string", _not("$.url", "STRING")), ("bad_timestamp", ts), ("content_meta_not_object", _not("$.content_meta", "OBJECT", null_ok=True)),
            ("labels_not_object", _not("$.labels", "OBJECT")), ("no_reason", reason),
        ),
    )


def youtube_a() -> Column:
    m, url = F.col("content_meta"), F.coalesce(F.col("url"), F.lit(""))
    there = is_youtube(url) & m.isNotNull()
    d = m["duration"]
    return errors(
        ("no_video_id", there & m["videoId"].isNull()),
        ("video_id_not_in_url", there & ~url.contains(m["videoId"])),
        ("duration_range", there & (d != 0) & ((d < 0) | (d > 86400))),
        ("long_short", there & m["is_shorts"] & (F.coalesce(d, F.lit(0)) > 300)),
    )


def session_a(as_of: str) -> Column:
    sid, tod, dow, hint, ts = (F.col(c) for c in ("session_id", "time_of_day", "day_of_week", "duration_hint", "visited_at_iso"))
    return errors(
        ("no_duration_hint", _there(sid) & (hint.isNull() | (hint == 0))),
        ("no_time_of_day", _there(sid) & ~_there(tod)),
        ("no_day_of_week", _there(sid) & ~_there(dow)),
        ("time_of_day_format", _there(tod) & ~tod.rlike(r"^\d{2}:\d{2}$")),
        ("day_of_week_name", _there(dow) & ~dow.isin(*WEEKDAYS)),
        ("time_of_day_differs", _there(tod) & T.within_years(ts, as_of) & (T.wall_clock(ts) != tod)),
    )


def labels_a() -> Column:
    reason, m = F.col("labels.reason"), F.col("content_meta")
    long_ = ~F.coalesce(m["is_shorts"], F.lit(False)) & (F.coalesce(m["duration"], F.lit(0)) >= 60)
    return errors(("unknown_reason", _there(reason) & ~reason.isin(*REASON_TOPIC)), ("long_form_short", (reason == "shorts/entertainment") & long_), ("topics_not_list", _not("$.labels.topics", "ARRAY")))


def layout_a(events: DataFrame, as_of: str) -> DataFrame:
    return _parsed(events).withColumns({"schema_errors": schema_a(as_of), "youtube_errors": youtube_a(), "session_errors": session_a(as_of), "label_errors": labels_a()}).drop("_v")


def layout_b(events: DataFrame) -> DataFrame:
    """One error at most of each kind but the missing keys."""
    ts, tod, dow, m, url = (F.col(c) for c in ("visited_at_iso", "time_of_day", "day_of_week", "content_meta", "url"))
    url = F.coalesce(url, F.lit(""))
    timestamp = (
        F.when(~_there(ts) | ts.isNull(), "missing")
        .when(T.instant(ts).isNull(), "format")
        .when(_there(tod) & (tod != T.wall_clock(ts)), "time_of_day")
        .when(_there(dow) & (dow != T.weekday(ts)), "day_of_week")
    )
    vid = m["videoId"]
    youtube = F.when(
        is_youtube(url),
        F.when(_not("$.content_meta", "OBJECT", null_ok=True), "not_object")
        .when(_there(vid) & url.contains("youtube.com/watch") & ~url.contains(F.concat(F.lit("v="), vid)), "video_id")
        .when(_there(vid) & ~url.contains("youtube.com/watch") & url.contains("youtu.be/") & ~url.contains(vid), "video_id")
        .when((m["duration"] < 0) | _not("$.content_meta.duration", *_WHOLE, null_ok=True), "duration")
        .when((m["views"] < 0) | _not("$.content_meta.views", *_WHOLE, null_ok=True), "views"),
    )
    hint = F.col("duration_hint")
    no_hint = F.coalesce(kind("$.duration_hint") == "VOID", F.lit(True))
    session = F.when(_there(F.col("session_id")) & no_hint, "no_duration_hint").when((hint < 0) | _not("$.duration_hint", *_WHOLE, null_ok=True), "duration_hint")
    labels = (
        F.when(F.coalesce(kind("$.labels") == "VOID", F.lit(True)), "missing")
        .when(_not("$.labels", "OBJECT"), "not_object")
        .when(~F.coalesce(kind("$.labels.reason") == "STRING", F.lit(False)) | ~F.coalesce(_there(F.col("labels.reason")), F.lit(False)), "reason")
        .when(_not("$.labels.topics", "ARRAY"), "topics")
    )
    found = {"missing": missing_keys(F.col("_raw"), REQUIRED_B), "timestamp_error": timestamp, "youtube_error": youtube, "session_error": session, "label_error": labels}
    return _parsed(events).withColumns(found).drop("_v")


def example_reason(instruction: Column, context: Column) -> Column:
    """Why an example is dropped; null if it isn't."""
    return (
        F.when(~F.coalesce(_there(instruction) & _there(context), F.lit(False)), "missing_instruction_or_context")
        .when(F.length(context) < MIN_CONTEXT, "context_too_short")
        .when(has_pii(context), "high_risk_pii")
    )


def example_schema(raw: Column) -> Column:
    """Errors of an example's JSON line against the schema."""
    meta = F.get_json_object(raw, "$.meta")
    top = F.transform(missing_keys(raw, SFT_KEYS), lambda k: F.concat(F.lit("missing:"), k))
    inner = F.transform(missing_keys(meta, SFT_META_KEYS), lambda k: F.concat(F.lit("missing:meta."), k))
    return F.concat(top, inner, errors(("empty_context", F.get_json_object(raw, "$.context") == ""), ("split", ~F.get_json_object(meta, "$.split_hint").isin(*SPLITS))))
