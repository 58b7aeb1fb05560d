"""Joins: events with the sessions around them, visits with cached pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.functions import time as T
from trailforge.functions.constants import SLOP_SECONDS
from trailforge.functions.url import canonical
from trailforge.operators.skew import hot_keys, salted_join
from trailforge.shared import written

#: Width in seconds of the time bins that streams are joined by.
BIN_SECONDS = 3600
#: Bits of a session's length (in microseconds) that one level spans; bits by which a level's bins are cut into parts.
LEVEL_BITS, PART_BITS = 3, 6


def interval_join(events: DataFrame, sessions: DataFrame, slop: int = SLOP_SECONDS) -> DataFrame:
    """Each event (a row with t) with the longest session (stream, start, end, and prio if there is one) that it falls into.

    A session reaches from start - slop to end + slop. Which session wins depends on the time alone: of several matches the
    longest session, then the one that starts last, then the stream's name; with prio, a lower one goes first. So sessions
    are numbered in that order, and a time looks for the greatest number that covers it (``_greatest``). No pairs of times
    and sessions are made. Events without a match, or without a time, stay with nulls; rows that repeat stay as they are.
    Events that have a session_id or duration_hint keep them (as ``add_absent``).
    """
    second = lambda c: F.unix_micros(c) / F.lit(1_000_000)
    start, end, gap = F.unix_micros("start"), F.unix_micros("end"), slop * 1_000_000
    prio = F.col("prio") if "prio" in sessions.columns else F.lit(0)
    s = sessions.where("start is not null and end is not null").groupBy(prio.alias("prio"), "start", "end").agg(F.min("stream").alias("stream"))
    s = s.orderBy(F.desc_nulls_first("prio"), end - start, "start").withColumn("n", F.monotonically_increasing_id())
    s = written(s.select("n", "stream", "start", "end"), "sessions")
    reach = s.select("n", (start - gap).alias("lo"), F.greatest(end + gap, start - 1).alias("hi")).where("lo <= hi")
    best = written(_greatest(events.select(F.unix_micros("t").alias("at")).where("at is not null"), reach), "best")
    hot = hot_keys(best.groupBy("n").agg(F.count("*").alias("m")), ("n",), "m", best.count())
    best = salted_join(best, s, ("n",), hot, F.col("at")).select(F.timestamp_micros("at").alias("t"), F.struct("stream", "start", "end").alias("_s"))
    new = {
        "session_id": F.concat(F.col("_s.stream"), F.lit(":"), F.date_format("_s.start", "yyyy-MM-dd'T'HH:mm:ss")),
        "duration_hint": (second(F.col("_s.end")) - second(F.col("_s.start"))).cast("long"),
    }
    keys = {f"_has_{name}": c for name, c in _present(events, new).items()}
    # Found before the join, so that the lines needn't move if nothing else asks for them.
    joined = events.withColumns(keys).join(best, "t", "left") if keys else events.join(best, "t", "left")
    return add_absent(joined.select(*events.columns, *keys, "_s"), new, {name: F.col(f"_has_{name}") for name in new if f"_has_{name}" in keys}).drop("_s", *keys)


def _greatest(times: DataFrame, reach: DataFrame) -> DataFrame:
    """at, n: each different time that a row of reach (n, lo, hi, all whole numbers) covers, with the greatest n of these.

    A row belongs to the level whose bins are at most as wide as it is, and less than 8 times narrower. So of the bins
    that it touches it covers all but the outer ones whole, the first from lo on, the last up to hi. In a bin, the greatest
    n from the left and from the right are therefore all that counts: of the parts before and behind by a bin's parts (64
    at most), then of the times in a part. A row of reach gives at most 9 marks, a time one for each level that has rows.
    """
    level = ((F.length(F.bin(F.col("hi") - F.col("lo") + 1)) - 1) / LEVEL_BITS).cast("int")
    r = reach.withColumn("level", level)
    levels = sorted(x["level"] for x in r.select("level").distinct().collect())
    of = lambda x: f"shiftright({x}, {LEVEL_BITS} * level)"
    none, no = F.lit(None).cast("long"), F.lit(False)
    bins = r.select("level", "n", "lo", F.explode(F.expr(f"sequence({of('lo')}, greatest({of('lo')}, {of('hi')} - 1))")).alias("bin"))
    left = bins.select("level", F.greatest("lo", F.expr(f"shiftleft(bin, {LEVEL_BITS} * level)")).alias("at"), F.col("n").alias("left"), none.alias("right"), no.alias("asked"))
    right = r.select("level", F.col("hi").alias("at"), none.alias("left"), F.col("n").alias("right"), no.alias("asked"))
    asked = times.select(F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")).alias("level"), "at", none.alias("left"), none.alias("right"), F.lit(True).alias("asked"))
    most = [F.max("left").alias("left"), F.max("right").alias("right"), F.bool_or("asked").alias("asked")]
    marks = written(left.unionByName(right).unionByName(asked).groupBy("level", "at").agg(*most), "marks")
    width = f"greatest({LEVEL_BITS} * level - {PART_BITS}, 0)"
    marks = marks.withColumn("part", F.expr(f"shiftright(at, {width})"))
    parts = marks.groupBy("level", "part").agg(*most).withColumn("bin", F.expr(f"shiftright(part, {LEVEL_BITS} * level - {width})"))
    w, before = Window.partitionBy("level", "bin"), (Window.unboundedPreceding, -1)
    whole = F.greatest(F.max("left").over(w.orderBy("part").rowsBetween(*before)), F.max("right").over(w.orderBy(F.desc("part")).rowsBetween(*before)))
    # What covers a whole part stands at its first time.
    parts = parts.select("level", "part", "asked", whole.alias("left")).where("asked and left is not null")
    parts = parts.select("level", F.expr(f"shiftleft(part, {width})").alias("at"), "left", none.alias("right"), no.alias("asked"), "part")
    w, upto = Window.partitionBy("level", "part"), (Window.unboundedPreceding, Window.currentRow)
    n = F.greatest(F.max("left").over(w.orderBy("at").rangeBetween(*upto)), F.max("right").over(w.orderBy(F.desc("at")).rangeBetween(*upto)))
    found = marks.unionByName(parts).select("at", "asked", n.alias("n")).where("asked and n is not null")
    return found.groupBy("at").agg(F.max("n").alias("n"))


def _present(rows: DataFrame, names, raw: str = "_raw") -> dict[str, Column]:
    """Whether a row's JSON line has the key, for those names that are columns of rows with a line."""
    return {name: F.array_contains(F.json_object_keys(raw), name) for name in names if name in rows.columns and raw in rows.columns}


def add_absent(rows: DataFrame, new: dict[str, Column], present: dict[str, Column] | None = None) -> DataFrame:
    """Columns that a row doesn't have yet. Where the rows have their JSON line, a key that is there (even null) stays; else a column that is there."""
    present = _present(rows, new) if present is None else present
    out = {}
    for name, c in new.items():
        if name not in rows.columns:
            out[name] = c
        elif name in present:
            out[name] = F.when(present[name], F.col(name)).otherwise(c.cast(rows.schema[name].dataType))
    return rows.withColumns(out) if out else rows


def session_fields(events: DataFrame, user: DataFrame, system: DataFrame, slop: int = SLOP_SECONDS) -> DataFrame:
    """Enriched events (visited_at_iso, and _raw) with session_id, duration_hint, time_of_day, day_of_week where they lack these keys."""
    v = F.col("visited_at_iso")
    # What needs no session goes first: the lines needn't pass through the join.
    timed = add_absent(events, {"time_of_day": T.wall_clock(v), "day_of_week": T.weekday(v)})
    joined = priority_join(timed.withColumn("t", T.instant(v)), user, system, slop)
    own = [c for c in ("session_id", "duration_hint", "time_of_day", "day_of_week") if c not in events.columns]
    return joined.select(*events.columns, *own)


def priority_join(events: DataFrame, user: DataFrame, system: DataFrame, slop: int = SLOP_SECONDS) -> DataFrame:
    """Sessions of the user first; those of the system only where no session of the user matches."""
    both = user.select("stream", "start", "end").withColumn("prio", F.lit(0)).unionByName(system.select("stream", "start", "end").withColumn("prio", F.lit(1)))
    return interval_join(events, both, slop)


def page_cache_join(visits: DataFrame, cache: DataFrame) -> DataFrame:
    """Visits (url) with cached texts (cache_key, text) by the hash of the canonical url. drop_reason tells a miss."""
    v = visits.withColumn("cache_key", F.sha2(canonical(F.col("url")), 256))
    hit = v.join(cache.select("cache_key", "text").withColumn("_hit", F.lit(True)), "cache_key", "left")
    return hit.withColumn("drop_reason", F.when(F.col("_hit").isNull(), "no_cache").when(F.col("text").isNull(), "cache_read_error")).drop("_hit")


def youtube_cache_join(events: DataFrame, pages: DataFrame, containing: bool = False) -> DataFrame:
    """Events (browser, profile, url) with the first cached page of their video; content_meta is null without one.

    Without a profile, chrome's is Default and other browsers have none. pages: profile, path, video_id, content_meta; or,
    with ``containing``, profile, path, html: then the first page of the profile whose text holds the id as a word counts.
    """
    from trailforge.functions.url import video_id

    profile = F.when(F.coalesce(F.col("profile") != "", F.lit(False)), F.col("profile"))
    if "browser" in events.columns:
        profile = profile.when(F.lower("browser") == "chrome", "Default")
    e = events.withColumns({"video_id": video_id(F.col("url")), "_profile": profile})
    if containing:
        from trailforge.sources.cache import player_response

        wanted = e.where("video_id is not null and _profile is not null").select("_profile", "video_id").distinct()
        held = pages.select(F.col("profile").alias("_profile"), "path", "html").where(F.col("html").contains("ytInitialPlayerResponse"))
        ids = held.select("_profile", "path", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit("[A-Za-z0-9_-]+"), 0))).alias("video_id"))
        path = ids.join(wanted, ["_profile", "video_id"]).groupBy("_profile", "video_id").agg(F.min("path").alias("path"))
        first = path.join(held.drop("_profile"), "path").select("_profile", "video_id", player_response(F.col("html")).alias("content_meta"))
    else:
        first = pages.groupBy(F.col("profile").alias("_profile"), "video_id").agg(F.min_by("content_meta", "path").alias("content_meta"))
    return e.drop("content_meta").join(first, ["_profile", "video_id"], "left").drop("_profile")


def visits_items(visits: DataFrame, items: DataFrame, key: str = "item_id") -> DataFrame:
    """History visits with their items; the visit's title goes first."""
    i = items.withColumnRenamed("title", "_item_title")
    return visits.join(i, key).withColumn("title", F.coalesce("title", "_item_title", F.lit(""))).drop("_item_title")


def without(rows: DataFrame, chosen: DataFrame, key: str = "url") -> DataFrame:
    return rows.join(chosen.select(key).distinct(), key, "left_anti")


def first_n(rows: DataFrame, by: tuple[str, ...], order: tuple[Column, ...], n: int) -> DataFrame:
    """The first n of each group; Spark cuts groups before the shuffle."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
