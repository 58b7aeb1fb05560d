"""Registered queries over rules, reports and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.functions import constants as C
from trailforge.functions import text
from trailforge.operators import joins, sampling, stats, validate
from trailforge.plans import layouts, models
from trailforge.plans.queries import (
    _INSTANT, _RULES_A, _STR, _YT, AS_OF, _context, _ev, _instruction, _q, _redacted, _sessions, enriched, query, t,
)

# --- reports ---------------------------------------------------------------------------------------------------------


@query(
    _ev(f", c AS (SELECT count(*)::BIGINT AS total, count_if(has_meta)::BIGINT AS enriched, count_if({_YT})::BIGINT AS youtube_urls, count_if({_YT} AND has_meta)::BIGINT AS youtube_enriched, count_if({_STR('session_id')})::BIGINT AS with_session, count_if({_STR('reason')})::BIGINT AS with_labels FROM ev)")
    + "SELECT *, enriched / total AS enrichment_rate, youtube_enriched / youtube_urls AS youtube_enrichment_rate, with_session / total AS session_join_rate, with_labels / total AS label_coverage FROM c"
)
def golden_metrics(spark, sf_dir):
    return stats.golden_metrics(enriched(spark, sf_dir))


@query(
    _ev(f", c AS (SELECT count(*)::BIGINT AS total_events, count_if(has_meta)::BIGINT AS cache_hits, count_if({_STR('session_id')})::BIGINT AS session_joins, count_if({_YT})::BIGINT AS youtube_events, count_if({_YT} AND has_meta)::BIGINT AS youtube_enriched FROM ev)")
    + "SELECT *, cache_hits / total_events * 100 AS cache_coverage_pct, session_joins / total_events * 100 AS session_coverage_pct, youtube_enriched / youtube_events * 100 AS youtube_coverage_pct FROM c"
)
def coverage_percent(spark, sf_dir):
    return stats.coverage_percent(enriched(spark, sf_dir))


@query("SELECT 5::BIGINT AS total, 2::BIGINT AS enriched")
def empty_objects_are_no_data(spark, sf_dir):
    """Five invented events: with data, with an empty object, with null, without the key, with a null inside."""
    from trailforge.sources import jsonl

    lines = [('{"url":"u","content_meta":{"videoId":"a"}}',), ('{"url":"u","content_meta":{}}',), ('{"url":"u","content_meta":null}',), ('{"url":"u"}',), ('{"url":"u","content_meta":{"videoId":null}}',)]
    good, _ = jsonl.parse(spark.createDataFrame(lines, "_raw string"))
    return stats.golden_metrics(good).select("total", "enriched")


@query(_ev() + f"SELECT event_id, visited_at_iso FROM ev WHERE NOT coalesce(abs(year({_INSTANT}) - 2024) <= 2, false) ORDER BY event_id LIMIT 5")
def first_bad_timestamps(spark, sf_dir):
    return stats.bad_timestamps(enriched(spark, sf_dir), AS_OF, "event_id")


@query("SELECT event_id, 'session_id' AS missing FROM events WHERE event_id % 41 = 0")
def schema_misses(spark, sf_dir):
    return stats.schema_misses(enriched(spark, sf_dir), C.REQUIRED_A).select("event_id", F.array_join("missing", ",").alias("missing"))


@query(_ev() + "SELECT browser AS value, count(*)::BIGINT AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct FROM ev GROUP BY 1")
def browser_distribution(spark, sf_dir):
    d = stats.distribution(enriched(spark, sf_dir), "browser")
    return d.withColumn("pct", F.col("pct").cast("double"))


@query(_ev() + "SELECT coalesce(reason, 'none') AS value, count(*)::BIGINT AS n FROM ev GROUP BY 1")
def pack_reason_distribution(spark, sf_dir):
    return stats.distribution(layouts.layout_v3(enriched(spark, sf_dir)).select("meta.reason"), "reason", "none").select("value", "n")


@query("SELECT 'pages' AS name, count(*)::BIGINT AS n FROM pages UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents")
def row_counts(spark, sf_dir):
    parts = [t(spark, sf_dir, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in ("pages", "events", "documents")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    _ev(", x AS (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, event_id, array_to_string({e}, ',') AS errors FROM ev" for k, e in _RULES_A.items()) + ")")
    + "SELECT kind, event_id, errors FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY event_id) AS r FROM x WHERE errors <> '') WHERE r <= 10"
)
def first_errors(spark, sf_dir):
    v = validate.layout_a(enriched(spark, sf_dir), AS_OF)
    return stats.first_errors(v, tuple(_RULES_A), "event_id").select("kind", "event_id", F.array_join("errors", ",").alias("errors"))


# --- samples and limits ----------------------------------------------------------------------------------------------


@query(
    _ev(", s AS (SELECT event_id, coalesce(reason, 'NONE') AS reason FROM ev ORDER BY md5('42|' || event_id), event_id LIMIT 200)")
    + "SELECT event_id, reason FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY md5('42|' || event_id), event_id) AS r FROM s) WHERE r <= 3"
)
def eval_sample_shown(spark, sf_dir):
    e = enriched(spark, sf_dir).select("event_id", F.coalesce("labels.reason", F.lit("NONE")).alias("reason"))
    return sampling.shown(e, "reason", "event_id")


@query(_ev() + f"SELECT url, {_instruction('v3', 'reason')} AS instruction, {_context('v3')} AS context FROM ev ORDER BY event_id LIMIT 100")
def head_examples(spark, sf_dir):
    return layouts.layout_v3(enriched(spark, sf_dir), first=100, order="event_id").select("meta.url", "instruction", "context")


@query("SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50))::BIGINT AS first_rows, (SELECT sum(doc_id) FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50))::BIGINT AS total, count(*)::BIGINT AS every_row FROM documents")
def eval_row_limit(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id")
    some = sampling.head(d, "doc_id", 50).agg(F.count("*").alias("first_rows"), F.sum("doc_id").alias("total"))
    return some.join(sampling.head(d, "doc_id", 0).agg(F.count("*").alias("every_row")))


def _golden_sql(size: int = 150) -> str:
    """Five stages, each by hashed order and after the ones before."""
    e = "e AS MATERIALIZED (SELECT event_id, url, coalesce(reason, 'NONE') AS reason, has_meta, coalesce(session_id <> '', false) AS has_session, md5('42|' || event_id) AS h FROM ev)"
    out = [e, f"p0 AS MATERIALIZED (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY h, event_id) AS r FROM e) WHERE r <= greatest(5, {size} // (SELECT count(DISTINCT reason) FROM e)))"]
    stages = [(f"{_YT} AND has_meta", min(30, size // 5)), (f"{_YT} AND NOT has_meta", 10), ("has_session", 20), ("url NOT IN (SELECT url FROM p3)", size)]
    for i, (which, most) in enumerate(stages, 1):
        room = f"least({most}, {size} - (SELECT count(*) FROM p{i - 1}))"
        out.append(f"p{i} AS MATERIALIZED (SELECT * FROM p{i - 1} UNION ALL SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (ORDER BY h, event_id) AS r FROM e WHERE {which}) WHERE r <= {room} AND url NOT IN (SELECT url FROM p{i - 1}))")
    return _ev(", " + ", ".join(out)) + f"SELECT event_id, reason, has_meta, has_session FROM p4 ORDER BY md5('42c|' || event_id), event_id LIMIT {size}"


@query(_golden_sql())
def stratified_golden(spark, sf_dir):
    e = enriched(spark, sf_dir).withColumn("reason", F.col("labels.reason")).withColumn("has_session", F.coalesce(F.col("session_id") != "", F.lit(False)))
    return sampling.golden(e.select("event_id", "url", "reason", "has_meta", "has_session")).select("event_id", "reason", "has_meta", "has_session")


# --- rules -----------------------------------------------------------------------------------------------------------

def _pii(c: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({c}, {_q(p)})" for _, p in C.PII_PATTERNS) + ")"


@query(f"SELECT doc_id, CASE WHEN instruction = '' OR text = '' THEN 'missing_instruction_or_context' WHEN length(text) < 500 THEN 'context_too_short' WHEN {_pii('text')} THEN 'high_risk_pii' END AS reason FROM (SELECT doc_id, text, CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'Do it.' END AS instruction FROM documents)")
def example_reasons(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 11 == 0, "").otherwise("Do it.").alias("instruction"))
    return d.select("doc_id", validate.example_reason(F.col("instruction"), F.col("text")).alias("reason"))


@query(f"SELECT doc_id, {_pii(_redacted('text'))} AS residual FROM documents")
def residual_pii(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.has_pii(text.redact(F.col("text"))).alias("residual"))


def _example_lines(spark, sf_dir) -> DataFrame:
    k = F.col("page_id") % 6
    split = F.when(k == 3, "dev").otherwise("train")
    m = F.to_json(F.struct(*[F.lit(1).alias(c) for c in C.SFT_META_KEYS if c not in ("split_hint", "topic")], split.alias("split_hint"), F.lit("x").alias("topic")))
    short = F.to_json(F.struct(*[F.lit(1).alias(c) for c in C.SFT_META_KEYS if c != "topic"]))
    meta_ = F.when(k == 2, short).otherwise(m)
    context = F.when(k == 4, "").otherwise("c")
    whole = F.format_string('{"instruction":"i","context":"%s","response":"","meta":%s}', context, meta_)
    return t(spark, sf_dir, "pages").select("page_id", F.when(k == 1, F.format_string('{"instruction":"i","context":"c","meta":%s}', meta_)).otherwise(whole).alias("raw"))


@query("SELECT page_id, CASE page_id % 6 WHEN 1 THEN 'missing:response' WHEN 2 THEN 'missing:meta.topic,split' WHEN 3 THEN 'split' WHEN 4 THEN 'empty_context' ELSE '' END AS errors FROM pages")
def example_schema_check(spark, sf_dir):
    return _example_lines(spark, sf_dir).select("page_id", F.array_join(validate.example_schema(F.col("raw")), ",").alias("errors"))


#: Invented events of the wrong types, by page_id modulo 12: JSON of a change to a sound event.
_CHANGES = (
    '"url": "https://youtu.be/abc"', '"url": 5', '"url": null', '"content_meta": "x"', '"content_meta": {"videoId": "abc", "duration": 1.5}', '"content_meta": {"views": "9", "duration": true}',
    '"labels": []', '"labels": {"topics": []}', '"labels": {"reason": 7}', '"labels": {"reason": "general", "topics": "t"}', '"duration_hint": 2.5', '"duration_hint": "3"',
)
_SOUND = '"browser": "b", "profile": "p", "domain": "d", "title": "t", "visited_at_iso": "2024-01-05T10:00:00Z", "transcript_excerpt": null, "session_id": "s", "time_of_day": "10:00", "day_of_week": "Friday"'
_OTHERS = {"url": '"url": "https://youtu.be/abc"', "content_meta": '"content_meta": null', "labels": '"labels": {"reason": "general", "topics": []}', "duration_hint": '"duration_hint": 3'}
_TYPES = (
    ("", "", "", ""), ("url_not_string", "", "", ""), ("url_not_string", "", "", ""), ("content_meta_not_object", "not_object", "", ""), ("", "duration", "", ""), ("", "views", "", ""),
    ("labels_not_object", "", "not_object", ""), ("no_reason", "", "reason", ""), ("", "", "reason", ""), ("", "", "topics", "topics_not_list"), ("", "", "", ""), ("", "", "", ""),
)


@query("SELECT page_id, x.* FROM pages JOIN (VALUES " + ", ".join(f"({i}, {_q(a)}, nullif({_q(y)}, ''), nullif({_q(lab)}, ''), {_q(la)}, {'NULL' if i < 10 else _q('duration_hint')})" for i, (a, y, lab, la) in enumerate(_TYPES)) + ") x(k, schema_a, youtube_b, label_b, label_a, session_b) ON x.k = page_id % 12")
def validate_types(spark, sf_dir):
    from trailforge.sources import jsonl

    def line(change: str) -> str:
        name = change.split(":")[0].strip('"')
        return "{" + ", ".join([_SOUND, *(change if k == name else v for k, v in _OTHERS.items())]) + "}"

    lines = spark.createDataFrame([(i, line(c)) for i, c in enumerate(_CHANGES)], "k int, _line string")
    p = t(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 12).cast("int").alias("k")).join(F.broadcast(lines), "k")
    # The page's number goes through the reader in the line itself.
    raw = p.select(F.concat(F.lit('{"page": '), F.col("page_id").cast("string"), F.lit(", "), F.substring("_line", 2, 10_000)).alias("_raw"))
    good, _ = jsonl.parse(raw)
    v = validate.layout_b(validate.layout_a(good, AS_OF))
    page = F.get_json_object("_raw", "$.page").cast("long")
    quiet = lambda c: F.array_join(F.array_except(c, F.array(F.lit("unknown_reason"))), ",")
    return v.select(
        page.alias("page_id"), (page % 12).cast("int").alias("k"), F.array_join("schema_errors", ",").alias("schema_a"), F.col("youtube_error").alias("youtube_b"), F.col("label_error").alias("label_b"),
        quiet(F.col("label_errors")).alias("label_a"), F.col("session_error").alias("session_b"),
    )


# --- sessions --------------------------------------------------------------------------------------------------------

_SESSIONS = "SELECT event_type || user_id % 5 AS stream, ts AS s, ts + INTERVAL 1 SECOND * (event_id % 7200 - 60) AS e FROM events WHERE event_type = 'signup'"


@query(
    _ev(
        f", s AS ({_SESSIONS}), x AS (SELECT *, {_INSTANT} AS t FROM ev), m AS (SELECT v.t, s.stream, s.s, s.e, row_number() OVER (PARTITION BY v.t ORDER BY epoch_us(s.e) - epoch_us(s.s) DESC, s.s DESC, s.e DESC, s.stream) AS r FROM (SELECT DISTINCT t FROM x) v "
        "JOIN s ON v.t >= s.s - INTERVAL 600 SECOND AND (v.t < s.s OR v.t <= s.e + INTERVAL 600 SECOND))"
    )
    + "SELECT x.event_id, CASE WHEN event_id % 41 = 0 THEN m.stream || ':' || strftime(m.s, '%Y-%m-%dT%H:%M:%S') ELSE session_id END AS session_id, duration_hint, time_of_day FROM x LEFT JOIN m ON m.t = x.t AND m.r = 1"
)
def session_fields_merge(spark, sf_dir):
    """Events keep the session fields whose keys they have, null or not; one in 41 lacks the key session_id."""
    none = _sessions(spark, sf_dir, "signup").limit(0)
    e = joins.session_fields(enriched(spark, sf_dir), _sessions(spark, sf_dir, "signup"), none)
    return e.select("event_id", "session_id", "duration_hint", "time_of_day")


# --- settings --------------------------------------------------------------------------------------------------------

_COMMANDS = {
    "7b": "python3 llama_train.py --model-name meta-llama/Llama-2-7b-hf --model-size 7b --dataset d.jsonl --output-dir out --lora-r 16 --lora-alpha 32 --batch-size 4 --gradient-accumulation-steps 4 --use-4bit",
    "70b": "python3 llama_train.py --model-name meta-llama/Llama-2-70b-hf --model-size 70b --dataset d.jsonl --output-dir out --lora-r 64 --lora-alpha 128 --batch-size 1 --gradient-accumulation-steps 16 --use-4bit --golden-set g.jsonl --use-wandb",
    "3b": "unknown model size '3b'; known are 7b, 13b, 70b",
}


@query("SELECT * FROM (VALUES " + ", ".join(f"({_q(k)}, {_q(v)})" for k, v in _COMMANDS.items()) + ") v(size, command)")
def training_commands(spark, sf_dir):
    def command(size: str, **more) -> str:
        try:
            return models.training_command(size, "d.jsonl", "out", **more)
        except ValueError as e:
            return str(e)

    return spark.createDataFrame([("7b", command("7b")), ("70b", command("70b", golden_set="g.jsonl", use_wandb=True)), ("3b", command("3b"))], "size string, command string")
