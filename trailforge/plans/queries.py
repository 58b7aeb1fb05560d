"""Registered queries over the tables of a folder, each beside the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.functions import constants as C
from trailforge.functions import ids, sft, text, url
from trailforge.functions import time as T
from trailforge.operators import dedup, joins, sampling, stats, validate
from trailforge.plans import layouts
from trailforge.shared import spread

AS_OF = "2024-06-01T00:00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _words(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- pieces of SQL that several oracles share ------------------------------------------------------------------------

_AUTH = r"lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"
_DOMAIN = f"regexp_replace({_AUTH}, '^www\\.', '')"
_LAST2 = f"array_to_string((string_split(split_part({_AUTH}, ':', 1), '.'))[-2:], '.')"
_PAIRS = "list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '=.'))"
_KV = f"list_transform({_PAIRS}, lambda p: struct_pack(k := url_decode(replace(split_part(p, '=', 1), '+', ' ')), v := url_decode(replace(regexp_replace(p, '^[^=]*=', ''), '+', ' '))))"
_ENC = "replace(replace(url_encode({}), '%20', '+'), '*', '%2A')"
_TRACK = ", ".join(map(_q, C.TRACKING_PARAMS))
_QUERY = f"array_to_string(list_transform(list_filter({_KV}, lambda x: x.k NOT IN ({_TRACK})), lambda x: {_ENC.format('x.k')} || '=' || {_ENC.format('x.v')}), '&')"
_CANON = (
    f"lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || {_DOMAIN} || "
    "regexp_replace(regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''), '/+$', '') || "
    f"CASE WHEN {_QUERY} = '' THEN '' ELSE '?' || {_QUERY} END"
)
_HALF = "(('0x' || substr(md5({c}), {i}, 16))::UBIGINT % 100)"


def _mod100(c: str) -> str:
    return f"((({_HALF.format(c=c, i=1)} * 16 + {_HALF.format(c=c, i=17)}) % 100)::INT)"


def _split(c: str) -> str:
    return f"CASE WHEN {_mod100(c)} < 80 THEN 'train' WHEN {_mod100(c)} < 90 THEN 'val' ELSE 'test' END"


def _redacted(c: str, upto: int | None = None) -> str:
    for _, p in C.PII_PATTERNS[:upto]:
        c = f"regexp_replace({c}, {_q(p)}, '{C.REDACTED}', 'g')"
    return c


_CLEAN = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '(?is)<script.*?</script>', '', 'g'), '(?is)cookie(s)?( banner| notice)?.{{0,100}}', '', 'g'), "
    "'(?is)menu.{{0,100}}', '', 'g'), '\\s+', ' ', 'g')"
)


def _cleaned(c: str) -> str:
    return f"trim({_redacted(_CLEAN.format(c))}, ' ')"


def _topic(domain: str, body: str) -> str:
    return (
        f"CASE WHEN {_words(f'lower({domain})', C.DEV_HOSTS)} THEN 'dev' WHEN {_words(f'lower({domain})', C.NEWS_HOSTS)} THEN 'news' "
        f"WHEN {_words(f'lower({domain})', C.RESEARCH_HOSTS)} THEN 'research' WHEN regexp_matches({body}, {_q('(?i)' + C.RESEARCH_TEXT)}) THEN 'research' ELSE 'other' END"
    )


# Enriched events made by formula from the events table. {iso}, {hm}, {dow}, {keys} differ by engine; the rest is common.
_EVENT = {
    "event_id": "event_id",
    "browser": "CASE event_id % 3 WHEN 0 THEN 'chrome' WHEN 1 THEN 'firefox' ELSE 'safari' END",
    "profile": "concat('p', CAST(user_id % 4 AS {str}))",
    "url": "CASE event_id % 4 WHEN 0 THEN concat('https://www.youtube.com/watch?v=vid', CAST(event_id % 97 AS {str})) WHEN 1 THEN concat('https://youtu.be/vid', CAST(event_id % 89 AS {str}), '?t=1') "
    "WHEN 2 THEN concat('https://www.News-site.org/a/', CAST(event_id % 500 AS {str})) ELSE concat('https://github.com/u/', CAST(user_id AS {str})) END",
    "title": "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 7 = 1 THEN NULL ELSE concat('Title ', CAST(event_id AS {str})) END",
    "visited_at_iso": "CASE WHEN event_id % 53 = 0 THEN 'not a time' WHEN event_id % 53 = 1 THEN concat('2001', substr({iso}, 5), 'Z') WHEN event_id % 53 = 2 THEN concat({iso}, '+05:30') ELSE concat({iso}, 'Z') END",
    "has_meta": "event_id % 5 <> 0",
    "vid": "CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'other' WHEN event_id % 4 = 0 THEN concat('vid', CAST(event_id % 97 AS {str})) ELSE concat('vid', CAST(event_id % 89 AS {str})) END",
    "m_title": "CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('Clip ', CAST(event_id % 31 AS {str})) END",
    "m_channel": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('Ch ', CAST(event_id % 12 AS {str})) END",
    "m_date": "CASE WHEN event_id % 8 = 3 THEN NULL ELSE '2024-01-05' END",
    "m_duration": "CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 90000 WHEN 3 THEN -5 ELSE event_id % 4000 END",
    "m_views": "CASE WHEN event_id % 10 = 4 THEN NULL ELSE event_id * 137 % 2000000 END",
    "m_keys": "CASE WHEN event_id % 15 = 0 THEN {none} ELSE {keys} END",
    "m_shorts": "event_id % 13 = 0",
    "transcript_excerpt": "CASE event_id % 20 WHEN 0 THEN concat('Transcript of ', CAST(event_id AS {str})) WHEN 1 THEN '' ELSE NULL END",
    "session_id": "CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 AND event_id % 17 = 5 THEN '' ELSE concat('s', CAST(event_id % 40 AS {str})) END",
    "time_of_day": "CASE event_id % 19 WHEN 0 THEN NULL WHEN 1 THEN '25h' WHEN 2 THEN '00:00' ELSE {hm} END",
    "day_of_week": "CASE event_id % 23 WHEN 0 THEN NULL WHEN 1 THEN 'Funday' WHEN 2 THEN 'Monday' ELSE {dow} END",
    "duration_hint": "CASE event_id % 17 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -1 ELSE event_id % 900 END",
    "has_labels": "event_id % 37 <> 0",
    "reason": "CASE event_id % 9 WHEN 0 THEN 'general' WHEN 1 THEN 'shorts/entertainment' WHEN 2 THEN 'tutorial/learning' WHEN 3 THEN 'news/information' WHEN 4 THEN 'music/ambient' "
    "WHEN 5 THEN 'deep-dive/research' WHEN 6 THEN 'night_browsing' WHEN 7 THEN 'odd' ELSE NULL END",
}
_SPARK = {"str": "STRING", "iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", "hm": "date_format(ts, 'HH:mm')", "dow": "date_format(ts, 'EEEE')", "none": "CAST(NULL AS ARRAY<STRING>)",
          "keys": "CASE WHEN event_id % 8 = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE transform(sequence(1, event_id % 8), i -> concat('k', CAST(i AS STRING))) END"}
_DUCK = {"str": "VARCHAR", "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S')", "hm": "strftime(ts, '%H:%M')", "dow": "strftime(ts, '%A')", "none": "CAST(NULL AS VARCHAR[])",
         "keys": "list_transform(range(1, event_id % 8 + 1), lambda i: 'k' || i)"}


def _ev(extra: str = "") -> str:
    cols = ", ".join(f"{e.format(**_DUCK)} AS {k}" for k, e in _EVENT.items())
    return f"WITH ev0 AS (SELECT {cols} FROM events), ev AS (SELECT * REPLACE (CASE WHEN has_labels THEN reason END AS reason, CASE WHEN has_meta THEN vid END AS vid, CASE WHEN has_meta THEN m_title END AS m_title, CASE WHEN has_meta THEN m_channel END AS m_channel, CASE WHEN has_meta THEN m_date END AS m_date, CASE WHEN has_meta THEN m_duration END AS m_duration, CASE WHEN has_meta THEN m_views END AS m_views, CASE WHEN has_meta THEN m_keys END AS m_keys, has_meta AND m_shorts AS m_shorts) FROM ev0){extra} "


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(t(spark, sf_dir, "events").select("event_id", "ts", "user_id")).selectExpr(*[f"{v.format(**_SPARK)} AS {k}" for k, v in _EVENT.items()])
    meta = F.struct(
        F.col("vid").alias("videoId"), F.col("m_title").alias("title"), F.col("m_channel").alias("channel"), F.col("m_date").alias("publishDate"),
        F.col("m_duration").alias("duration"), F.col("m_views").alias("views"), F.col("m_keys").alias("keywords"), F.col("m_shorts").alias("is_shorts"),
    )
    labels = F.struct("reason", F.array(F.coalesce("reason", F.lit("none"))).alias("topics"))
    e = e.withColumns({"content_meta": F.when(F.col("has_meta"), meta), "labels": F.when(F.col("has_labels"), labels), "domain": url.authority(F.col("url"))})
    keys = [k for k in C.REQUIRED_A]
    whole = F.struct(*[k for k in keys])
    # One event in 41 lacks the key session_id; the others have every key, null or not.
    rest = F.struct(*[k for k in keys if k != "session_id"])
    raw = F.when(F.col("event_id") % 41 == 0, F.to_json(rest, {"ignoreNullFields": "false"})).otherwise(F.to_json(whole, {"ignoreNullFields": "false"}))
    return e.withColumn("_raw", raw)


# --- urls and domains ------------------------------------------------------------------------------------------------


@query(f"SELECT page_id, {_CANON} AS canon FROM pages")
def url_canonicalize(spark, sf_dir):
    return spread(t(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", url.canonical(F.col("url")).alias("canon"))


@query(f"SELECT {_DOMAIN} AS value, count(*)::BIGINT AS n FROM pages GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def url_domain_top20(spark, sf_dir):
    return stats.top(t(spark, sf_dir, "pages").select(url.normal_domain(F.col("url")).alias("domain")), "domain", 20)


@query(f"SELECT page_id, {_DOMAIN} AS normal, {_LAST2} AS last_two, {_AUTH} AS netloc FROM pages")
def url_domains(spark, sf_dir):
    u = F.col("url")
    return t(spark, sf_dir, "pages").select("page_id", url.normal_domain(u).alias("normal"), url.last_two_labels(u).alias("last_two"), url.authority(u).alias("netloc"))


_RULES = ["com", "net", "org", "co.uk", "example.net", "*.ck"]
_PLAIN_RULES = ", ".join(_q(r) for r in _RULES if not r.startswith("*"))


@query(
    f"WITH d AS (SELECT page_id, {_AUTH} AS d, string_split({_AUTH}, '.') AS p FROM pages), "
    f"h AS (SELECT page_id, d, p, list_filter(range(1, len(p) + 1), lambda i: array_to_string(p[i:], '.') IN ({_PLAIN_RULES}))[1] AS i FROM d) "
    "SELECT page_id, CASE WHEN i > 1 THEN array_to_string(p[i - 1:], '.') WHEN i = 1 THEN d WHEN len(p) >= 2 THEN array_to_string(p[len(p) - 1:], '.') ELSE d END AS etld1 FROM h"
)
def etld1(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", url.etld1(url.authority(F.col("url")), _RULES, []).alias("etld1"))


@query(f"SELECT page_id, {_words(f'lower({_DOMAIN})', C.HIGH_RISK_WORDS)} AS high_risk FROM pages")
def high_risk_domain(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", url.high_risk(url.normal_domain(F.col("url"))).alias("high_risk"))


@query(f"SELECT page_id, {_topic(_DOMAIN, 'html')} AS topic FROM pages")
def topic_inference(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", text.topic(url.normal_domain(F.col("url")), F.col("html")).alias("topic"))


@query(_ev() + "SELECT event_id, CASE WHEN contains(url, 'youtube.com/watch') THEN nullif(regexp_extract(url, '[?&]v=([^&#]+)', 1), '') WHEN contains(url, 'youtu.be/') THEN nullif(regexp_extract(url, 'youtu\\.be/([^?&]*)', 1), '') END AS video FROM ev")
def video_ids(spark, sf_dir):
    return enriched(spark, sf_dir).select("event_id", url.video_id(F.col("url")).alias("video"))


# --- ids and splits --------------------------------------------------------------------------------------------------

_KEY1 = "browser || ':' || profile || ':' || url || ':' || visited_at_iso"
_KEY2 = "url || '|' || visited_at_iso || '|' || browser || '|' || profile"


@query(_ev() + f"SELECT event_id, sha256(url || coalesce(title, '')) AS source_a, left(sha256({_KEY1}), 16) AS source_b, left(sha256({_KEY2}), 16) AS source_c, left(sha256({_KEY1}), 16) || '#c' || lpad((event_id % 1000)::VARCHAR, 3, '0') AS chunk FROM ev")
def source_ids(spark, sf_dir):
    b, p, u, v = (F.col(c) for c in ("browser", "profile", "url", "visited_at_iso"))
    one = ids.event_id_v1(b, p, u, v)
    return enriched(spark, sf_dir).select("event_id", ids.source_id(u, F.col("title")).alias("source_a"), one.alias("source_b"), ids.event_id_v2(b, p, u, v).alias("source_c"), ids.chunk_id(one, F.col("event_id") % 1000).alias("chunk"))


@query(f"SELECT doc_id, {_split('doc_id::VARCHAR')} AS split FROM documents")
def hash_split(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", ids.hash_split(F.col("doc_id").cast("string")).alias("split"))


@query(f"SELECT value, n, n * 100.0::DOUBLE / sum(n) OVER () AS pct FROM (SELECT {_split('doc_id::VARCHAR')} AS value, count(*)::BIGINT AS n FROM documents GROUP BY 1)")
def hash_split_distribution(spark, sf_dir):
    d = stats.distribution(hash_split(spark, sf_dir), "split")
    return d.withColumn("pct", F.col("pct").cast("double"))


@query(
    f"WITH d AS (SELECT DISTINCT {_LAST2} AS domain FROM pages), r AS (SELECT domain, row_number() OVER (ORDER BY md5('42|' || domain), domain) AS r, count(*) OVER () AS n FROM d) "
    f"SELECT page_id, domain, CASE WHEN r <= floor(n * 0.8) THEN 'train' WHEN r <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM (SELECT page_id, {_LAST2} AS domain FROM pages) JOIN r USING (domain)"
)
def domain_rank_split(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", url.last_two_labels(F.col("url")).alias("domain"))
    return sampling.rank_split(p, "domain").select("page_id", "domain", "split")


@query(None)
def domain_mersenne_split(spark, sf_dir):
    return sampling.mersenne_split(t(spark, sf_dir, "pages").select(url.last_two_labels(F.col("url")).alias("domain")), "domain")


# --- text ------------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, sha256({_redacted('text')}) AS redacted FROM documents")
def pii_redact(spark, sf_dir):
    return spread(t(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.sha2(text.redact(F.col("text")), 256).alias("redacted"))


_FLAGS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({_redacted('text', i)}, {_q(p)}) THEN '{n}' END" for i, (n, p) in enumerate(C.PII_PATTERNS)) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT doc_id, array_to_string({_FLAGS}, ',') AS flags FROM documents")
def pii_flags_sequential(spark, sf_dir):
    d = text.with_redaction(spread(t(spark, sf_dir, "documents").select("doc_id", "text")), "text", "redacted", "flags")
    return d.select("doc_id", F.array_join("flags", ",").alias("flags"))


@query("SELECT doc_id, (" + " OR ".join(f"regexp_matches(text, {_q(p)})" for _, p in C.PII_PATTERNS) + ") AS has_pii FROM documents")
def pii_contains(spark, sf_dir):
    return spread(t(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", text.has_pii(F.col("text")).alias("has_pii"))


@query(f"SELECT page_id, sha256({_cleaned('html')}) AS clean FROM pages")
def clean_html_text(spark, sf_dir):
    return spread(t(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", F.sha2(text.clean(F.col("html")), 256).alias("clean"))


_CHUNKS = "(SELECT doc_id, i AS idx, substr(text, (i * 7040 + 1)::BIGINT, 8000) AS chunk FROM (SELECT doc_id, text, unnest(range(0, greatest(0, ceil((length(text) - 8000) / 7040.0))::BIGINT + 1)) AS i FROM documents))"


@query(f"SELECT doc_id, idx::INT AS idx, length(chunk)::INT AS length, md5(chunk) AS chunk FROM {_CHUNKS} WHERE length(chunk) >= 500")
def chunk_text(spark, sf_dir):
    c = spread(t(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.explode(text.chunks(F.col("text"))).alias("c"))
    return c.select("doc_id", F.col("c.idx").cast("int").alias("idx"), F.length("c.chunk").alias("length"), F.md5("c.chunk").alias("chunk"))


@query(
    f"SELECT page_id, unnest(range(0, len(l)))::INT AS pos, unnest(l) AS instruction FROM (SELECT page_id, list_filter([{_q(C.TEMPLATES[0])}, {_q(C.TEMPLATES[1])}, CASE WHEN tp IN ('news', 'research') THEN {_q(C.TEMPLATES[2])} END, "
    f"CASE WHEN {_words('d', C.DEV_HOSTS)} OR tp = 'dev' OR regexp_matches(html, '(?i){C.ERROR_TEXT}') THEN {_q(C.TEMPLATES[3])} END], lambda x: x IS NOT NULL) AS l FROM (SELECT page_id, html, {_DOMAIN} AS d, {_topic(_DOMAIN, 'html')} AS tp FROM pages))"
)
def template_expand(spark, sf_dir):
    d = url.normal_domain(F.col("url"))
    p = t(spark, sf_dir, "pages").select("page_id", F.posexplode(text.templates(text.topic(d, F.col("html")), d, F.col("html"))).alias("pos", "instruction"))
    return p


@query("SELECT doc_id, md5(text) AS text FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def exact_dedup(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup.exact_first(d, F.sha2("text", 256), "doc_id").select("doc_id", F.md5("text").alias("text"))


_SETS = "WITH s AS MATERIALIZED (SELECT doc_id, list_distinct(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS w FROM documents)"


@query(
    _SETS + " SELECT a.doc_id AS a, b.doc_id AS b, len(list_intersect(a.w, b.w))::DOUBLE / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) AS similarity FROM s a JOIN s b ON a.doc_id < b.doc_id AND least(len(a.w), len(b.w)) >= 0.92 * greatest(len(a.w), len(b.w)) "
    "WHERE len(a.w) > 0 AND len(b.w) > 0 AND len(list_intersect(a.w, b.w))::DOUBLE / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) > 0.92"
)
def near_dup_pairs(spark, sf_dir):
    return dedup.similar_pairs(spread(t(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", F.col("text"))


@query(None)
def near_dup_greedy(spark, sf_dir):
    return dedup.greedy_kept(spread(t(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", F.col("text"))


_LW = "list_distinct(list_filter(string_split_regex(lower({}), '\\s+'), lambda w: w <> ''))"


@query(
    f"SELECT u.conv_id, u.turn, coalesce(len(list_intersect({_LW.format('u.text')}, {_LW.format('a.text')}))::DOUBLE / nullif(len({_LW.format('a.text')}), 0), 0) AS score "
    "FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"
)
def groundedness(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return c.where("role = 'user'").join(a, ["conv_id", "turn"]).select("conv_id", "turn", text.groundedness(F.col("text"), F.col("response")).alias("score"))


# --- times -----------------------------------------------------------------------------------------------------------

_MICRO = "(epoch_us(ts) + event_id % 1000)"
_FMT = "strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {0} % 1000000 = 0 THEN '' ELSE '.' || lpad(({0} % 1000000)::VARCHAR, 6, '0') END || 'Z'"


@query(f"SELECT event_id, {_FMT.format(_MICRO)} AS chromium, {_FMT.format(_MICRO)} AS firefox, {_FMT.format(f'({_MICRO} // 1000000 * 1000000 + 500000)')} AS safari FROM events")
def epochs(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", (F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 1000).alias("us"))
    seconds = (F.col("us") - T.EPOCH_2001 - F.pmod(F.col("us"), F.lit(1_000_000))) / F.lit(1_000_000) + 0.5
    return e.select("event_id", T.from_chromium(F.col("us") - T.EPOCH_1601).alias("chromium"), T.from_firefox(F.col("us")).alias("firefox"), T.from_safari(seconds).alias("safari"))


_GOOD = "visited_at_iso <> 'not a time'"


@query(_ev() + f"SELECT event_id, CASE WHEN {_GOOD} THEN substr(visited_at_iso, 12, 5) END AS hm, CASE WHEN {_GOOD} THEN strftime(try_cast(substr(visited_at_iso, 1, 10) AS DATE), '%A') END AS dow, CASE WHEN {_GOOD} THEN replace(visited_at_iso, 'Z', '+00:00') END AS iso FROM ev")
def time_of_day(spark, sf_dir):
    v = F.col("visited_at_iso")
    return enriched(spark, sf_dir).select("event_id", T.wall_clock(v).alias("hm"), T.weekday(v).alias("dow"), T.normalised(v).alias("iso"))


_INSTANT = "(try_cast(substr(visited_at_iso, 1, 19) AS TIMESTAMP) - CASE WHEN right(visited_at_iso, 6) = '+05:30' THEN INTERVAL 330 MINUTE ELSE INTERVAL 0 MINUTE END)"
_YEARS5 = f"coalesce(abs(floor((epoch_us(TIMESTAMP '{AS_OF.replace('T', ' ')}') - epoch_us({_INSTANT})) / 86400000000.0) / 365.25) <= 5, false)"


@query(_ev() + f"SELECT event_id, {_INSTANT} IS NOT NULL AS readable, {_YEARS5} AS in_5_years, coalesce(abs(year({_INSTANT}) - 2024) <= 2, false) AS in_2_calendar_years FROM ev")
def ts_sanity(spark, sf_dir):
    v = F.col("visited_at_iso")
    return enriched(spark, sf_dir).select("event_id", T.instant(v).isNotNull().alias("readable"), T.within_years(v, AS_OF).alias("in_5_years"), T.within_calendar_years(v, AS_OF).alias("in_2_calendar_years"))


# --- joins -----------------------------------------------------------------------------------------------------------

_SESS = "SELECT event_type || user_id % 5 AS stream, ts AS s, ts + INTERVAL 1 SECOND * (event_id % 7200 - 60) AS e, {p} AS prio FROM events WHERE event_type = '{k}'"


def _sessions(spark, sf_dir, kind: str) -> DataFrame:
    e = t(spark, sf_dir, "events").where(F.col("event_type") == kind).withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(F.expr("concat(event_type, cast(user_id % 5 as string))").alias("stream"), F.col("ts").alias("start"), F.expr("timestampadd(SECOND, cast(event_id % 7200 - 60 as int), ts)").alias("end"))


def _join_sql(sessions: str) -> str:
    return (
        f"WITH s AS ({sessions}), m AS (SELECT v.event_id, s.stream, s.s, s.e, row_number() OVER (PARTITION BY v.event_id ORDER BY s.prio, epoch_us(s.e) - epoch_us(s.s) DESC, s.s DESC, s.e DESC, s.stream) AS r FROM events v JOIN s ON v.ts >= s.s - INTERVAL 600 SECOND AND (v.ts < s.s OR v.ts <= s.e + INTERVAL 600 SECOND)) "
        "SELECT v.event_id, m.stream || ':' || strftime(m.s, '%Y-%m-%dT%H:%M:%S') AS session_id, ((epoch_us(m.e) - epoch_us(m.s)) // 1000000)::BIGINT AS duration_hint FROM events v LEFT JOIN m ON m.event_id = v.event_id AND m.r = 1"
    )


def _event_times(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("t"))


@query(_join_sql(_SESS.format(p=0, k="view")))
def session_interval_join(spark, sf_dir):
    return joins.interval_join(_event_times(spark, sf_dir), _sessions(spark, sf_dir, "view")).drop("t")


@query(_join_sql(_SESS.format(p=0, k="click") + " UNION ALL " + _SESS.format(p=1, k="view")))
def session_priority_join(spark, sf_dir):
    return joins.priority_join(_event_times(spark, sf_dir), _sessions(spark, sf_dir, "click"), _sessions(spark, sf_dir, "view")).drop("t")


@query("SELECT o_orderkey AS visit, c_custkey AS item_id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE c_name END AS title FROM orders JOIN customer ON o_custkey = c_custkey")
def visits_items_join(spark, sf_dir):
    v = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("visit"), F.col("o_custkey").alias("item_id"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("title"))
    return joins.visits_items(v, t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("item_id"), F.col("c_name").alias("title"))).select("visit", "item_id", "title")


@query("SELECT source, count(*)::BIGINT AS n FROM (SELECT 'pages' AS source, url FROM pages UNION ALL SELECT 'events' AS source, event_type AS url FROM events) GROUP BY source")
def union_sources(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), "url")
    return p.unionByName(t(spark, sf_dir, "events").select(F.lit("events").alias("source"), F.col("event_type").alias("url"))).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r <= 5")
def topk_per_source(spark, sf_dir):
    return joins.first_n(t(spark, sf_dir, "events"), ("user_id",), (F.desc("ts"), F.asc("event_id")), 5).select("user_id", "event_id", "event_type")


_CACHE = f"c AS (SELECT sha256({_CANON}) AS k, CASE WHEN page_id % 7 = 1 THEN NULL ELSE html END AS body FROM pages WHERE page_id % 3 <> 0)"
_REASON = "CASE WHEN c.k IS NULL THEN 'no_cache' WHEN body IS NULL THEN 'cache_read_error' END"


def _cached(spark, sf_dir) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    cache = p.where("page_id % 3 <> 0").select(F.sha2(url.canonical(F.col("url")), 256).alias("cache_key"), F.when(F.col("page_id") % 7 != 1, F.col("html")).alias("text"))
    return joins.page_cache_join(p.select("page_id", "url"), cache)


@query(f"WITH {_CACHE} SELECT page_id, {_REASON} AS drop_reason, length(body)::INT AS length FROM (SELECT page_id, sha256({_CANON}) AS k FROM pages) v LEFT JOIN c ON v.k = c.k")
def page_cache_left_join(spark, sf_dir):
    return _cached(spark, sf_dir).select("page_id", "drop_reason", F.length("text").alias("length"))


@query(f"WITH {_CACHE} SELECT drop_reason, count(*)::BIGINT AS n FROM (SELECT {_REASON} AS drop_reason FROM (SELECT page_id, sha256({_CANON}) AS k FROM pages) v LEFT JOIN c ON v.k = c.k) WHERE drop_reason IS NOT NULL GROUP BY 1")
def drop_reason_counts(spark, sf_dir):
    return _cached(spark, sf_dir).where("drop_reason is not null").groupBy("drop_reason").agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_join_unlabelled(spark, sf_dir):
    return joins.without(t(spark, sf_dir, "documents").select("doc_id"), t(spark, sf_dir, "labels"), "doc_id")


# --- examples --------------------------------------------------------------------------------------------------------

_HAS = "({c} IS NOT NULL AND {c} <> {z})"
_STR = lambda c: _HAS.format(c=c, z="''")
_NUM = lambda c: _HAS.format(c=c, z="0")


def _instruction(layout: str, reason: str) -> str:
    w = C.WORDINGS[layout]
    mids = " ".join(f"WHEN {reason} = '{r}' THEN {_q(x)}" for r, x in zip(C.INSTRUCTION_REASONS, w[1:], strict=False))
    return f"CASE WHEN m_shorts OR ({_NUM('m_duration')} AND m_duration < 60) THEN {_q(w[0])} {mids} ELSE {_q(w[-1])} END"


def _context(layout: str) -> str:
    title = "m_title" if layout == "v3" else f"CASE WHEN {_STR('m_title')} THEN m_title ELSE title END"
    show = lambda c, k, s: f"CASE WHEN {_STR(c) if k == 's' else _NUM(c)} THEN {s} END"
    channel = show("m_channel", "s", "m_channel" if layout == "v3" else "'Channel: ' || m_channel")
    date = show("m_date", "s", "'Published: ' || m_date")
    views = show("m_views", "n", "'Views: ' || m_views" if layout == "v3" else "'Views: ' || format('{:,}', m_views)")
    most = {"v1": "m_keys[1:5]", "v2": "m_keys[1:10]"}.get(layout, "m_keys")
    keys = f"CASE WHEN len(m_keys) > 0 THEN 'Keywords: ' || array_to_string({most}, ', ') END"
    if layout == "v1":
        d = show("m_duration", "n", "'Duration: ' || floor(m_duration / 60)::BIGINT || 'm ' || ((m_duration % 60 + 60) % 60) || 's'")
        parts = [f"CASE WHEN {_STR(f'({title})')} THEN 'Title: ' || ({title}) END", channel, date, d, views, keys]
    else:
        d = show("m_duration", "n", "'Duration: ' || m_duration || 's'")
        parts = [f"CASE WHEN {_STR(f'({title})')} THEN ({title}) END", channel, date, keys, d, views]
    made = f"concat_ws(' | ', {', '.join(parts)})"
    if layout != "v3":
        made = f"CASE WHEN {made} = '' THEN 'URL: ' || url ELSE {made} END"
    return f"CASE WHEN {_STR('transcript_excerpt')} THEN transcript_excerpt ELSE {made} END"


_TOPIC = "CASE reason " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.REASON_TOPIC.items()) + " ELSE 'general' END"


@query(
    _ev(f", x AS (SELECT *, left(sha256({_KEY1}), 16) AS sid, {_context('v1')} AS context FROM ev)")
    + f"SELECT sid AS source_id, sid || '#c000' AS chunk_id, {_instruction('v1', 'reason')} AS instruction, context, CASE WHEN {_STR('title')} THEN title ELSE m_title END AS title, CASE WHEN {_GOOD} THEN replace(visited_at_iso, 'Z', '+00:00') END AS ts, {_DOMAIN} AS domain, {_TOPIC} AS topic, length(context)::INT AS length_chars, {_split('sid')} AS split_hint FROM x WHERE length(context) >= 10"
)
def sft_transform_v1(spark, sf_dir):
    m = layouts.layout_v1(enriched(spark, sf_dir))
    return m.select("meta.source_id", "meta.chunk_id", "instruction", "context", "meta.title", "meta.ts", "meta.domain", "meta.topic", "meta.length_chars", "meta.split_hint")


@query(
    _ev(f", x AS (SELECT *, left(sha256({_KEY2}), 16) AS sid, {_context('v2')} AS context FROM ev)")
    + f"SELECT sid AS source_id, {_instruction('v2', 'reason')} AS instruction, context, nullif(title, '') AS title, visited_at_iso AS ts, {_LAST2} AS domain, coalesce(reason, 'general') AS topic, length(context)::INT AS length_chars FROM x WHERE length(context) >= 10"
)
def sft_transform_v2(spark, sf_dir):
    m = layouts.layout_v2(enriched(spark, sf_dir))
    return m.select("meta.source_id", "instruction", "context", "meta.title", "meta.ts", "meta.domain", "meta.topic", "meta.length_chars")


@query(_ev() + f"SELECT url, visited_at_iso, {_instruction('v3', 'reason')} AS instruction, {_context('v3')} AS context, '' AS response, browser, profile, {_AUTH} AS domain, title, reason, CASE WHEN has_labels THEN coalesce(reason, 'none') ELSE '' END AS topics, duration_hint FROM ev")
def sft_pack_v3(spark, sf_dir):
    m = layouts.layout_v3(enriched(spark, sf_dir))
    return m.select("meta.url", "meta.visited_at_iso", "instruction", "context", "response", *(f"meta.{c}" for c in ("browser", "profile", "domain", "title", "reason")), F.array_join("meta.topics", ", ").alias("topics"), "meta.duration_hint")


@query(None)
def pages_to_examples(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"), F.when(F.col("page_id") % 10 != 0, F.col("html")).alias("text"))
    return layouts.pages_to_examples(p)[0].select(F.col("ord.order").alias("page_id"), "ord.idx", "ord.tno", "instruction", F.length("context").alias("length"), "meta.url", "meta.domain", "meta.topic", "meta.chunk_id", "meta.split_hint")


@query("SELECT u.conv_id, u.turn, '[INST] Reply.' || chr(10) || chr(10) || 'Context: ' || u.text || ' [/INST]' AS prompt, u.text AS response, CASE WHEN length(u.text) > 200 THEN left(u.text, 200) || '...' ELSE u.text END AS preview FROM (SELECT * REPLACE (trim(text) AS text) FROM conversations) u WHERE role = 'user'")
def prompt_format(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").where("role = 'user'").withColumn("text", F.trim("text"))
    p = sft.prompt(F.lit("Reply."), F.col("text"))
    return c.select("conv_id", "turn", p.alias("prompt"), sft.response_of(F.concat(p, F.lit(" "), F.col("text"))).alias("response"), sft.preview(F.col("text")).alias("preview"))


@query("SELECT l_orderkey AS k, l_linenumber AS n, array_to_string(list_transform(range(0, 5), lambda i: (CASE WHEN i < l_linenumber % 4 THEN -100 ELSE l_partkey + i END)::BIGINT), ',') AS labels FROM lineitem")
def label_masking(spark, sf_dir):
    labels = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.col("l_partkey") + i)
    return t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.array_join(sft.masked(labels, F.col("l_linenumber") % 4), ",").alias("labels"))


@query("SELECT round(exp(avg(l_discount)), 9) AS perplexity FROM lineitem WHERE l_linenumber <> 1")
def perplexity(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").select(F.col("l_discount").alias("nll"), F.when(F.col("l_linenumber") == 1, -100).otherwise(0).alias("label"))
    return stats.perplexity(rows).select(F.round("perplexity", 9).alias("perplexity"))


# --- rules and reports -----------------------------------------------------------------------------------------------


def _list(*rules: tuple[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in rules) + "], lambda x: x IS NOT NULL)"


# An event without the key session_id still has a typed null there.
_SID = "CASE WHEN event_id % 41 = 0 THEN NULL ELSE session_id END"
_YT = "(contains(url, 'youtube.com') OR contains(url, 'youtu.be'))"
_RULES_A = {
    "schema_errors": _list(("missing:session_id", "event_id % 41 = 0"), ("bad_timestamp", f"NOT {_YEARS5}"), ("labels_not_object", "NOT has_labels")),
    "youtube_errors": _list(
        ("no_video_id", f"{_YT} AND has_meta AND vid IS NULL"), ("video_id_not_in_url", f"{_YT} AND has_meta AND NOT contains(url, vid)"),
        ("duration_range", f"{_YT} AND has_meta AND m_duration <> 0 AND (m_duration < 0 OR m_duration > 86400)"), ("long_short", f"{_YT} AND has_meta AND m_shorts AND coalesce(m_duration, 0) > 300"),
    ),
    "session_errors": _list(
        ("no_duration_hint", f"{_STR('session_id')} AND coalesce(duration_hint, 0) = 0"), ("no_time_of_day", f"{_STR('session_id')} AND NOT {_STR('time_of_day')}"), ("no_day_of_week", f"{_STR('session_id')} AND NOT {_STR('day_of_week')}"),
        ("time_of_day_format", f"{_STR('time_of_day')} AND NOT regexp_matches(time_of_day, '^\\d{{2}}:\\d{{2}}$')"), ("day_of_week_name", f"{_STR('day_of_week')} AND day_of_week NOT IN ({', '.join(map(_q, C.WEEKDAYS))})"),
        ("time_of_day_differs", f"{_STR('time_of_day')} AND {_YEARS5} AND substr(visited_at_iso, 12, 5) <> time_of_day"),
    ),
    "label_errors": _list(("unknown_reason", f"{_STR('reason')} AND reason NOT IN ({', '.join(map(_q, C.REASON_TOPIC))})"), ("long_form_short", "reason = 'shorts/entertainment' AND NOT m_shorts AND coalesce(m_duration, 0) >= 60")),
}


@query(_ev() + "SELECT event_id, " + ", ".join(f"array_to_string({e}, ',') AS {k}" for k, e in _RULES_A.items()) + " FROM ev")
def validate_rules_a(spark, sf_dir):
    v = validate.layout_a(enriched(spark, sf_dir), AS_OF)
    return v.select("event_id", *[F.array_join(k, ",").alias(k) for k in _RULES_A])


@query(
    _ev()
    + f"SELECT event_id, CASE WHEN event_id % 41 = 0 THEN 'session_id' ELSE '' END AS missing, CASE WHEN NOT {_GOOD} THEN 'format' WHEN {_STR('time_of_day')} AND time_of_day <> substr(visited_at_iso, 12, 5) THEN 'time_of_day' "
    f"WHEN {_STR('day_of_week')} AND day_of_week <> strftime(try_cast(substr(visited_at_iso, 1, 10) AS DATE), '%A') THEN 'day_of_week' END AS timestamp_error, CASE WHEN {_YT} AND has_meta THEN "
    f"CASE WHEN {_STR('vid')} AND contains(url, 'youtube.com/watch') AND NOT contains(url, 'v=' || vid) THEN 'video_id' WHEN {_STR('vid')} AND NOT contains(url, 'youtube.com/watch') AND contains(url, 'youtu.be/') AND NOT contains(url, vid) THEN 'video_id' "
    f"WHEN m_duration < 0 THEN 'duration' WHEN m_views < 0 THEN 'views' END END AS youtube_error, CASE WHEN {_STR('session_id')} AND duration_hint IS NULL THEN 'no_duration_hint' WHEN duration_hint < 0 THEN 'duration_hint' END AS session_error, "
    f"CASE WHEN NOT has_labels THEN 'missing' WHEN NOT {_STR('reason')} THEN 'reason' END AS label_error FROM ev"
)
def validate_rules_b(spark, sf_dir):
    v = validate.layout_b(enriched(spark, sf_dir))
    return v.select("event_id", F.array_join("missing", ",").alias("missing"), "timestamp_error", "youtube_error", "session_error", "label_error")


@query(
    _ev(f", c AS (SELECT {', '.join(f'count_if(len({e}) > 0)::BIGINT AS {k}' for k, e in _RULES_A.items())} FROM ev)")
    + "SELECT *, schema_errors = 0 AND youtube_errors = 0 AND session_errors = 0 AND label_errors = 0 AS validation_passed FROM c"
)
def error_counts(spark, sf_dir):
    return stats.error_counts(validate.layout_a(enriched(spark, sf_dir), AS_OF), tuple(_RULES_A))


@query(
    _ev(f", c AS (SELECT count(*)::BIGINT AS total_events, count_if(has_meta)::BIGINT AS cache_hits, count_if({_STR('session_id')})::BIGINT AS session_joins, count_if({_YT})::BIGINT AS youtube_urls, count_if({_YT} AND has_meta)::BIGINT AS youtube_enriched, count_if({_YEARS5})::BIGINT AS valid_timestamps, count_if({_STR('reason')})::BIGINT AS labeled_events FROM ev)")
    + "SELECT *, cache_hits / total_events AS cache_hit_rate, session_joins / total_events AS session_join_rate, youtube_enriched / youtube_urls AS youtube_enrichment_rate, valid_timestamps / total_events AS timestamp_validity_rate, labeled_events / total_events AS label_coverage_rate FROM c"
)
def coverage_metrics(spark, sf_dir):
    return stats.coverage(enriched(spark, sf_dir), AS_OF)


@query(_ev() + "SELECT coalesce(reason, 'NONE') AS value, count(*)::BIGINT AS n FROM ev GROUP BY 1")
def label_distribution(spark, sf_dir):
    return stats.distribution(enriched(spark, sf_dir).select("labels.reason"), "reason", "NONE").select("value", "n")


@query(
    "SELECT count(*)::BIGINT AS total_examples, min(length(text))::INT AS context_min, max(length(text))::INT AS context_max, avg(length(text)) AS context_mean, min(length(lang))::INT AS instruction_min, max(length(lang))::INT AS instruction_max, "
    "avg(length(lang)) AS instruction_mean, (list_sort(list(length(text)))[count(*) // 2 + 1])::INT AS context_median FROM documents"
)
def length_stats(spark, sf_dir):
    return stats.lengths(t(spark, sf_dir, "documents"), "text", "lang")


@query(
    "SELECT n AS total_examples, floor(n * (m / 4))::BIGINT AS estimated_tokens, floor(m)::BIGINT AS mean_context_length, CASE WHEN m < 500 THEN 8 WHEN m < 2000 THEN 4 ELSE 2 END AS batch_size, CASE WHEN m < 500 THEN 2 WHEN m < 2000 THEN 4 ELSE 8 END AS gradient_accumulation_steps, "
    "floor(m * 1.5)::BIGINT AS max_seq_length, 2e-5::DOUBLE AS learning_rate, 3 AS num_epochs FROM (SELECT count(*)::BIGINT AS n, avg(length(text)) AS m FROM documents)"
)
def training_config(spark, sf_dir):
    return stats.training_config(stats.lengths(t(spark, sf_dir, "documents"), "text", "lang"))


@query("SELECT page_id FROM pages ORDER BY md5('42|' || page_id), page_id LIMIT 10")
def spot_check(spark, sf_dir):
    return sampling.spot_check(t(spark, sf_dir, "pages").select("page_id"), "page_id", 10)


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5('42|' || event_id), event_id) AS r FROM events) WHERE r <= 25")
def stratified_by_group(spark, sf_dir):
    return sampling.per_group(t(spark, sf_dir, "events"), "event_type", "event_id", 25).select("event_type", "event_id")


@query("WITH h AS (SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 200), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) AS r, (SELECT count(DISTINCT source) FROM h) AS k FROM h) SELECT doc_id, source FROM r WHERE r <= greatest(1, 100 // k) ORDER BY source, r LIMIT 100")
def golden_by_topic(spark, sf_dir):
    return sampling.golden_by_topic(t(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")


@query("SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k, list_contains(json_keys(props), 'k') AS has_k FROM events")
def json_props_extract(spark, sf_dir):
    e = t(spark, sf_dir, "events").where("props is not null")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.array_contains(F.json_object_keys("props"), "k").alias("has_k"))


_CELL = lambda c: f"coalesce({c}::VARCHAR, '')"
_GOLDEN_SQL = ", ".join(f"{_CELL(c)} AS {c}" for c in ("url", "title", "browser", "profile")) + f", {_AUTH} AS domain, " + ", ".join(f"{_CELL(c)} AS {c}" for c in ("visited_at_iso", "time_of_day", "day_of_week", "session_id", "duration_hint"))
_GOLDEN_SQL += f", {_CELL('reason')} AS label_reason, CASE WHEN has_labels THEN coalesce(reason, 'none') ELSE '' END AS label_topics, " + ", ".join(f"{_CELL(f'm_{c}' if c != 'videoId' else 'vid')} AS content_meta_{c}" for c in ("videoId", "title", "channel", "duration", "views"))
_GOLDEN_SQL += ", CASE WHEN NOT has_meta THEN '' WHEN m_shorts THEN 'True' ELSE 'False' END AS content_meta_is_shorts"


@query(_ev() + f"SELECT event_id, {_GOLDEN_SQL} FROM ev")
def golden_flat_rows(spark, sf_dir):
    from trailforge.sources.csv import golden_rows

    return golden_rows(enriched(spark, sf_dir), keep=("event_id",))


@query("SELECT * FROM (VALUES " + ", ".join(f"({_q(m[0])}, {_q(m[1])}, {m[2]}::BIGINT, {m[3][0]}, {m[3][3]}, {m[5]}, {m[6]}, {m[7]}, {m[8]}, {m[9]})" for m in C.MODELS) + ") v(size, model_name, parameters, fp32_gb, int4_gb, min_gpu_memory, lora_r, lora_alpha, batch_size, gradient_accumulation)")
def model_catalogue(spark, sf_dir):
    rows = [(m[0], m[1], m[2], m[3][0], m[3][3], *m[5:]) for m in C.MODELS]
    return spark.createDataFrame(rows, "size string, model_name string, parameters bigint, fp32_gb int, int4_gb int, min_gpu_memory int, lora_r int, lora_alpha int, batch_size int, gradient_accumulation int")
