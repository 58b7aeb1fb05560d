"""Registered queries over sources and sinks: tables are written by a sink, read back by a source, and held against SQL.

Sources whose files can't be made from the tables (histories, caches) read small invented files; their SQL lists the rows.
"""

from __future__ import annotations

import json
import sqlite3
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.functions import constants as C
from trailforge.functions import url
from trailforge.operators import joins, stats, suffixes
from trailforge.plans import layouts
from trailforge.plans.queries import _AUTH, _ev, _q, _split, _KEY1, _LW, _context, enriched, query, t
from trailforge.shared import new_path
from trailforge.sources import cache, csv, files, jsonl, sqlite

# --- JSON Lines ------------------------------------------------------------------------------------------------------


def _lines(spark, sf_dir) -> str:
    """A file with whole lines, cut ones, arrays, blank ones, and objects without a time."""
    e = enriched(spark, sf_dir)
    kind = F.col("event_id") % 10
    timeless = F.to_json(F.struct("url", "title"), {"ignoreNullFields": "false"})
    raw = F.when(kind == 0, F.left("_raw", F.lit(30))).when(kind == 1, "[1, 2]").when(kind == 2, " ").when(kind == 3, timeless).otherwise(F.col("_raw"))
    path = new_path(spark, "lines")
    e.select(raw.alias("value")).write.text(path)
    return path


@query(_ev() + "SELECT url, title, visited_at_iso, m_views AS views, m_keys[1] AS keyword, reason, duration_hint FROM ev WHERE event_id % 10 > 3")
def jsonl_lenient(spark, sf_dir):
    e = jsonl.read_events(spark, _lines(spark, sf_dir), require=("visited_at_iso",))
    return e.select("url", "title", "visited_at_iso", F.col("content_meta.views").alias("views"), F.get("content_meta.keywords", F.lit(0)).alias("keyword"), "labels.reason", "duration_hint")


@query("SELECT count_if(event_id % 10 IN (0, 1))::BIGINT AS bad, count_if(event_id % 10 >= 3)::BIGINT AS good FROM events")
def jsonl_bad_lines(spark, sf_dir):
    good, bad = jsonl.parse(jsonl.lines(spark, _lines(spark, sf_dir)))
    both = bad.select(F.lit(1).alias("b")).unionByName(good.select(F.lit(0).alias("b")))
    return both.agg(F.count_if(F.col("b") == 1).alias("bad"), F.count_if(F.col("b") == 0).alias("good"))


@query(_ev() + "SELECT browser, url, title, session_id, reason, 13 AS keys FROM ev")
def jsonl_strict_round_trip(spark, sf_dir):
    path = new_path(spark, "events")
    jsonl.write(enriched(spark, sf_dir).select(*C.REQUIRED_A), path)
    e, _ = jsonl.parse(jsonl.lines(spark, path), strict=True)
    return e.select("browser", "url", "title", "session_id", "labels.reason", F.size(F.json_object_keys("_raw")).alias("keys"))


_EXAMPLES = _ev(f", x AS (SELECT *, left(sha256({_KEY1}), 16) AS sid, {_context('v1')} AS context FROM ev)")


@query(_EXAMPLES + f"SELECT 'dataset_' || {_split('sid')} AS file, {_split('sid')} AS split, count(*)::BIGINT AS n FROM x WHERE length(context) >= 10 GROUP BY ALL")
def split_files(spark, sf_dir):
    path = new_path(spark, "splits")
    m = layouts.layout_v1(enriched(spark, sf_dir))
    jsonl.write_split_files(m.withColumn("split_hint", F.col("meta.split_hint")), path)
    made = spark.read.schema("instruction string, split_hint string").json(f"{path}/dataset_*")
    file = F.regexp_extract(F.col("_metadata.file_path"), "/(dataset_[a-z]+)/", 1)
    return made.select(file.alias("file"), F.col("split_hint").alias("split")).groupBy("file", "split").agg(F.count("*").alias("n"))


@query(_EXAMPLES + f"SELECT 'val' AS split_hint, count(*)::BIGINT AS n FROM x WHERE length(context) >= 10 AND ({_split('sid')}) = 'val'")
def split_filter(spark, sf_dir):
    path = new_path(spark, "parted")
    m = layouts.layout_v1(enriched(spark, sf_dir))
    jsonl.write(m.withColumn("split_hint", F.col("meta.split_hint")), path, by="split_hint")
    made = spark.read.schema("instruction string, meta struct<split_hint:string>, _part string").json(path).where("_part = 'val'")
    return layouts.of_split(made, "val").groupBy(F.col("meta.split_hint").alias("split_hint")).agg(F.count("*").alias("n"))


@query("SELECT count(*)::BIGINT AS total_examples, max(length(text))::BIGINT AS context_max FROM documents")
def report_json(spark, sf_dir):
    path = new_path(spark, "report")
    jsonl.write_report(stats.lengths(t(spark, sf_dir, "documents"), "text", "lang"), path)
    return spark.read.json(path).select("total_examples", "context_max")


# --- CSV -------------------------------------------------------------------------------------------------------------


def _visits(spark, sf_dir) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    title = F.expr("CASE WHEN page_id % 5 = 0 THEN NULL ELSE concat('A \"b\", c ', page_id) END")
    url_ = F.when(F.col("page_id") % 7 == 3, "").otherwise(F.col("url"))
    when = F.expr("concat('2024-01-0', page_id % 9 + 1, 'T00:00:00Z')")
    return p.select(
        F.lit("safari").alias("browser"), F.lit("p").alias("profile"), url_.alias("url"), title.alias("title"), when.alias("visited_at_iso"),
        (F.col("page_id") % 4).cast("int").alias("visit_count"), F.lit("s").alias("source_path"), F.lit("t").alias("snapshot_path"),
    )


_VISIT_SQL = (
    "(SELECT CASE WHEN page_id % 7 = 3 THEN '' ELSE url END AS url, CASE WHEN page_id % 5 = 0 THEN NULL ELSE 'A \"b\", c ' || page_id END AS title, '2024-01-0' || (page_id % 9 + 1) || 'T00:00:00Z' AS visited_at_iso, (page_id % 4)::INT AS visit_count FROM pages)"
)


@query(f"SELECT url, title, visited_at_iso, visit_count FROM {_VISIT_SQL} WHERE url <> ''")
def visits_noisy_csv(spark, sf_dir):
    clean, noisy = new_path(spark, "visits"), new_path(spark, "noisy")
    csv.write(_visits(spark, sf_dir), clean)
    log = spark.createDataFrame([("",), ("[INFO] start",), ("[Safari] 3 rows",), ("[INFO] Exported",)], "value string")
    spark.read.text(clean).unionByName(log).write.text(noisy)
    return csv.read_visits(spark, noisy).select("url", "title", "visited_at_iso", "visit_count")


@query(f"SELECT url, title, visit_count::VARCHAR AS visit_count FROM {_VISIT_SQL} WHERE url <> ''")
def visits_any_csv(spark, sf_dir):
    path = new_path(spark, "visits") + ".csv"
    csv.write(_visits(spark, sf_dir), path)
    return csv.read_any(spark, path)[0].select("url", "title", "visit_count")


@query(f"SELECT count_if(url = '')::BIGINT AS warnings FROM {_VISIT_SQL}")
def visits_any_csv_warnings(spark, sf_dir):
    path = new_path(spark, "visits") + ".csv"
    csv.write(_visits(spark, sf_dir), path)
    return csv.read_any(spark, path)[1]


@query(f"SELECT url, title, visit_count::VARCHAR AS visit_count FROM {_VISIT_SQL} WHERE url <> ''")
def visits_any_jsonl(spark, sf_dir):
    path = new_path(spark, "visits")
    jsonl.write(_visits(spark, sf_dir), path)
    return csv.read_any(spark, path)[0].select("url", "title", "visit_count")


@query("SELECT count_if(event_id % 10 IN (0, 1))::BIGINT AS warnings FROM events")
def visits_any_jsonl_warnings(spark, sf_dir):
    return csv.read_any(spark, _lines(spark, sf_dir))[1]


@query(
    "SELECT u.conv_id || '-' || u.turn AS chunk_id, CASE WHEN length(u.text) >= 500 THEN 1 ELSE 0 END AS length_ok, "
    f"printf('%.2f', coalesce(len(list_intersect({_LW.format('u.text')}, {_LW.format('a.text')}))::DOUBLE / nullif(len({_LW.format('a.text')}), 0), 0)) AS groundedness_score, 0 AS dedup_flag, 'train' AS split "
    "FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"
)
def validation_report(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    e = c.where("role = 'user'").join(a, ["conv_id", "turn"])
    meta = F.struct(F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.lit("train").alias("split_hint"))
    path = new_path(spark, "report")
    csv.write(csv.validation_rows(e.select(F.col("text").alias("context"), "response", meta.alias("meta"))), path)
    made = "chunk_id string, length_ok int, groundedness_score string, dedup_flag int, split string"
    return spark.read.option("header", True).schema(made).csv(path)


@query("SELECT (i / 200)::DOUBLE AS x, printf('%.2f', (i / 200)::DOUBLE) AS s FROM range(0, 201) r(i)")
def two_digit_shares(spark, sf_dir):
    x = spark.range(201).select((F.col("id") / F.lit(200)).alias("x"))
    return x.select("x", csv.two_digits(F.col("x")).alias("s"))


@query(_ev() + "SELECT event_id::VARCHAR AS event_id, url, nullif(title, '') AS title, duration_hint::VARCHAR AS duration_hint, CASE WHEN has_labels THEN '{\"reason\":\"' || reason || '\",\"topics\":[\"' || reason || '\"]}' END AS labels FROM ev WHERE reason IS NOT NULL")
def raw_csv(spark, sf_dir):
    path = new_path(spark, "raw")
    csv.write(csv.raw_rows(enriched(spark, sf_dir).where("labels.reason is not null").select("event_id", "url", "title", "duration_hint", "labels", "_raw")), path)
    return spark.read.option("header", True).option("escape", '"').csv(path)


@query(f"SELECT '\"' || url || '\",\"' || replace(coalesce(title, 'Untitled'), '\"', '\"\"') || '\",\"' || visited_at_iso || '\"' AS line FROM {_VISIT_SQL} WHERE url <> '' UNION ALL SELECT '\"URL\",\"Title\",\"VisitDate\"'")
def quoted_csv(spark, sf_dir):
    path = new_path(spark, "quoted")
    csv.write(csv.export_rows(_visits(spark, sf_dir).where("url <> ''")).coalesce(1), path, quote_all=True)
    return spark.read.text(path).select(F.col("value").alias("line"))


# --- small files beside the data -------------------------------------------------------------------------------------


@query("SELECT 4 AS required, true AS copied, true AS absent, true AS broken")
def schema_files(spark, sf_dir):
    path = new_path(spark, "schema")
    files.put(spark, f"{path}/dataset.json", json.dumps({"required": list(C.SFT_KEYS)}).encode())
    files.put(spark, f"{path}/broken.json", b"{")
    files.copy(spark, f"{path}/dataset.json", f"{path}/out/dataset.json")
    found = files.json_schema(spark, f"{path}/out/dataset.json")
    row = (len(found["required"]), files.exists(spark, f"{path}/out/dataset.json"), files.json_schema(spark, f"{path}/no") is None, files.json_schema(spark, f"{path}/broken.json") is None)
    return spark.createDataFrame([row], "required int, copied boolean, absent boolean, broken boolean")


@query("SELECT count(*)::BIGINT AS counted, false AS written FROM pages")
def dry_run(spark, sf_dir):
    path = new_path(spark, "dry")
    n = files.save(t(spark, sf_dir, "pages"), lambda rows: jsonl.write(rows, path), dry_run=True)
    return spark.createDataFrame([(n, files.exists(spark, path))], "counted long, written boolean")


# Invented rules and domains: plain, longer plain, wildcard, exception (which a wildcard of a shorter candidate precedes).
_RULE_LINES = "// invented\n\ncom\nuk\nco.uk\n*.ck\n!www.ck\n*.kobe.jp\n"
_DOMAINS = {
    "a.b.co.uk": "b.co.uk", "x.org": "x.org", "y.x.org": "x.org", "www.ck": "www.ck", "x.www.ck": "x.www.ck", "foo.bar.ck": "foo.bar.ck", "ck": "ck",
    "a.b.kobe.jp": "a.b.kobe.jp", "kobe.jp": "kobe.jp", "com": "com", "A.Com.": "a.com", "uk": "uk", "one": "one",
}
_DOMAIN_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({_q(k)}, {_q(v)}, {_q(v)})" for k, v in _DOMAINS.items()) + ") v(domain, by_table, by_expression)"


@query(_DOMAIN_SQL)
def suffix_rule_files(spark, sf_dir):
    path = new_path(spark, "rules")
    files.put(spark, f"{path}/rules.dat", _RULE_LINES.encode())
    d = spark.createDataFrame([(k,) for k in _DOMAINS], "domain string")
    rules, exceptions = cache.suffix_rules(spark, f"{path}/rules.dat")
    table = suffixes.rules_table(spark.read.text(f"{path}/rules.dat"))
    return suffixes.registrable(d, "domain", table, "by_table").withColumn("by_expression", url.etld1(F.col("domain"), rules, exceptions))


@query(f"SELECT page_id, CASE WHEN array_length(string_split({_AUTH}, '.')) >= 2 THEN array_to_string(string_split({_AUTH}, '.')[-2:], '.') ELSE {_AUTH} END AS etld1 FROM pages")
def etld1_by_table(spark, sf_dir):
    lines = spark.createDataFrame([("com",), ("net",), ("org",), ("*.ck",)], "value string")
    p = t(spark, sf_dir, "pages").select("page_id", url.authority(F.col("url")).alias("d"))
    return suffixes.registrable(p, "d", suffixes.rules_table(lines)).select("page_id", "etld1")


# --- page texts and caches -------------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('https://www.a.example/x/?utm_source=1', NULL, 'body of a'), ('http://b.example', NULL, 'b' || chr(10) || 'two lines'), ('https://c.example/y', 'no_cache', NULL)) v(url, drop_reason, text)")
def page_text_files(spark, sf_dir):
    import hashlib

    path = new_path(spark, "texts")
    for canon, body in (("https://a.example/x", "body of a"), ("http://b.example", "b\ntwo lines")):
        files.put(spark, f"{path}/{hashlib.sha256(canon.encode()).hexdigest()}.txt", body.encode())
    visits = spark.createDataFrame([("https://www.a.example/x/?utm_source=1",), ("http://b.example",), ("https://c.example/y",)], "url string")
    return joins.page_cache_join(visits, cache.page_texts(spark, path)).select("url", "drop_reason", "text")


def _player(vid: str, **more) -> str:
    return f"<html>var ytInitialPlayerResponse = {json.dumps({'videoDetails': {'videoId': vid, **more}})};</html>"


def _cache_folder(spark: SparkSession) -> str:
    path = new_path(spark, "browser")
    pages = {
        "Default/Cache/Cache_Data/f1": _player("vid1", title="One", author="C", lengthSeconds="42", viewCount="7"),
        "Default/Cache/Cache_Data/deep/er/f2": _player("vid2", title="Two", lengthSeconds="420", keywords=["k", "l"]),
        "Profile 1/Cache/f3": _player("vid1", title="Other", lengthSeconds="x"),
        "Profile 1/Cache/f4": "no player here, though vid2 is named",
        "Profile 1/Else/f5": _player("vid3"),
    }
    for name, body in pages.items():
        files.put(spark, f"{path}/{name}", body.encode())
    return path


@query("SELECT * FROM (VALUES ('Default', 'vid1', 'One', 42::BIGINT, 7::BIGINT, true, NULL), ('Default', 'vid2', 'Two', 420, NULL, false, 'k,l'), ('Profile 1', 'vid1', 'Other', NULL, NULL, false, NULL)) v(profile, video_id, title, duration, views, is_shorts, keywords)")
def cache_video_pages(spark, sf_dir):
    v = cache.video_pages(spark, _cache_folder(spark))
    return v.select(F.replace("profile", F.lit("%20"), F.lit(" ")).alias("profile"), "video_id", *(f"content_meta.{c}" for c in ("title", "duration", "views", "is_shorts")), F.array_join("content_meta.keywords", ",").alias("keywords"))


_J7 = "SELECT e.event_id, e.video, p.title FROM (SELECT event_id, url, {v} AS video, CASE WHEN event_id % 6 = 0 THEN CASE WHEN browser = 'chrome' THEN 'Default' END ELSE profile END AS prof FROM ev) e LEFT JOIN (SELECT 'vid' || i AS vid, CASE WHEN i % 5 = 4 THEN 'Default' ELSE 'p' || (i % 5) END AS prof, 'T' || i AS title FROM range(0, 97) r(i)) p ON p.vid = e.video AND p.prof = e.prof"
_VIDEO = "CASE WHEN contains(url, 'youtube.com/watch') THEN nullif(regexp_extract(url, '[?&]v=([^&#]+)', 1), '') WHEN contains(url, 'youtu.be/') THEN nullif(regexp_extract(url, 'youtu\\.be/([^?&]*)', 1), '') END"


def _video_join(spark, sf_dir, containing: bool) -> DataFrame:
    i = F.col("id")
    pages = spark.range(97).select(F.when(i % 5 == 4, "Default").otherwise(F.concat(F.lit("p"), (i % 5).cast("string"))).alias("profile"), F.concat(F.lit("/c/"), i.cast("string")).alias("path"), F.concat(F.lit("vid"), i.cast("string")).alias("video_id"), F.concat(F.lit("T"), i.cast("string")).alias("title"))
    pages = pages.withColumn("html", F.format_string('var ytInitialPlayerResponse = {"videoDetails":{"videoId":"%s","title":"%s"}};', "video_id", "title"))
    pages = pages.withColumn("content_meta", cache.player_response(F.col("html"))).drop("title")
    e = enriched(spark, sf_dir).select("event_id", "browser", F.when(F.col("event_id") % 6 != 0, F.col("profile")).alias("profile"), "url")
    return joins.youtube_cache_join(e, pages, containing).select("event_id", F.col("video_id").alias("video"), "content_meta.title")


@query(_ev() + _J7.format(v=_VIDEO))
def youtube_cache_by_id(spark, sf_dir):
    return _video_join(spark, sf_dir, False)


@query(_ev() + _J7.format(v=_VIDEO))
def youtube_cache_containing(spark, sf_dir):
    return _video_join(spark, sf_dir, True)


# --- SQLite ----------------------------------------------------------------------------------------------------------

_DATABASES = {
    "chrome/Default/History": "create table urls(id integer, url text, title text, last_visit_time integer, visit_count integer); create table visits(url integer, visit_time integer); "
    "insert into urls values (1, 'https://a.example/', 'A', 13330835056789012, 2), (2, 'https://b.example/', null, 13330835056000000, 1); insert into visits values (1, 13330835056789012), (1, 13330835055000000), (2, 13330835056000000)",
    "firefox/places.sqlite": "create table moz_places(id integer, url text, title text); create table moz_historyvisits(place_id integer, visit_date integer); "
    "insert into moz_places values (1, 'https://f.example/', 'F'); insert into moz_historyvisits values (1, 1686361456000000), (9, 1)",
    "home/Library/Safari/History.db": "create table history_items(id integer, url text, visit_count integer); create table history_visits(history_item integer, title text, visit_time real); "
    "insert into history_items values (1, 'https://s.example/', 3), (2, '', 1); insert into history_visits values (1, 'S', 708054256.5), (1, null, 708054255.0), (2, 'x', 1.0)",
    "knowledge.db": "create table ZOBJECT(ZSTREAMNAME text, ZVALUESTRING text, ZSTARTDATE real, ZENDDATE real); "
    "insert into ZOBJECT values ('com.apple.Safari', 'v', 0.0, 60.5), ('other', 'v', 0.0, 1.0), ('com.apple.browser', 'v', null, 1.0), ('com.apple.Chrome', null, 100.0, 50.0)",
}


def _databases(spark: SparkSession) -> str:
    """A folder with invented histories; SQLite needs files that every host can open, so the shared folder must be mounted."""
    root = Path(new_path(spark, "histories").removeprefix("file://").removeprefix("file:"))
    for name, script in _DATABASES.items():
        at = root / name
        at.parent.mkdir(parents=True, exist_ok=True)
        with sqlite3.connect(at) as db:
            db.executescript(script)
        db.close()
    return str(root)


_CHROME = "('chrome', 'Default', 'https://a.example/', 'A', '2023-06-10T01:44:16.789012Z', 2::INT), ('chrome', 'Default', 'https://a.example/', 'A', '2023-06-10T01:44:15Z', 2), ('chrome', 'Default', 'https://b.example/', NULL, '2023-06-10T01:44:16Z', 1)"
_REST = "('firefox', 'Default', 'https://f.example/', 'F', '2023-06-10T01:44:16Z', NULL), ('safari', 'Default', 'https://s.example/', 'S', '2023-06-10T01:44:16.500000Z', NULL), ('safari', 'Default', 'https://s.example/', '', '2023-06-10T01:44:15Z', NULL), ('safari', 'Default', '', 'x', '2001-01-01T00:00:01Z', NULL)"


@query(f"SELECT * FROM (VALUES {_CHROME}, {_REST}) v(browser, profile, url, title, visited_at_iso, visit_count)")
def sqlite_histories(spark, sf_dir):
    root = _databases(spark)
    out = None
    for name in list(_DATABASES)[:3]:
        rows = sqlite.history(spark, sqlite.snapshot(f"{root}/{name}", folder=root)).drop("source_path")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT * FROM (VALUES ('https://a.example/', '2023-06-10T01:44:16Z', 2::INT), ('https://b.example/', '2023-06-10T01:44:16Z', 1)) v(url, visited_at_iso, visit_count)")
def sqlite_chrome_urls(spark, sf_dir):
    return sqlite.chrome_urls(spark, f"{_databases(spark)}/chrome/Default/History").select("url", "visited_at_iso", "visit_count")


@query("SELECT * FROM (VALUES ('chrome', 'https://a.example/', '2023-06-10T01:44:16.789012Z'), ('safari', 'https://s.example/', '2023-06-10T01:44:16.500000Z')) v(browser, url, visited_at_iso)")
def sqlite_latest_visits(spark, sf_dir):
    root = _databases(spark)
    a, b = (sqlite.history(spark, f"{root}/{n}", limit=1) for n in ("chrome/Default/History", "home/Library/Safari/History.db"))
    return a.unionByName(b).select("browser", "url", "visited_at_iso")


@query("SELECT * FROM (VALUES ('https://s.example/', 'S'), ('https://s.example/', 'Untitled')) v(url, title)")
def sqlite_safari_recent(spark, sf_dir):
    return sqlite.safari_recent(spark, sqlite.safari_history(home=f"{_databases(spark)}/home"))


@query("SELECT * FROM (VALUES ('com.apple.Safari', 'v', 60.5::DOUBLE), ('com.apple.Chrome', NULL, -50.0)) v(stream, value, seconds)")
def sqlite_sessions(spark, sf_dir):
    s = sqlite.sessions(spark, f"{_databases(spark)}/knowledge.db")
    return s.select("stream", "value", ((F.unix_micros("end") - F.unix_micros("start")) / F.lit(1e6)).alias("seconds"))


@query("SELECT * FROM (VALUES ('profiles', 'Default'), ('safari', 'History.db'), ('no safari', NULL), ('damaged', NULL)) v(what, found)")
def sqlite_discovery(spark, sf_dir):
    root = _databases(spark)
    Path(f"{root}/damaged.db").write_bytes(b"not a database")
    rows = [("profiles", ",".join(Path(p).parent.name for p in sqlite.profiles(f"{root}/chrome"))), ("safari", Path(sqlite.safari_history(home=f"{root}/home")).name), ("no safari", sqlite.safari_history(home=root)), ("damaged", sqlite.snapshot(f"{root}/damaged.db", strict=False))]
    return spark.createDataFrame(rows, "what string, found string")


@query("SELECT i AS k, i % 7 AS n FROM range(0, 1000) r(i)")
def sqlite_in_parts(spark, sf_dir):
    """An invented table of 1,000 rows, read by three tasks."""
    at = f"{_databases(spark)}/lines.db"
    with sqlite3.connect(at) as db:
        db.execute("create table lines(k integer, n integer)")
        db.executemany("insert into lines values (?, ?)", [(i, i % 7) for i in range(1000)])
    db.close()
    spark.dataSource.register(sqlite.SqliteSource)
    return spark.read.format("sqlite").option("path", at).option("dbtable", "lines").option("parts", "3").load()
