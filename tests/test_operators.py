"""Operators against plain Python, and sources with files written by the tests."""

import datetime as dt
import json
import random
import re
import sqlite3

import pytest
from pyspark.sql import functions as F

from trailforge.operators import dedup, joins, sampling, stats, validate
from trailforge.plans import layouts, pipeline
from trailforge.sources import cache, csv, jsonl, sqlite


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    events = [(i, at(rng.randrange(40_000))) for i in range(120)]
    sessions = [(f"s{i % 7}", at(a := rng.randrange(40_000)), at(a + rng.randrange(-300, 9000)), i % 2) for i in range(60)]
    e = spark.createDataFrame(events, "event_id long, t timestamp")
    s = spark.createDataFrame(sessions, "stream string, start timestamp, end timestamp, prio int")

    def best(t, rows, prio):
        slop = dt.timedelta(seconds=600)
        hit = [x for x in rows if t >= x[1] - slop and (t < x[1] or t <= x[2] + slop)]
        hit.sort(key=lambda x: (x[3] if prio else 0, -(x[2] - x[1]).total_seconds(), -(x[1] - t0).total_seconds(), x[0]))
        return (f"{hit[0][0]}:{hit[0][1]:%Y-%m-%dT%H:%M:%S}", int((hit[0][2] - hit[0][1]).total_seconds())) if hit else (None, None)

    got = {r["event_id"]: (r["session_id"], r["duration_hint"]) for r in joins.interval_join(e, s.drop("prio")).collect()}
    assert got == {i: best(t, sessions, False) for i, t in events}
    both = joins.priority_join(e, s.where("prio = 0").drop("prio"), s.where("prio = 1").drop("prio"))
    assert {r["event_id"]: (r["session_id"], r["duration_hint"]) for r in both.collect()} == {i: best(t, sessions, True) for i, t in events}


def test_repeated_and_null_events_keep_their_own_session(spark, monkeypatch):
    from trailforge.operators import skew

    h = lambda m: dt.datetime(2024, 1, 1, 10, m)
    e = spark.createDataFrame([(1, h(0)), (1, h(40)), (1, h(0)), (None, h(0)), (2, None), (None, h(40))], "event_id long, t timestamp")
    s = spark.createDataFrame([("a", h(0), h(1)), ("b", h(39), h(50)), ("c", h(58), None)], "stream string, start timestamp, end timestamp")
    a, b, none = ("a:2024-01-01T10:00:00", 60), ("b:2024-01-01T10:39:00", 660), (None, None)
    want = sorted(map(str, [(1, *a), (1, *b), (1, *a), (None, *a), (2, *none), (None, *b)]))
    for least in (1000, 1):  # without and with hot bins
        monkeypatch.setattr(skew, "LEAST", least)
        assert sorted(str((r["event_id"], r["session_id"], r["duration_hint"])) for r in joins.interval_join(e, s).collect()) == want


def rows_shuffled(spark, action):
    """Rows that a call writes to shuffles."""
    sc = spark.sparkContext
    group = f"rows-{random.random()}"
    sc.setJobGroup(group, "")
    action()
    sc.setJobGroup("", "")
    status, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = {x for j in status.getJobIdsForGroup(group) for x in status.getJobInfo(j).stageIds if status.getStageInfo(x)}
    return sum(store.lastStageAttempt(x).shuffleWriteRecords() for x in stages)


def dense(spark, n):
    """n events and n sessions, each session over a third of all events."""
    e = spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 7_777_777).alias("t"))
    at = lambda c: F.timestamp_micros(c * 7_777_777)
    return e, spark.range(n).select(F.lit("s").alias("stream"), at(F.col("id")).alias("start"), at(F.col("id") + n // 3).alias("end"))


def test_interval_join_makes_no_pairs(spark):
    e, s = dense(spark, 3000)
    assert rows_shuffled(spark, lambda: joins.interval_join(e, s).write.format("noop").mode("overwrite").save()) < 50 * 3000


def test_priority_join_makes_no_pairs(spark):
    e, s = dense(spark, 3000)
    assert rows_shuffled(spark, lambda: joins.priority_join(e, s.where("second(start) < 30"), s).write.format("noop").mode("overwrite").save()) < 60 * 3000


def test_session_fields_move_no_lines_that_nobody_asks_for(spark):
    rows = [(1, '{"session_id": "own"}', "own", "2024-01-01T00:00:00Z", None), (2, '{"time_of_day": "x"}', None, "2024-01-01T00:00:00Z", "x"), (3, "{}", None, None, None)]
    e = spark.createDataFrame(rows, "event_id long, _raw string, session_id string, visited_at_iso string, time_of_day string")
    s = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1))], "stream string, start timestamp, end timestamp")
    out = joins.session_fields(e, s, s.limit(0))
    assert out.columns == [*e.columns, "duration_hint", "day_of_week"]
    got = {r["event_id"]: (r["session_id"], r["duration_hint"], r["time_of_day"], r["day_of_week"]) for r in out.collect()}
    a = "a:2024-01-01T00:00:00"
    assert got == {1: ("own", 3600, "00:00", "Monday"), 2: (a, 3600, "x", "Monday"), 3: (None, None, None, None)}
    plan = out.select("event_id", "session_id", "time_of_day")._jdf.queryExecution().optimizedPlan().toString()
    # Read below the join, where the keys are found, but no column that passes through it.
    below = plan[plan.index("Join LeftOuter") :].splitlines()[1]
    assert "Project" in below and not re.search(r"[\[ ]_raw#\d+[,\]]", below)


def test_interval_join_of_all_lengths_equals_brute_force(spark):
    rng = random.Random(11)
    t0 = dt.datetime(1969, 12, 31, 23, 59, 59)
    at = lambda us: t0 + dt.timedelta(microseconds=us)
    span = 2_000_000
    sessions = [(f"s{i % 3}", at(a := rng.randrange(span)), at(a + rng.choice((0, 1, -1, 7, 8, 9, 64, rng.randrange(-5, 8 ** rng.randrange(1, 8)))))) for i in range(400)]
    edges = [x + dt.timedelta(microseconds=d) for _, *se in sessions[:60] for x in se for d in (-1, 0, 1)]
    events = list(enumerate([at(rng.randrange(span)) for _ in range(300)] + edges + [at(10**13), None]))
    e = spark.createDataFrame(events, "event_id long, t timestamp")
    s = spark.createDataFrame(sessions, "stream string, start timestamp, end timestamp")
    for slop in (0, 1):
        gap = dt.timedelta(seconds=slop)

        def best(t, gap=gap):
            hit = [x for x in sessions if t and t >= x[1] - gap and (t < x[1] or t <= x[2] + gap)]
            hit.sort(key=lambda x: (x[1] - x[2], t0 - x[1], x[0]))
            return f"{hit[0][0]}:{hit[0][1]:%Y-%m-%dT%H:%M:%S}" if hit else None

        assert {r["event_id"]: r["session_id"] for r in joins.interval_join(e, s, slop).collect()} == {i: best(t) for i, t in events}


def test_fields_that_are_there_stay(spark):
    rows = [(1, '{"session_id": "own"}', "own", dt.datetime(2024, 1, 1)), (2, '{"session_id": null}', None, dt.datetime(2024, 1, 1)), (3, "{}", None, dt.datetime(2024, 1, 1))]
    e = spark.createDataFrame(rows, "event_id long, _raw string, session_id string, t timestamp")
    s = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1))], "stream string, start timestamp, end timestamp")
    out = joins.interval_join(e, s)
    assert out.columns.count("session_id") == 1
    assert {r["event_id"]: r["session_id"] for r in out.collect()} == {1: "own", 2: None, 3: "a:2024-01-01T00:00:00"}
    assert {r["session_id"] for r in joins.interval_join(e.drop("_raw"), s).collect()} == {"own", None}


def test_salted_joins_equal_plain_ones(spark):
    from trailforge.operators.skew import hot_keys, salted_join

    rows = spark.createDataFrame([(i % 3 if i % 10 else None, i) for i in range(3000)], "k int, v int")
    table = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "k int, s string")
    counts = rows.groupBy("k").count()
    assert hot_keys(counts, ("k",), "count", 900) is None and hot_keys(counts, ("k",), "count", 3000).count() == 0
    hot = spark.createDataFrame([(0, 5)], "k int, _salts int")
    for how in ("inner", "left"):
        key = lambda df: sorted(map(str, df.select("k", "v", "s").collect()))
        assert key(salted_join(rows, table, ("k",), hot, F.col("v"), how)) == key(rows.join(table, "k", how))


def test_mersenne_split_is_pythons(spark):
    import hashlib

    names = [f"d{i}.org" for i in range(300)] + [None, "d1.org"]
    got = {r["d"]: r["split"] for r in sampling.mersenne_split(spark.createDataFrame([(n,) for n in names], "d string"), "d").collect()}
    want = {}
    for n in names[:300]:
        random.seed(int(hashlib.md5(n.encode()).hexdigest(), 16))
        x = random.random()
        want[n] = "train" if x < 0.8 else "val" if x < 0.9 else "test"
    assert got == want


def test_the_longest_session_wins(spark):
    h = lambda x, m: dt.datetime(2024, 1, 1, x, m)
    e = spark.createDataFrame([(1, h(10, 0))], "event_id long, t timestamp")
    s = spark.createDataFrame([("a", h(9, 59), h(10, 1)), ("b", h(10, 5), h(11, 5))], "stream string, start timestamp, end timestamp")
    r = joins.interval_join(e, s).first()
    assert (r["session_id"], r["duration_hint"]) == ("b:2024-01-01T10:05:00", 3600)


def test_near_duplicates_equal_a_scan(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        base = rng.sample(words, 40) if i % 8 == 0 else list(rows[-1][1].split())
        if i % 8:
            base[rng.randrange(len(base))] = rng.choice(words)
        rows.append((i, " ".join(base)))
    rows += [(80, ""), (81, ""), (82, rows[0][1])]
    df = spark.createDataFrame(rows, "id long, text string")
    sets = [set(t.split()) for _, t in rows]
    jac = lambda a, b: len(a & b) / len(a | b) if a and b else 0.0
    want = {(a, b) for b in range(len(rows)) for a in range(b) if jac(sets[a], sets[b]) > 0.92}
    assert {(r["a"], r["b"]) for r in dedup.similar_pairs(df, "id", F.col("text")).collect()} == want
    kept = []
    for i in range(len(rows)):
        if all(jac(sets[i], sets[j]) <= 0.92 for j in kept):
            kept.append(i)
    assert {r["id"] for r in dedup.greedy_kept(df, "id", F.col("text")).where("kept").collect()} == set(kept)


def texts(spark, n, parts=1):
    """n texts of about 100 of 3000 words, some of them rare; near copies are apart by n // 2, and two texts have no words."""
    rng = random.Random(9)
    rows = [" ".join(f"w{int(rng.random() ** 3 * 3000)}" for _ in range(130)) for _ in range(n // 2)]
    rows += [" ".join(t.split()[: 130 - i % 9]) for i, t in enumerate(rows)]
    return spark.createDataFrame([*enumerate(rows), (n, " "), (n + 1, None)], "id long, text string").repartition(parts), rows


def test_near_duplicates_move_no_words(spark):
    df, _ = texts(spark, 1000)
    for f in (dedup.greedy_kept, dedup.similar_pairs):
        # 1,000 texts have 100,000 words.
        assert rows_shuffled(spark, lambda f=f: f(df, "id", F.col("text")).write.format("noop").mode("overwrite").save()) < 60_000


def test_near_duplicates_with_words_in_the_same_bucket(spark, monkeypatch):
    df, rows = texts(spark, 200, 3)
    sets = [set(t.split()) for t in rows]
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in range(len(rows)) for a in range(b)}
    want = {k: v for k, v in want.items() if v > 0.92}
    assert want
    for buckets in (1, 64, dedup.BUCKETS):
        monkeypatch.setattr(dedup, "BUCKETS", buckets)
        assert {(r["a"], r["b"]): r["similarity"] for r in dedup.similar_pairs(df, "id", F.col("text")).collect()} == want


def test_a_copy_of_a_row_without_id_is_dropped(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "b a"), (2, "a  b"), (4, "c")], "id long, text string")
    assert {r["id"]: r["kept"] for r in dedup.greedy_kept(df, "id", F.col("text")).where("id is not null").collect()} == {2: True, 3: False, 4: True}


def test_rank_split_sizes(spark):
    df = spark.createDataFrame([(i, f"d{i % 57}.org") for i in range(300)], "i long, d string")
    got = {r["d"]: r["split"] for r in sampling.rank_split(df, "d").collect()}
    n = [sum(v == s for v in got.values()) for s in ("train", "val", "test")]
    assert n == [int(57 * 0.8), int(57 * 0.1), 57 - int(57 * 0.8) - int(57 * 0.1)]
    assert got == {r["d"]: r["split"] for r in sampling.rank_split(df.repartition(7), "d").collect()}


def test_golden_sample(spark):
    rows = [(i, f"https://youtu.be/{i}" if i % 3 == 0 else f"https://x.org/{i}", f"r{i % 4}", i % 2 == 0, i % 5 == 0) for i in range(500)]
    df = spark.createDataFrame(rows, "event_id long, url string, reason string, has_meta boolean, has_session boolean")
    a = [r["event_id"] for r in sampling.golden(df, 60).collect()]
    assert len(a) == len(set(a)) == 60
    assert sorted(a) == sorted(r["event_id"] for r in sampling.golden(df.repartition(5), 60).collect())


def test_stats(spark):
    df = spark.createDataFrame([("x" * n, "yy") for n in (1, 2, 3, 4)], "context string, instruction string")
    r = stats.lengths(df).first()
    assert (r["context_median"], r["context_mean"], r["total_examples"]) == (3, 2.5, 4)
    c = stats.training_config(stats.lengths(df)).first()
    assert (c["batch_size"], c["gradient_accumulation_steps"], c["max_seq_length"], c["estimated_tokens"]) == (8, 2, 3, 2)


EVENT = {
    "browser": "chrome", "profile": None, "url": "https://www.youtube.com/watch?v=abc", "domain": "x", "title": "", "visited_at_iso": "2024-01-05T10:00:00Z",
    "content_meta": {"videoId": "abc", "title": "T", "duration": 75, "views": 1234567, "keywords": ["a", "b"], "is_shorts": False},
    "transcript_excerpt": None, "session_id": "s", "time_of_day": "10:00", "day_of_week": "Friday", "duration_hint": 0, "labels": {"reason": "general", "topics": []},
}


@pytest.fixture()
def events(spark, tmp_path):
    bad = {k: v for k, v in EVENT.items() if k not in ("session_id", "labels")} | {"visited_at_iso": "no", "url": "https://x.org/a", "content_meta": None}
    lines = [json.dumps(EVENT), "", "not json", "[1, 2]", json.dumps(bad), json.dumps(EVENT | {"labels": None, "url": "", "title": "é"}, ensure_ascii=False)]
    (tmp_path / "e.jsonl").write_text("\n".join(lines), encoding="utf-8")
    return jsonl.lines(spark, str(tmp_path / "e.jsonl"))


def test_lenient_reader_and_rules(spark, events):
    good, bad = jsonl.parse(events)
    assert good.count() == 3 and bad.count() == 2
    v = {r["url"]: r for r in validate.layout_a(good, "2024-06-01T00:00:00").collect()}
    assert v[EVENT["url"]]["session_errors"] == ["no_duration_hint"] and v[EVENT["url"]]["schema_errors"] == []
    assert v["https://x.org/a"]["schema_errors"] == ["missing:session_id", "missing:labels", "bad_timestamp"]
    assert v[""]["schema_errors"] == ["labels_not_object"]
    b = {r["url"]: r for r in validate.layout_b(good).collect()}
    assert b[EVENT["url"]]["session_error"] is None and b["https://x.org/a"]["missing"] == ["session_id", "labels"]
    assert b["https://x.org/a"]["timestamp_error"] == "format" and b[""]["label_error"] == "missing"


def test_layouts_and_sinks(spark, events, tmp_path):
    good, _ = jsonl.parse(events)
    rows = {r["meta"]["url"]: r for r in layouts.layout_v1(good).collect()}
    assert rows[EVENT["url"]]["context"] == "Title: T | Duration: 1m 15s | Views: 1,234,567 | Keywords: a, b"
    assert rows["https://x.org/a"]["context"] == "URL: https://x.org/a"
    assert layouts.layout_v2(good).count() == 2 and layouts.layout_v3(good).count() == 3
    jsonl.write_split_files(layouts.layout_v1(good).withColumn("split_hint", F.col("meta.split_hint")), str(tmp_path / "o"))
    made = spark.read.text(f"{tmp_path}/o/dataset_*")
    assert made.count() == 2 and made.where("value like '%\"response\":\"\"%'").count() == 2
    checked = made.select(validate.example_schema(F.col("value")).alias("e")).collect()
    assert all(r["e"] == [] for r in checked)
    p = pipeline.prepare(good, "2024-06-01T00:00:00", 10)
    assert p.errors.first()["validation_passed"] is False and p.golden.count() == 3 and p.config.count() == 1
    csv.write(csv.golden_rows(good), str(tmp_path / "g"))
    assert len(spark.read.option("header", True).csv(str(tmp_path / "g")).columns) == 18


def test_noisy_csv(spark, tmp_path):
    head = ",".join(csv.VISIT_COLUMNS)
    (tmp_path / "v.csv").write_text(f'\n[INFO] x\n[Safari] y\n{head}\nsafari,p,https://a.org/,"A, ""b""",2024-01-01T00:00:00Z,3,s,t\nsafari,p,,no url,,1,s,t\n[INFO] done\n')
    rows = csv.read_visits(spark, str(tmp_path / "v.csv")).collect()
    assert [(r["url"], r["title"], r["visit_count"]) for r in rows] == [("https://a.org/", 'A, "b"', 3)]


def test_sqlite_histories(spark, tmp_path):
    c = sqlite3.connect(tmp_path / "History")
    c.executescript("create table urls(id, url, title, last_visit_time, visit_count); create table visits(url, visit_time)")
    c.execute("insert into urls values (1, 'https://a.org', 'A', 13330835056789012, 2)")
    c.executemany("insert into visits values (1, ?)", [(13330835056789012,), (13330835056000000,)])
    c.commit()
    c.close()
    copy = sqlite.snapshot(str(tmp_path / "History"))
    rows = sqlite.history(spark, copy).collect()
    assert sorted(r["visited_at_iso"] for r in rows) == ["2023-06-10T01:44:16.789012Z", "2023-06-10T01:44:16Z"]
    assert sqlite.history(spark, copy, limit=1).collect()[0]["visited_at_iso"].endswith("789012Z")
    k = sqlite3.connect(tmp_path / "k.db")
    k.executescript("create table ZOBJECT(ZSTREAMNAME, ZVALUESTRING, ZSTARTDATE, ZENDDATE); insert into ZOBJECT values ('com.apple.Safari', 'v', 0.0, 60.5), ('other', 'v', 0.0, 1.0), ('com.apple.browser', 'v', null, 1.0)")
    k.commit()
    k.close()
    s = sqlite.sessions(spark, str(tmp_path / "k.db")).collect()
    assert len(s) == 1 and (s[0]["end"] - s[0]["start"]).total_seconds() == 60.5
    with pytest.raises(sqlite3.Error):
        sqlite.snapshot(str(tmp_path / "absent" / "x"))
    assert sqlite.snapshot(str(tmp_path / "absent" / "x"), strict=False) is None


def test_caches(spark, tmp_path):
    import hashlib

    canon = "https://a.org/x"
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / f"{hashlib.sha256(canon.encode()).hexdigest()}.txt").write_text("body\ntext")
    visits = spark.createDataFrame([("https://www.a.org/x/?utm_source=1",), ("https://b.org",)], "url string")
    rows = {r["url"]: (r["text"], r["drop_reason"]) for r in joins.page_cache_join(visits, cache.page_texts(spark, str(tmp_path / "c"))).collect()}
    assert rows == {"https://www.a.org/x/?utm_source=1": ("body\ntext", None), "https://b.org": (None, "no_cache")}
    player = {"videoDetails": {"videoId": "abc", "title": "T", "author": "C", "lengthSeconds": "42", "viewCount": "x", "keywords": ["k"]}}
    d = tmp_path / "b" / "Default" / "Cache" / "Cache_Data"
    d.mkdir(parents=True)
    (d / "f1").write_text(f"<html>var ytInitialPlayerResponse = {json.dumps(player)};</html>")
    (d / "f2").write_text("nothing")
    pages = cache.video_pages(spark, str(tmp_path / "b"))
    r = pages.first()
    assert (r["profile"], r["video_id"], r["content_meta"]["duration"], r["content_meta"]["views"], r["content_meta"]["is_shorts"]) == ("Default", "abc", 42, None, True)
    e = spark.createDataFrame([("Default", "https://youtu.be/abc"), ("Default", "https://youtu.be/no")], "profile string, url string")
    assert sorted(x["content_meta"] is not None for x in joins.youtube_cache_join(e, pages).collect()) == [False, True]
    (tmp_path / "psl").write_text("// c\n\ncom\n!www.ck\n*.ck\n")
    assert cache.suffix_rules(spark, str(tmp_path / "psl")) == (["com", "*.ck"], ["www.ck"])


def test_pages_to_examples_modes(spark):
    body = " ".join(f"word{i}" for i in range(200))
    rows = [(1, "https://github.com/a", "T", body), (2, "https://x.org/b", "U", body), (3, "https://x.org/c", "V", None), (4, "https://x.org/d", "W", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, title string, text string")
    made, drops = layouts.pages_to_examples(pages)
    assert [r["meta"]["title"] for r in made.collect()] == ["T"]
    assert {r["drop_reason"]: r["n"] for r in drops.collect()} == {"no_cache": 1, "too_short": 1, "dedup": 1, "near_dup": 3}
    again = pages.unionByName(spark.createDataFrame([(1, "https://x.org/e", "X", body + " more"), (None, "https://x.org/f", "Y", body[::-1])], pages.schema))
    made, drops = layouts.pages_to_examples(again, mode="intended")
    assert sorted(r["meta"]["title"] for r in made.collect()) == ["T"] * 3 + ["Y"] * 2
    made, drops = layouts.pages_to_examples(pages, limit=1)
    assert [r["meta"]["title"] for r in made.collect()] == ["T"] and {r["drop_reason"] for r in drops.collect()} == {"near_dup"}
    assert layouts.pages_to_examples(pages, mode="intended")[0].count() == 3


def test_streams(spark, tmp_path):
    from trailforge.streaming import sessions as S

    t = lambda m: dt.datetime(2024, 1, 1, 10, m)
    spark.createDataFrame([(1, t(0)), (1, t(1)), (2, t(2))], "event_id long, t timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id long, t timestamp").parquet(str(tmp_path / "in"))
    stored = spark.createDataFrame([("a", t(0), t(30))], "stream string, start timestamp, end timestamp")
    for name, df, mode in (("m", S.matches(stream, stored), "complete"), ("f", S.first_visits(stream, ("event_id",)), "append"), ("c", S.counts(stream, "event_id"), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp{name}")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        q.stop()
    assert spark.table("f").count() == 2 and spark.table("c").count() == 2 and {r["stream"] for r in spark.table("m").collect()} == {"a"}


def test_near_duplicates_of_examples_are_looked_for_once_a_chunk(spark, monkeypatch):
    looked = []
    real = layouts.greedy_kept
    monkeypatch.setattr(layouts, "greedy_kept", lambda rows, *a: looked.append(rows.count()) or real(rows, *a))
    body = lambda k: " ".join(f"word{k}x{i}" for i in range(200))
    # The third page repeats the second one's text, but as news it has one more instruction, which no earlier row has.
    pages = [(1, "https://a.org/1", "one", body(1)), (2, "https://a.org/2", "two", body(2)), (3, "https://news.org/3", "three", body(2)), (4, "https://a.org/4", "four", body(1) + " more")]
    df = spark.createDataFrame(pages, "page_id long, url string, title string, text string")
    got = {(r["ord"]["order"], r["ord"]["tno"]) for r in layouts.pages_to_examples(df)[0].collect()}
    assert got == {(1, 0), (2, 0)}
    assert looked == [3]
