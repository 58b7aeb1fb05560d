"""Column functions against plain Python written from the rules."""

import hashlib
import random
import re
from urllib.parse import parse_qsl, urlencode, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from trailforge.functions import constants as C
from trailforge.functions import ids, sft, text, url
from trailforge.functions import time as T

URLS = [
    "HTTP://www.Example.com/a/b/?utm_source=x&q=1&b=&c=a+b~*%20#frag", "https://example.com/x;y=1?q=%zz", "https://u:p@Example.com:8080/p;a/q;b//?a=1|2",
    "//host/path/", "/only/path?x=1", "https://www.www.a.com", "https://e.org/?gclid=1", "https://e.org/?UTM_source=1&é=ü", "ftp://x.y/z?k=v=w&k=2",
]


def col(spark, values, f, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", f(F.col("v")).alias("o"))
    return [r["o"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def canonical(u):
    p = urlparse(u)
    q = urlencode([(k, v) for k, v in parse_qsl(p.query) if k not in C.TRACKING_PARAMS])
    host = p.netloc.lower()
    return urlunparse((p.scheme.lower() or "https", host[4:] if host.startswith("www.") else host, p.path.rstrip("/"), "", q, ""))


def test_canonical_urls(spark):
    assert col(spark, URLS, url.canonical) == [canonical(u) for u in URLS]
    assert col(spark, [None], url.canonical) == [None]


def test_domains(spark):
    assert col(spark, ["https://www.A.b.Com:80/x", "x", ""], url.normal_domain) == ["a.b.com:80", "", ""]
    assert col(spark, ["https://www.A.b.Com:80/x", "https://localhost/x"], url.last_two_labels) == ["b.com", "localhost"]
    rules = ["com", "co.uk", "*.ck"]
    f = lambda c: url.etld1(c, rules, ["www.ck"])
    assert col(spark, ["a.b.com", "x.y.co.uk", "a.unknown", "com", "p.q.r.ck", "solo"], f) == ["b.com", "y.co.uk", "a.unknown", "com", "p.q.r.ck", "solo"]
    assert col(spark, ["https://m.youtube.com/watch?a=1&v=abc&x", "https://youtu.be/xyz?t=1", "https://youtube.com/shorts/q", "https://youtube.com/watch"], url.video_id) == ["abc", "xyz", None, None]


def test_hash_split(spark):
    values = [hashlib.sha256(str(i).encode()).hexdigest()[:16] for i in range(300)]

    def want(s):
        m = int(hashlib.md5(s.encode()).hexdigest(), 16) % 100
        return "train" if m < 80 else "val" if m < 90 else "test"

    assert col(spark, values, ids.hash_split) == [want(v) for v in values]


def test_times(spark):
    assert col(spark, [13330835056789012], T.from_chromium, "long") == ["2023-06-10T01:44:16.789012Z"]
    assert col(spark, [0, 1_000_000], T.from_firefox, "long") == ["1970-01-01T00:00:00Z", "1970-01-01T00:00:01Z"]
    assert col(spark, [0.5], T.from_safari, "double") == ["2001-01-01T00:00:00.500000Z"]
    iso = ["2024-01-05T21:11:39+05:30", "2024-01-05T21:11:39Z", "2024-01-05 21:11:39", "2024", " 2024-01-05", "nonsense", None, ""]
    assert col(spark, iso, T.wall_clock) == ["21:11", "21:11", "21:11", None, None, None, None, None]
    assert col(spark, iso, T.weekday)[:3] == ["Friday"] * 3
    assert col(spark, iso, T.normalised)[:3] == ["2024-01-05T21:11:39+05:30", "2024-01-05T21:11:39+00:00", "2024-01-05T21:11:39"]
    assert col(spark, iso[:2], lambda c: F.date_format(T.instant(c), "HH:mm")) == ["15:41", "21:11"]
    assert col(spark, ["2018-01-01T00:00:00Z", "2024-01-01T00:00:00Z", None], lambda c: T.within_years(c, "2024-06-01T00:00:00")) == [False, True, False]


def python_redact(t):
    flags = []
    for name, p in C.PII_PATTERNS:
        if re.search(p, t):
            flags.append(name)
        t = re.sub(p, C.REDACTED, t)
    return t, flags


PII = [
    "a@b.co and +1 415-555-0199", "4111 1111 1111 1111", "123-45-6789", "DE89370400440532013000", "eyJabcdefghijk.abcdefghijkl.abcdefghijkl", "sk_live_" + "a" * 24,
    "TOKEN=abcdefghijklmnop", "b" * 32, "x 10.0.0.1:user@h", "nothing here", "é1234 in 1999",
]


def test_redaction(spark):
    assert col(spark, PII, text.redact) == [python_redact(t)[0] for t in PII]
    df = spark.createDataFrame(list(enumerate(PII)), "i int, v string")
    got = {r["i"]: (r["o"], r["f"]) for r in text.with_redaction(df, "v", "o", "f").collect()}
    assert [got[i] for i in range(len(PII))] == [python_redact(t) for t in PII]
    assert col(spark, PII, text.has_pii) == [any(re.search(p, t) for _, p in C.PII_PATTERNS) for t in PII]


@pytest.mark.parametrize("n", [0, 499, 500, 7999, 8000, 8001, 15040, 15041, 22081])
def test_chunks(spark, n):
    t = "x" * n
    want = []
    for i in range(0, n, 7040):
        if len(t[i : i + 8000]) >= 500:
            want.append((i // 7040, len(t[i : i + 8000])))
        if i + 8000 >= n:
            break
    got = col(spark, [t], text.chunks)[0]
    assert [(c["idx"], len(c["chunk"])) for c in got] == want


def test_clean_and_topics(spark):
    html = ["<script>x</script>a  b\n", "see cookies banner " + "z" * 120 + "END", "MENU " + "q" * 100 + "tail"]

    def want(t):
        t = re.sub(r"<script[\s\S]*?</script>", "", t, flags=re.I)
        t = re.sub(r"(?i)cookie(s)?( banner| notice)?[\s\S]{0,100}", "", t)
        t = re.sub(r"(?i)menu[\s\S]{0,100}", "", t)
        return python_redact(re.sub(r"\s+", " ", t))[0].strip()

    assert col(spark, html, text.clean) == [want(t) for t in html]
    assert col(spark, ["a research x", "researcher", "DATASET"], lambda c: text.topic(F.lit("x.org"), c)) == ["research", "other", "research"]
    assert col(spark, ["GitHub.com", "www.cnn.com", "arxiv.org", "x"], lambda c: text.topic(c, F.lit(""))) == ["dev", "news", "research", "other"]
    assert [len(x) for x in col(spark, ["news", "dev", "other"], lambda c: text.templates(c, F.lit("x"), F.lit("")))] == [3, 3, 2]


def test_similarity(spark):
    rng = random.Random(1)
    pairs = [(" ".join(rng.choices("abcdef", k=rng.randint(0, 6))), " ".join(rng.choices("abcdef", k=rng.randint(0, 6)))) for _ in range(60)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = {r["i"]: (r["j"], r["g"]) for r in df.select("i", text.jaccard(text.tokens(F.col("a")), text.tokens(F.col("b"))).alias("j"), text.groundedness(F.col("a"), F.col("b")).alias("g")).collect()}
    for i, (a, b) in enumerate(pairs):
        x, y = set(a.split()), set(b.split())
        assert got[i][0] == pytest.approx(len(x & y) / len(x | y) if x and y else 0)
        assert got[i][1] == pytest.approx(len(x & y) / len(y) if y else 0)


def test_examples(spark):
    assert col(spark, ["a [/INST] b [/INST] c "], sft.response_of) == ["c"]
    assert col(spark, ["x" * 201, "x"], sft.preview) == ["x" * 200 + "...", "x"]
    assert col(spark, ["tutorial/learning", "odd", None], lambda c: sft.reason_topic(c)) == ["education", "general", "general"]
    assert col(spark, [[1, 2, 3]], lambda c: sft.masked(c, F.lit(2)), "array<int>") == [[-100, -100, 3]]
