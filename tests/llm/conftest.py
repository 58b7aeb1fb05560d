import pytest


@pytest.fixture(autouse=True)
def shared(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use themselves."""
    words = "the of and that with from this river stone light water"
    long_ = " ".join(f"word{i % 997} {words}" for i in range(3000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 1),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 1),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, "   \t\n ", None, "b", 3),
        (6, long_, "en", "b", len(long_)),
        (7, "one", "en", "b", 3),
        (8, "Mail me at jo.w@mail.example.com or +1 (017) 555-7713, card 4111 1111 1111 1111, host 10.0.0.255 300.1.1.1", "en", "c", 5),
        (None, "a row without an id", "en", "c", 5),
        (9, "déjà vu naïve café ñandú über größe 日本語 テキスト 😀 <|endoftext|> x", "fr", "c", 5),
        (10, "x" * 50_000, "en", "c", 50_000),
    ]
    df = spark.createDataFrame(rows, DOC)
    for c in ("node", "piece", "n_tokens", "score", "id", "length", "bands", "kept", "runs", "all", "email", "_text", "tokens"):
        df = df.selectExpr("*", f"7 AS {c}")
    return df


@pytest.fixture()
def no_docs(docs):
    return docs.limit(0)
