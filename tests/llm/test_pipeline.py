"""The stages on a small corpus."""

import corpus_pipeline
import __spark_entry__


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}


def test_run(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(1)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(200):
        w = rng.choice(plain, 40).tolist()
        if i % 5 == 0:
            w[3] = w[20] = "nasty"
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(i % 5 == 0)))
    item = " ".join(rng.choice(plain, 12))
    rows += [(300, rows[1][1], "en", "s", 1), (301, f"before {item} after", "en", "s", 1), (302, "mail me at jo@mail.example.com please", "en", "s", 1), (303, None, None, None, None), (304, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = {i for i in range(200) if i % 5}
    assert len(ids & clean) >= 0.98 * len(clean)
    assert len(ids & {i for i in range(200) if i % 5 == 0}) <= 2
    assert 300 not in ids and 301 not in ids and {302, 303, 304} <= ids


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def row_key(rows):
    return sorted(tuple(map(str, r)) for r in rows)


def test_one_row_of_each_group_stays(spark):
    """Against the rule by hand: repeated ids, repeated rows, two texts of one id, null ids, rows without words."""
    a, b, c = ("a text of some words that is here more than once today", "quite another text that stands for itself alone and has no copy", "and a third one of which there are copies without any id at all")
    rows = [
        (5, a, "en", "s", 1), (5, a, "en", "r", 1), (3, a, "en", "s", 1), (3, a, "en", "q", 1), (3, b, "en", "s", 1), (7, a + " x", "en", "s", 1),
        (None, a, "en", "s", 1), (None, c, "en", "t", 1), (None, c, "en", "s", 1), (None, c, "en", "s", 1),
        (8, "", "en", "s", 0), (8, "", "en", "s", 0), (9, None, None, None, None), (None, None, None, None, None), (None, None, None, None, None), (10, " \t ", "en", "s", 3),
    ]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, DOC), "").collect()
    want = [(3, a, "en", "q", 1), (3, b, "en", "s", 1), (None, c, "en", "s", 1), *rows[10:]]
    assert row_key(got) == row_key(want)


def test_stages_equal_brute_force(spark, tmp_path):
    """Each stage on what the one before kept, against plain Python on the same rows."""
    import re
    import zlib

    import numpy as np
    import public_tokenizers
    from trailforge.llm import toxicity
    from trailforge.llm.common import crc_mod
    from tests.llm.test_operators import BASE, base_spans, brute, brute_hits

    rng = np.random.default_rng(4)
    plain = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(150):
        w = rng.choice(plain, 30).tolist()
        if i % 5 == 0:
            w[3] = w[20] = "nasty"
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(i % 5 == 0)))
    items = [(1, " ".join(rng.choice(plain, 14))), (2, "word1 word2 word3"), (None, None)]
    rows += [(200 + i, rows[i][1] + " tail" * (i % 2), "en", "s", 1) for i in range(1, 30)]
    rows += [(300, f"before {items[0][1]} after", "en", "s", 1), (301, "mail me at jo@mail.example.com, +1 (212) 555-0100", "en", "s", 1), (302, None, None, None, None), (303, "", "", "", 0), (None, "no id here but words", None, "s", 2)]
    spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS score", "2 AS node", "3 AS kept", "4 AS runs", "5 AS id").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    own = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).select(*corpus_pipeline.COLUMNS).collect(), DOC)
        own[name] = [tuple(r) for r in docs.collect()]
    # Toxicity: the same fit, scored by the plain sum of the convolution's parts.
    m = toxicity.fit(toxicity.labelled(spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), crc_mod("doc_id", 3) != 1, toxicity.MAX_PER_CLASS, "doc_id", "text", "toxic", "lang"))
    fine = [r for r in rows if m.score(*toxicity.Scorer(m).log_odds(r[1] or "")) < toxicity.DECISION]
    assert row_key(own["toxicity"]) == row_key(fine)
    # Near-duplicates, by all pairs of sets (this input repeats no id; the row without one has no copy).
    ids = {i: c for i, _, c in brute([r[:2] for r in fine], 5)}
    assert row_key(own["near_duplicates"]) == row_key([r for r in fine if r[0] == ids[r[0]]])
    clean = [r for r in own["near_duplicates"] if not brute_hits(r[1], items)[4]]
    assert row_key(own["decontamination"]) == row_key(clean)
    for r in own["personal_data"]:
        before = next(x for x in clean if x[0] == r[0])
        if r[0] == 301:
            assert re.search(r"mail me at \[EMAIL\], \[PHONE\]$", r[1]) and not base_spans(r[1])
        else:
            assert r[:4] == before[:4] and r[4] == (None if r[1] is None else len(r[1]))
    assert len(own["personal_data"]) == len(clean) and set(BASE) == {"email", "ip", "card", "phone"}
    # Packing: every token of every kept text once.
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((str(r[0]), len(x := [*tok.encode(r[1] or "", add_special_tokens=False).ids, 1]), zlib.crc32(np.array(x, "<u4").tobytes())) for r in own["personal_data"])
    packed = stages["packing"](spark, docs, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["length"], r["ids_crc32"]) for r in packed) == want
    # The whole run gives the same pieces.
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in whole) == sorted((i, c) for i, _, c in want)


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOC), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_driver_hands_freed_memory_back(spark, docs, monkeypatch):
    """What malloc keeps of small objects goes back to the system; stages of many jobs see to that as they go."""
    import re
    from pathlib import Path

    from trailforge import shared
    from trailforge.llm import graph, neardup, toxicity

    def mb():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

    # Objects above pymalloc's 512 bytes, every hundredth of which stays.
    held = [bytes(1000) for _ in range(100_000)]
    held = held[::100]
    before = mb()
    shared.give_back(spark)
    assert mb() < before - 50 and len(held) == 1000

    calls = []
    for module in (graph, neardup, toxicity):
        monkeypatch.setattr(module, "give_back", lambda s, m=module.__name__: calls.append(m))
    neardup.near_duplicates(docs).count()
    toxicity.toxicity(docs, spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int")).count()
    assert calls.count("trailforge.llm.graph") >= 3 and {"trailforge.llm.neardup", "trailforge.llm.toxicity"} <= set(calls)
