"""The thin opN queries over the tables of a folder, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trailforge.llm.common import crc_mod, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=4, per_cent=80).drop("component")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.decontam import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.langid import identify, learn

    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs, crc_mod("doc_id", 4) != 2))
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.toxicity import toxicity

    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=crc_mod("doc_id", 3) != 1)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.lm import learn, scores

    docs = table(spark, sf_dir, "documents")
    found = scores(docs, learn(docs, crc_mod("doc_id", 7) != 2))
    return found.select("doc_id", (crc_mod("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.warc import round_trip

    found = round_trip(table(spark, sf_dir, "pages"), least=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.ann import search

    return search(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trailforge.llm.pii import report

    return report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_best_fit_packing, op2_minhash_near_dedup, op3_token_counts, op4_decontamination, op5_language_id, op6_toxicity, op7_lm_scores, op8_warc, op9_nearest_neighbours, op10_pii)}

# --- SQL for the queries whose rows it can give; the others are tested against brute force or the libraries ------------

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(1, len(w) - 3) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s FROM w WHERE len(w) > 0),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c WHERE 100 * k >= 80 * (na + nb - k)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, m.b AS component_id, d.doc_id = m.b AS kept
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = d.doc_id
"""

_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_OP4 = f"""
WITH i AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
v AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
h AS (SELECT p.doc_id, p.p, v.n, v.item FROM p JOIN (SELECT DISTINCT n FROM v) z ON p.p + z.n - 1 <= len(p.w) JOIN v ON v.n = z.n AND v.g = array_to_string(p.w[p.p:p.p + z.n - 1], ' ')),
a AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM h) GROUP BY 1),
b AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(a.n, 0)::BIGINT AS n_hit, coalesce(b.n, 0)::BIGINT AS n_items, sha256(coalesce(b.items, '')) AS items_sha256, coalesce(a.n, 0) > 0 AS contaminated
FROM d LEFT JOIN a ON a.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id
"""

_OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages), f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""

ORACLE_SQL: dict[str, str] = {"op2_minhash_near_dedup": _OP2, "op4_decontamination": _OP4, "op8_warc": _OP8}
