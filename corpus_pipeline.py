"""A corpus pipeline of five stages; each is applied to what the one before kept.

Rows go through with the columns of documents; the last stage gives the packed pieces. A stage is handed a table that
was written and read again, so nothing is computed twice; ``run`` writes each stage's result to the shared folder.

Defined results: rows with null or empty texts go through all stages and are packed as one closing token each; null ids
stay null; an empty table gives no rows; further columns of documents, whatever their names, are left behind at the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.llm.common import crc_mod, written
from trailforge.llm.decontam import contamination
from trailforge.llm.neardup import near_duplicates
from trailforge.llm.packing import pack
from trailforge.llm.pii import redacted
from trailforge.llm.toxicity import toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of documents with crc32(doc_id) mod 3 not 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(docs, labels, learn=crc_mod("doc_id", 3) != 1, keep=COLUMNS[2:], text_out=True)
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id. Shingles of five words, a similarity of 0.8.

    Rows are told apart by id and text: of rows that repeat both, the one with the least other columns stays; an id with
    two texts is two documents. Rows without an id are grouped as others are, but after all rows that have one. Rows
    without words are linked with nothing, and all stay.
    """
    last = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    keyed = docs.select(*COLUMNS, F.coalesce("doc_id", last).alias("_id"), F.md5(F.coalesce("text", F.lit(""))).alias("_text_key"))
    found = near_duplicates(keyed, size=5, per_cent=80, id_col="_id", keep=("_text_key",)).where("n_shingles > 0")
    # An id with two texts in one group: the text with the smaller key stays.
    texts = found.where("kept").groupBy("_id", "_text_key", "component").agg(F.count("*").alias("n"))
    first = texts.groupBy("_id", "component").agg(F.min("_text_key").alias("_text_key"))
    stays = texts.join(first, ["_id", "component", "_text_key"]).select("_id", "_text_key", "n")
    decided = keyed.join(stays, ["_id", "_text_key"], "left")
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    single = decided.where((F.col("n") == 1) | wordless).select(*COLUMNS)
    repeated = decided.where((F.col("n") > 1) & ~wordless).groupBy("_id", "_text_key").agg(F.min(F.struct(*COLUMNS)).alias("r")).select("r.*")
    return single.unionByName(repeated)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=COLUMNS[2:], text_out=True)
    return found.where("not contaminated").select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become the name of their kind in brackets; n_chars follows the text."""
    new = redacted(docs.select(*COLUMNS))
    return new.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of at most 4096 tokens as best fit can."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]
#: SQL can't express the classifier, the tokenizer or the packing; a test holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
