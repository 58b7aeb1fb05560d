"""Exact and near duplicates of chunks, in the order of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.functions.constants import NEAR_DUP
from trailforge.functions.text import tokens
from trailforge.operators.skew import hot_keys, salted_join
from trailforge.shared import written

#: Hash buckets by which the frequency of words is told.
BUCKETS = 1 << 20
#: Rows of an Arrow batch at most: sets of very many words have to fit.
ARROW_ROWS = 2000


def exact_first(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key. One aggregation finds the winners' orders; rows move once, by that order."""
    first = rows.groupBy(key.alias("_k")).agg(F.min(order).alias(order)).select(order)
    return rows.join(first, order, "left_semi")


def word_sets(rows: DataFrame, id_col: str, text: Column) -> DataFrame:
    """c, id, k, h: a number of its own, id, 128-bit hash of the distinct words, and their 64-bit hashes in order, of rows that have words."""
    # Asked of the text, not of the words: a condition on these would be pushed down and find them twice.
    w = rows.where(text.rlike(r"(?U)\S")).select(F.col(id_col).alias("id"), F.sort_array(tokens(text)).alias("w"))
    # No word has white space in it.
    h = F.sort_array(F.transform("w", lambda x: F.xxhash64(x))).alias("h")
    return cut(w.select(F.monotonically_increasing_id().alias("c"), "id", F.md5(F.array_join("w", " ")).alias("k"), h))


def classes_of(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """c, first (least id) of the different sets, c being the number of the first row; and id, c of every row. The sets themselves stay where they are."""
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "c"))
    classes = cut(sets.groupBy("k").agg(least.alias("least"), F.count("*").alias("n")).select("k", F.col("least.c").alias("c"), F.col("least.id").alias("first"), "n"))
    total = sets.count()
    members = salted_join(sets.select("id", "k"), classes.select("k", "c"), ("k",), hot_keys(classes, ("k",), "n", total), F.col("id"))
    return classes.select("c", "first"), members.select("id", "c")


def word_weights(sets: DataFrame) -> np.ndarray:
    """A byte for each of BUCKETS hash buckets of words: 8 times the binary logarithm of how many sets have one of its words, at least of 1."""
    seen = sets.select(F.explode("h").alias("word")).groupBy(F.col("word").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    weight = F.least(F.floor(F.log2("n") * 8), F.lit(255)).cast("short")
    t = seen.where("n > 1").select("bucket", weight.alias("w")).toArrow()
    out = np.zeros(BUCKETS, np.uint8)
    out[t["bucket"].to_numpy()] = t["w"].to_numpy()
    return out


def first_words(sets: DataFrame, over: float) -> DataFrame:
    """c, n (number of words), first: place and word of the first |x| - ceil(over * |x|) + 1 words, without those that no other set can have.

    Any order of words that is the same for all sets will do. Here the weight of the word's bucket goes first, then the
    word: so each set is put in order where it lies, and no word moves.
    """
    small_batches(sets.sparkSession)
    weights = sets.sparkSession.sparkContext.broadcast(word_weights(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        for b in batches:
            h = b.column("h")
            at = h.offsets.to_numpy().astype(np.int64)
            word, at = h.values.to_numpy()[at[0] : at[-1]], at - at[0]
            n = np.diff(at)
            row = np.repeat(np.arange(len(n)), n)
            w = weight[word & (BUCKETS - 1)]
            # Words are in order in each set, which a stable sort leaves so.
            o = np.argsort((row << 8) | w, kind="stable")
            i = np.arange(len(row)) - at[row]
            keep = (i < (n - np.ceil(n * over - 1e-9).astype(np.int64) + 1)[row]) & (w[o] > 0)
            ends = np.concatenate(([0], np.cumsum(np.bincount(row[keep], minlength=len(n)))))
            first = pa.StructArray.from_arrays([pa.array(i[keep].astype(np.int32)), pa.array(word[o][keep])], ["i", "word"])
            yield pa.RecordBatch.from_arrays([b.column("c"), pa.array(n.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), first)], ["c", "n", "first"])

    return sets.select("c", "h").mapInArrow(run, "c long, n int, first array<struct<i int, word long>>")


def similar_classes(classes: DataFrame, sets: DataFrame, over: float) -> DataFrame:
    """ca < cb, similarity: pairs of different word sets whose Jaccard similarity is over the threshold.

    Words are ordered by how many sets have them, rare first, as far as their buckets tell. Two sets that are similar
    enough share a word among their first |x| - ceil(over * |x|) + 1 words; where the first such word stands tells how
    many they can have in common. A word that very many sets have there is dealt to several parts of the join.
    """
    first = first_words(sets, over).join(classes.select("c"), "c").select("c", "n", F.explode("first").alias("p"))
    first = cut(first.select("c", "n", F.col("p.i").alias("i"), F.col("p.word").alias("word")))
    by_word = first.groupBy("word").agg(F.count("*").alias("m"))
    hot = hot_keys(by_word, ("word",), "m", first.count())
    a, b = (first.select(F.col("c").alias(f"c{x}"), F.col("n").alias(f"n{x}"), F.col("i").alias(f"i{x}"), "word") for x in "ab")
    room = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    needed = F.lit(over / (1 + over)) * (F.col("na") + F.col("nb")) - 1e-9
    pairs = salted_join(a, b, ("word",), hot, F.col("ca")).where((F.col("ca") < F.col("cb")) & (F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(over)) & (room >= needed))
    cand = pairs.select("ca", "cb").distinct()
    ha, hb = (sets.select(F.col("c").alias(f"c{x}"), F.col("h").alias(f"h{x}")) for x in "ab")
    common = F.size(F.array_intersect("ha", "hb"))
    return cand.join(ha, "ca").join(hb, "cb").select("ca", "cb", (common / (F.size("ha") + F.size("hb") - common)).alias("similarity")).where(F.col("similarity") > over)


def similar_pairs(rows: DataFrame, id_col: str, text: Column, over: float = NEAR_DUP) -> DataFrame:
    """a < b, similarity: all pairs of rows over the threshold. Rows of equal sets are compared once, and paired at the end,
    since the result names every pair; ``greedy_kept`` needs no such pairs."""
    sets = word_sets(rows, id_col, text)
    classes, members = classes_of(sets)
    ids = cut(members)
    ia, ib = (ids.select(F.col("id").alias(f"i{x}"), F.col("c").alias(f"c{x}")) for x in "ab")
    across = similar_classes(classes, sets, over).join(ia, "ca").join(ib, "cb").select("ia", "ib", "similarity")
    inside = ia.join(ids.select(F.col("id").alias("ib"), F.col("c").alias("ca")), "ca").where("ia < ib").select("ia", "ib", F.lit(1.0).alias("similarity"))
    return across.unionByName(inside).select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "similarity")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage by a table in the shared folder."""
    return written(df, "cut")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of an Arrow batch by rows; a lower setting of the user stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def greedy_kept(rows: DataFrame, id_col: str, text: Column, over: float = NEAR_DUP) -> DataFrame:
    """id, kept: what a scan in the order of ids keeps, that drops a row if a row kept earlier is too similar.

    Of rows with equal word sets only the first can be kept: what drops it drops the others, and if it stays, it drops
    them. So the rounds run over the first rows of the sets, and no pairs of copies are made. In each round, a row whose
    earlier neighbours are all dropped is kept; one with a kept earlier neighbour is dropped.
    """
    sets = word_sets(rows, id_col, text)
    classes, members = classes_of(sets)
    fa, fb = (classes.select(F.col("c").alias(f"c{x}"), F.col("first").alias(f"f{x}")) for x in "ab")
    between = similar_classes(classes, sets, over).join(fa, "ca").join(fb, "cb")
    pairs = cut(between.select(F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b")))
    ids = rows.select(F.col(id_col).alias("id"))
    state = cut(pairs.select(F.col("b").alias("id")).distinct().withColumn("kept", F.lit(None).cast("boolean")))
    while state.where("kept is null").limit(1).count():
        # Rows without an earlier neighbour aren't in the table: they are kept.
        earlier = pairs.join(state.select(F.col("id").alias("a"), F.col("kept").alias("ka"), F.lit(True).alias("known")), "a", "left")
        verdict = earlier.select("b", F.when(F.col("known").isNull(), F.lit(True)).otherwise(F.col("ka")).alias("ka")).groupBy("b").agg(
            F.coalesce(F.bool_or("ka"), F.lit(False)).alias("hit"), F.count_if(F.col("ka").isNull()).alias("waits")
        )
        new = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("hit"), False).when(F.col("waits") == 0, True)
        state = cut(state.join(verdict.withColumnRenamed("b", "id"), "id").select("id", new.alias("kept")))
    copies = members.join(classes.select("c", "first"), "c").where("id <> first").select("id", F.lit(False).alias("kept"))
    return ids.join(state.unionByName(copies), "id", "left").select(F.col("id").alias(id_col), F.coalesce("kept", F.lit(True)).alias("kept"))
