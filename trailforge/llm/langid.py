"""Language by rank-order profiles: a text's most frequent letter n-grams against each language's, by out-of-place distance.

Texts are read as letters (lower case, marks count as letters) and gaps between them, in n-grams of one to three places.
An n-gram is the exact number of its code points, so every script has its own n-grams and none share a place. A profile
is the order of a language's ``PROFILE`` most frequent n-grams. A text's distance to it is the sum, over the text's own
most frequent n-grams, of how far each is from its place in the profile, and ``PROFILE`` for each n-gram the profile lacks.

Learning takes a share of the training rows, by hash of id and text, such that about ``SAMPLE`` rows are read, and at
least ``EACH`` of every language that has them. All languages that occur are learnt; the driver holds a profile of each.
Counts are summed in parts before they are shuffled, and cut to the most frequent before languages are brought together.
Nothing but the text is used for a prediction.

Defined results: null text and texts without a letter give ``und`` with score 0, as do all texts where no language
could be learnt; ties go to the language whose name comes first, and among n-grams to the smaller number; rows with null
lang teach nothing; repeated rows give one row each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.llm.common import Batches, small_batches, texts_of

#: About as many training rows are learnt from, and as many at least of each language (if it has them).
SAMPLE, EACH = 20_000, 50
#: N-grams of a profile, and of a text, that are compared.
PROFILE = 400
#: Characters of a segment; longer texts are counted by segments.
SEGMENT = 1 << 20
#: N-grams held in a learning task before equal ones are added up.
HELD = 1 << 21
#: Bits of a place: a code point, moved up by one past the gap.
PLACE = 21
GAP = 1


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter or a mark."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, back = np.unique(keys, return_inverse=True)
    return out, np.bincount(back, counts, minlength=len(out)).astype(np.int64)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the text's n-grams, in order, and their counts; gaps alone don't count."""
    is_letter = letters()
    parts = []
    before = np.full(1, GAP, np.int64)  # the places before a segment that its n-grams may begin in
    for s in range(0, len(text), SEGMENT):
        p = points(text[s : s + SEGMENT].lower())
        code = np.where(is_letter[p], p.astype(np.int64) + 2, GAP)
        code = np.concatenate((before, code, [GAP])) if s + SEGMENT >= len(text) else np.concatenate((before, code))
        keep = np.ones(len(code), bool)  # a run of gaps is one gap
        keep[1:] = (code[1:] != GAP) | (code[:-1] != GAP)
        code, n = code[keep], len(before)
        two = code[:-1] << PLACE | code[1:]
        one, two, three = code[n:], two[n - 1 :], (two[:-1] << PLACE | code[2:])[max(0, n - 2) :]
        parts.append(np.unique(np.concatenate((one[one != GAP], two, three)), return_counts=True))
        before = code[-2:]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return parts[0] if len(parts) == 1 else _added(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order; ties to the smaller number."""
    if len(keys) > most:
        floor = np.partition(counts, len(counts) - most)[len(counts) - most]
        fine = counts >= floor
        keys, counts = keys[fine], counts[fine]
    return keys[np.lexsort((keys, -counts))][:most]


class Profiles:
    """langs in order of their names, and each one's n-grams in order of their frequency."""

    def __init__(self, langs: list[str], orders: list[np.ndarray]):
        self.langs, self.orders = langs, orders
        self.known = np.unique(np.concatenate([np.asarray(x, np.int64) for x in orders])) if langs else np.zeros(0, np.int64)
        # Place of each known n-gram in each profile; the last column is for n-grams that no profile has.
        self.place = np.full((len(langs), len(self.known) + 1), -1, np.int32)
        for row, order in zip(self.place, orders, strict=True):
            row[np.searchsorted(self.known, order)] = np.arange(len(order))

    def distances(self, mine: np.ndarray) -> np.ndarray:
        i = np.searchsorted(self.known, mine)
        i[i < len(self.known)] = np.where(self.known[i[i < len(self.known)]] == mine[i < len(self.known)], i[i < len(self.known)], len(self.known))
        at = self.place[:, i]
        return np.where(at < 0, PROFILE, np.abs(at - np.arange(len(mine)))).sum(1)

    def predict(self, text: str) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        mine = ranked(*grams(text))
        away = self.distances(mine) / max(1, len(mine))
        best = int(away.argmin())
        # Certain where the others are far further away than the best; an only language by its own distance.
        rest = np.delete(away, best)
        if not len(rest):
            return self.langs[best], float(1 - away[best] / PROFILE)
        odds = np.exp(-(rest - away[best]) / 8.0).sum()
        return self.langs[best], float(1 / (1 + odds))


def learn(docs: DataFrame, train: Column | None, sample: int = SAMPLE, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Profiles:
    """Profiles of the languages of training rows (those where ``train`` holds)."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.where(F.col(lang_col).isNotNull())
    rows = rows.where(train) if train is not None else rows
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"), F.col(id_col).cast("string").alias("_id"))
    shares = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not shares:
        return Profiles([], [])
    # The same number of rows from each language, as far as it has them.
    each = max(EACH, sample // len(shares))
    share = spark.createDataFrame([(k, min(1.0, each / n)) for k, n in sorted(shares.items())], "lang string, _share double")
    unit = F.xxhash64("_id", "text").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(1 << 30)
    picked = rows.join(F.broadcast(share), "lang").where(unit < F.col("_share")).select("lang", "text")

    def count(batches: Batches) -> Batches:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def add_up() -> int:
            for lang, parts in held.items():
                held[lang] = [_added(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
            return sum(len(x[0][0]) for x in held.values())

        def out(lang: str, keys: np.ndarray, counts: np.ndarray) -> Batches:
            for i in range(0, len(keys), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys[part]), pa.string()), pa.array(keys[part]), pa.array(counts[part])], names=["lang", "g", "n"])

        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), texts_of(b), strict=True):
                new = grams(t)
                held.setdefault(lang, []).append(new)
                size += len(new[0])
                if size > HELD and (size := add_up()) > HELD // 2:
                    for lang_, parts in held.items():
                        yield from out(lang_, *parts[0])
                    held, size = {}, 0
        add_up()
        for lang, parts in held.items():
            yield from out(lang, *parts[0])

    counts = picked.mapInArrow(count, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "g")
    top = counts.withColumn("place", F.row_number().over(first)).where(F.col("place") <= PROFILE)
    orders: dict[str, list[tuple[int, int]]] = {}
    for r in top.select("lang", "place", "g").collect():  # PROFILE rows a language at most
        orders.setdefault(r["lang"], []).append((r["place"], r["g"]))
    langs = sorted(orders)
    return Profiles(langs, [np.array([g for _, g in sorted(orders[x])], np.int64) for x in langs])


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score of every row, without a shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast((profiles.langs, profiles.orders))

    def run(batches: Batches) -> Batches:
        p = Profiles(*held.value)
        for b in batches:
            got = [p.predict(t) for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], names=[id_col, "lang_pred", "score"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col].alias("text")).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
