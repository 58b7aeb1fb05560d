"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths, max pooling; plain numpy.

A word's vector is the sum of hashed embeddings of the word and of its first five and four letters. Filters of each
width run over the words, the largest response of each is kept, and a linear layer gives the log-odds. Fitting takes at
most ``MAX_PER_CLASS`` labelled rows of either class (those with the least hash of their id) and ``MAX_BYTES`` of their
whole texts, on the driver; scoring runs over whole texts on the executors, in segments that overlap by the widest filter,
with the projections of known words kept in memory.

Thresholds are calibrated by language on labelled rows that the fit left out. A text's language is one that a hashed word
model reads off the text, never a column of the row scored; a monotone map brings each language's threshold to
``DECISION``. Every language with ``LANG_ROWS`` fitted rows has a word model; the rows of all others have one together,
and with it the common threshold. (The lang column of the labelled rows names the word models when they are learnt; with
``lang_col=None`` there is one threshold.)

Defined results: null and empty texts score as a text without words; repeated rows give one row each; labels that are
null are left out; without labels of both classes every text scores 0; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.llm.common import Batches, give_back, small_batches, texts_of

#: Most labelled rows of either class that a model is fitted on.
MAX_PER_CLASS = 2000
#: Most bytes of text that a model is fitted on.
MAX_BYTES = 48_000_000
#: Fitted rows from which a language has a word model of its own.
LANG_ROWS = 30
#: Score from which a text is predicted toxic.
DECISION = 0.7
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 16, 8, (1, 2, 3)
LANG_BUCKETS = 1 << 14
SEGMENT = 1 << 16
#: Fitted texts that a hashed bucket must occur in to be learnt.
MIN_TEXTS = 4
CACHE_WORDS = 250_000

_WORDS = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def features(words: list[str]) -> np.ndarray:
    """Three hashed ids of each word."""
    h = xxhash.xxh32_intdigest
    return np.array([(h(w) % BUCKETS, h("5" + w[:5]) % BUCKETS, h("4" + w[:4]) % BUCKETS) for w in words], np.int64).reshape(-1, 3)


@dataclass
class Model:
    emb: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, DIM), np.float32))
    filters: list[np.ndarray] = field(default_factory=list)  # by width: (width, DIM, FILTERS)
    bias: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray = field(default_factory=lambda: np.zeros(FILTERS * len(WIDTHS), np.float32))
    shift: float = -20.0
    langs: list[str] = field(default_factory=list)
    lang_logs: np.ndarray = field(default_factory=lambda: np.zeros((LANG_BUCKETS, 0), np.float32))
    cuts: np.ndarray = field(default_factory=lambda: np.full(1, 0.5))  # log-odds threshold by language, the last without one

    def rows(self, words: list[str]) -> np.ndarray:
        """Each word's projections on every slice of every filter, then its language logs."""
        f = features(words)
        x = self.emb[f].sum(1)
        return np.hstack([*(x @ w[k] for w in self.filters for k in range(len(w))), self.lang_logs[f[:, 0] % LANG_BUCKETS]]).astype(np.float32)

    def score(self, z: float, lang: int) -> float:
        """1 / (1 + e^-z), moved so that the language's threshold comes to DECISION."""
        at = z - self.cuts[lang] + np.log(DECISION / (1 - DECISION))
        return float(1 / (1 + np.exp(-np.clip(at, -40, 40))))


class Scorer:
    """A model with the projections of the words seen so far."""

    def __init__(self, model: Model):
        self.m = model
        self.width = FILTERS * sum(WIDTHS) + len(model.langs)
        self.reset()

    def reset(self) -> None:
        self.at: dict[str, int] = {}
        self.table = np.zeros((4096, self.width), np.float32)  # row 0: no word

    def ids(self, words: list[str]) -> np.ndarray:
        found = list(map(self.at.get, words))
        if None in found:
            new = [w for w in dict.fromkeys(words) if w not in self.at]
            if len(self.at) + len(new) > CACHE_WORDS:
                self.reset()
                new = list(dict.fromkeys(words))
            n = len(self.at) + 1
            while n + len(new) > len(self.table):
                self.table = np.vstack([self.table, np.zeros_like(self.table)])
            self.at.update(zip(new, range(n, n + len(new)), strict=True))
            self.table[n : n + len(new)] = self.m.rows(new)
            found = list(map(self.at.get, words))
        return np.array(found, np.int64)

    def log_odds(self, text: str) -> tuple[float, int]:
        """Log-odds of being toxic, and the language's number as the words tell it."""
        m, words = self.m, words_of(text)
        pooled = np.zeros(FILTERS * len(WIDTHS), np.float32)
        lang = np.zeros(len(m.langs))
        over = max(WIDTHS) - 1
        for s in range(0, len(words), SEGMENT):
            part = words[s : s + SEGMENT + over]
            n = min(len(part), SEGMENT)
            at = np.append(self.ids(part), np.zeros(over, np.int64))  # may grow the table
            r = self.table[at]
            lang += r[:n, FILTERS * sum(WIDTHS) :].sum(0)
            c = 0
            for i, w in enumerate(WIDTHS):
                z = r[:n, c : c + FILTERS].copy()
                for k in range(1, w):
                    z += r[k : n + k, c + k * FILTERS : c + (k + 1) * FILTERS]
                c += w * FILTERS
                p = pooled[i * FILTERS : (i + 1) * FILTERS]
                np.maximum(p, z.max(0) + m.bias[i], out=p)
        return float(pooled @ m.out + m.shift), int(lang.argmax()) if len(lang) and words else len(m.langs)


def fit(rows: list[tuple[str, int, str | None]], epochs: int = 6, batch: int = 32, rate: float = 0.02, seed: int = 7) -> Model:
    """rows: text, label, language (which serves the calibration by language only)."""
    rng = np.random.default_rng(seed)
    m = Model()
    y = np.array([r[1] for r in rows], np.float32)
    m.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    m.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    if not (y == 1).any() or not (y == 0).any():
        return m
    m.shift = 0.0
    m.emb = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    m.out = np.abs(rng.normal(0.5, 0.1, FILTERS * len(WIDTHS))).astype(np.float32)
    vocabulary: dict[str, int] = {}
    texts = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(r[0])], np.int32) for r in rows]
    known, pad = list(vocabulary), len(vocabulary)
    del vocabulary
    feats = np.zeros((pad + 1, 3), np.int32)
    for i in range(0, pad, 1 << 15):  # in parts, since the ids of a part are Python numbers for a while
        feats[i : i + (1 << 15)][: len(known) - i] = features(known[i : i + (1 << 15)])
    del known
    _languages(m, rows, texts, feats)
    # Buckets that few fitted texts have stay at zero: they could only learn those texts by heart.
    seen = np.bincount(np.concatenate([np.unique(feats[t].ravel()) for t in texts if len(t)] or [np.empty(0, np.int64)]), minlength=BUCKETS) >= MIN_TEXTS
    m.emb *= seen[:, None]
    order = rng.permutation(len(rows))
    held = order[: len(order) // 4]
    train = order[len(order) // 4 :]
    # Either class weighs the same while fitting.
    weight = np.where(y == 1, 0.5 / max(1, (y[train] == 1).sum()), 0.5 / max(1, (y[train] == 0).sum())) * len(train)
    state: dict = {}
    step = 0

    def adam(name, value: np.ndarray, grad: np.ndarray, at=slice(None)) -> None:
        a, b = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        a[at] = 0.9 * a[at] + 0.1 * grad
        b[at] = 0.99 * b[at] + 0.01 * grad * grad
        value[at] -= rate * (a[at] / (1 - 0.9**step)) / (np.sqrt(b[at] / (1 - 0.99**step)) + 1e-6)

    over = max(WIDTHS) - 1
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(train), max(1, len(train) // batch)):
            step += 1
            parts = [np.append(texts[i], [pad] * (over + 1)) for i in at]
            ids = np.concatenate(parts)
            ends = np.cumsum([len(p) for p in parts])
            x = m.emb[feats[ids]].sum(1)
            x[ids == pad] = 0
            pooled, where = [], []
            for i, w in enumerate(WIDTHS):
                z = sum(x[k : len(x) - over + k] @ m.filters[i][k] for k in range(w)) + m.bias[i]
                best = [(e - len(p)) + z[e - len(p) : max(e - over - 1, e - len(p) + 1)].argmax(0) for e, p in zip(ends, parts, strict=True)]
                where.append(np.array(best).clip(0, len(z) - 1))
                pooled.append(np.maximum(z[where[-1], np.arange(FILTERS)], 0))
            pool = np.hstack(pooled)
            p = 1 / (1 + np.exp(-np.clip(pool @ m.out + m.shift, -30, 30)))
            d = ((p - y[at]) * weight[at] / len(at)).astype(np.float32)
            back = d[:, None] * m.out[None, :] * (pool > 0)
            dx: list[tuple[np.ndarray, np.ndarray]] = []
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                df = np.zeros_like(m.filters[i])
                for k in range(w):
                    rows_at = where[i] + k
                    df[k] = np.einsum("bfd,bf->df", x[rows_at], g)
                    dx.append((rows_at.ravel(), (g[:, :, None] * m.filters[i][k].T[None]).reshape(-1, DIM)))
                adam(f"f{i}", m.filters[i], df)
                adam(f"b{i}", m.bias[i], g.sum(0))
            adam("out", m.out, pool.T @ d + 1e-4 * m.out)
            shift = np.array([m.shift], np.float32)
            adam("shift", shift, np.array([d.sum()], np.float32))
            m.shift = float(shift[0])
            at_x, grad = np.concatenate([a for a, _ in dx]), np.concatenate([b for _, b in dx])
            hit = feats[ids[at_x]].ravel()
            keep = seen[hit] & np.repeat(ids[at_x] != pad, 3)
            touched, inverse = np.unique(hit[keep], return_inverse=True)
            total = np.zeros((len(touched), DIM), np.float32)
            np.add.at(total, inverse, np.repeat(grad, 3, axis=0)[keep])
            adam("emb", m.emb, total, touched)
    _calibrate(m, [rows[i] for i in held])
    return m


def _languages(m: Model, rows: list, texts: list[np.ndarray], feats: np.ndarray) -> None:
    """Logs of hashed word shares by language, for telling a text's language from its words."""
    names, n = np.unique([r[2] for r in rows if r[2]], return_counts=True)
    own = [str(x) for x in names[n >= LANG_ROWS]]
    # "" stands for all other languages together.
    which = [(own.index(r[2]) if r[2] in own else len(own)) for r in rows]
    m.langs = own + [""] * (len(own) in which)
    counts = np.full((LANG_BUCKETS, len(m.langs)), 0.1)
    for i, t in zip(which, texts, strict=True):
        counts[:, i] += np.bincount(feats[t, 0] % LANG_BUCKETS, minlength=LANG_BUCKETS)
    m.lang_logs = np.log(counts / counts.sum(0)).astype(np.float32)


def _calibrate(m: Model, rows: list[tuple[str, int, str | None]], least: int = 15) -> None:
    """The threshold of each language: best F1 on rows left out of the fit; with few rows, the one of all rows."""
    scorer = Scorer(m)
    got = [(*scorer.log_odds(r[0]), r[1]) for r in rows]

    def best(part: list[tuple[float, int, int]]) -> float | None:
        z, y = np.array([p[0] for p in part]), np.array([p[2] for p in part])
        low = np.unique(z)
        if len(low) < 2 or y.sum() < 1 or y.all():
            return None
        # Cuts between neighbours; of equally good ones, the middle of the run.
        cuts = (low[1:] + low[:-1]) / 2
        f1 = np.array([2 * y[z >= c].sum() / ((z >= c).sum() + y.sum()) for c in cuts])
        good = cuts[f1 >= f1.max() - 1e-12]
        return float(good[len(good) // 2]) if len(good) > 1 else float(good[0])

    every = best(got)
    every = 0.0 if every is None else every
    m.cuts = np.full(len(m.langs) + 1, every)
    for i in range(len(m.langs)):
        part = [g for g in got if g[1] == i] if m.langs[i] else []
        if sum(g[2] for g in part) >= least and (c := best(part)) is not None:
            m.cuts[i] = c


def labelled(docs: DataFrame, labels: DataFrame, learn: Column | None, most: int, id_col: str, text_col: str, label_col: str, lang_col: str | None, most_bytes: int = MAX_BYTES) -> list[tuple[str, int, str | None]]:
    """At most ``most`` labelled texts of either class and ``most_bytes`` of text, those with the least hash of their
    ids. The ids, which are at most twice ``most``, are broadcast to the texts; texts are fetched until the bytes are full."""
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where("_id is not null and _label in (0, 1)")
    marked = marked.withColumnRenamed("_id", id_col)
    marked = marked.where(learn) if learn is not None else marked
    order = (F.xxhash64(F.col(id_col)), F.col(id_col))
    picked = marked.where("_label = 1").orderBy(*order).limit(most).unionByName(marked.where("_label = 0").orderBy(*order).limit(most))
    lang = docs[lang_col] if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col(id_col), F.coalesce(docs[text_col], F.lit("")).alias("_text"), lang.alias("_lang"))
    rows = texts.join(F.broadcast(picked), id_col).select(id_col, "_text", "_label", "_lang").orderBy(*order, F.xxhash64("_text", "_label"))
    out, left = [], most_bytes
    for r in rows.toLocalIterator():
        left -= len(r["_text"].encode("utf-8", "surrogatepass"))
        if left < 0 and out:
            break
        out.append((r["_text"], r["_label"], r["_lang"]))
    return out


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, most: int = MAX_PER_CLASS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str | None = "lang", keep: tuple[str, ...] = (), text_out: bool = False) -> DataFrame:
    """id, kept columns, score, predicted of every row. learn: which labelled ids may be learnt from. text_out: the text goes on."""
    spark = docs.sparkSession
    small_batches(spark)
    model = fit(labelled(docs, labels, learn, most, id_col, text_col, label_col, lang_col))
    held = spark.sparkContext.broadcast(pickle.dumps(model))
    del model
    give_back(spark)

    def run(batches: Batches) -> Batches:
        scorer = Scorer(pickle.loads(held.value))
        for b in batches:
            scores = [scorer.m.score(*scorer.log_odds(t)) for t in texts_of(b, "_text")]
            others = [b.column(i) for i in range(1, b.num_columns)]  # with the text itself, where it goes on
            yield pa.RecordBatch.from_arrays([*others, pa.array(scores, pa.float64()), pa.array([int(s >= DECISION) for s in scores], pa.int32())], names=[*b.schema.names[1:], "score", "predicted"])

    source = docs.select(F.col(text_col).alias("_text"), id_col, *([text_col] * text_out), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:])
    return source.mapInArrow(run, f"{fields}, score double, predicted int")
