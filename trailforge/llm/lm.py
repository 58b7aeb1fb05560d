"""Language-model scores by an n-gram trie in Elias-Fano coded levels that are mapped from shared files.

Learning counts all tokens of the training texts: sums in each task, then a partial and a final aggregation by 64-bit
hash. N-grams are summed in each task, dealt by their hash in packed rows and added up. Every word has an id, its place in the order of hashes; all n-grams of two and three words that occur ``least``
times or more (two, unless told otherwise; one keeps all) are the trie's levels. Words that occur less often can't be in
one and are left out before counting.

Files: the vocabulary, in shards by the hash's leading bits, has every word's hash (monotone, Elias-Fano) and count; the
place there, after the words of the shards before, is the word's id, so a task looks ids up in the mapped files. The
trie, in shards by the first word, has for each level pointers to the ranges of children (monotone), the children's
words, made monotone by adding what the range before ended at, and eight-bit logarithms of discounted probabilities and
of the weight that backing off has. A look-up goes to the range of its context and finds the word's successor there.
Every task maps the same files; nothing of the model's size is sent to the driver or broadcast.

P(w | uv) = q(uvw) + rest(uv) * (q(vw) + rest(v) * P(w)), where q = (count - D) / count of the context, rest is what
the children leave of 1, P(w) = (count - D1) / N for known words and D1 * V / N for the unknown one. Quantising rounds
down, so that the sum over words stays at most 1.

Defined results: null text counts as empty and has the one end token; repeated rows are counted and scored each; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.llm.common import Batches, files_at, map_file, new_folder, put_file, small_batches, texts_of, written
from trailforge.llm.eliasfano import EliasFano, pack, unpack

#: Least count of an n-gram of two or three words.
LEAST, DISCOUNT = 2, 0.75
#: Entries of a shard at most, about; least number of shards.
SHARD, SHARDS = 1 << 20, 64
FLUSH_WORDS = 400_000
CACHE_WORDS = 400_000
#: Tokens whose n-grams are counted at once (numbers of three of its distinct words fit 63 bits), and tokens scored at once.
PIECE, SCORED = 1 << 20, 1 << 19
#: Most n-grams of a bucket, about, that are added up at once.
BUCKET = 1 << 22
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
#: Codes of eight bits: 0 for none, else 2 ** (-(code - 1) / 10), from 1 down to about 2e-8.
CODE = np.concatenate(([0.0], 2.0 ** (-np.arange(255) / 10)))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def word_hash(word: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


END = word_hash(b"")  # no word is empty


def quantise(p: np.ndarray) -> np.ndarray:
    """The code of the largest value that isn't above p; too small ones become 0."""
    c = np.ceil(-10 * np.log2(np.maximum(p, 1e-30)) - 1e-9).astype(np.int64) + 1
    return np.where(c > 255, 0, np.maximum(c, 1)).astype(np.uint8)


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = word_hash(word)
        return h


class Hashes:
    """Hashes of words, with a memory of bounded size."""

    def __init__(self):
        self.known = _Known()

    def of(self, tokens: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        out = np.empty(len(tokens) + 1, np.int64)
        out[:-1] = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        out[-1] = END
        return out


def _counts(texts: DataFrame) -> DataFrame:
    """h, c of all tokens."""

    def run(batches: Batches) -> Batches:
        from collections import Counter

        total: Counter = Counter()
        ends = 0

        def flush():
            h = np.array([word_hash(w) for w in total], np.int64)
            out = pa.RecordBatch.from_arrays([pa.array(np.append(h, END)), pa.array([*total.values(), ends], pa.int64())], names=["h", "n"])
            total.clear()
            return out

        for b in batches:
            for t in texts_of(b):
                total.update(words(t))
                ends += 1
                if len(total) >= FLUSH_WORDS:
                    yield flush()
                    ends = 0
        if ends or total:
            yield flush()

    return texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("c")).where("c > 0")


class Vocabulary:
    """Ids, from 1 in the order of hashes, and counts of all words, by the mapped files."""

    def __init__(self, folder: str, stats: dict):
        self.folder, self.bits, self.starts, self.least = folder, stats["bits"], np.array(stats["starts"], np.int64), stats["least"]

    def _files(self, shard: np.ndarray):
        order = np.argsort(shard, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(at) and (found := _open(self.folder, f"words-{shard[at[0]]}.bin")):
                yield at, *found

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of distinct hashes, 0 for unknown ones."""
        bits, u = np.uint64(self.bits), h.view(np.uint64)
        shard = (u >> (np.uint64(64) - bits)).astype(np.int64)
        ids, counts = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        for at, arrays, ef in self._files(shard):
            i = ef["h"].find((u[at] << bits) >> bits)
            at, i = at[i >= 0], i[i >= 0]
            ids[at], counts[at] = self.starts[shard[at]] + i + 1, arrays["c"][i]
        return ids, counts

    def counts(self, ids: np.ndarray) -> np.ndarray:
        shard = np.searchsorted(self.starts, ids - 1, "right") - 1
        out = np.zeros(len(ids), np.int64)
        for at, arrays, _ in self._files(shard):
            out[at] = arrays["c"][ids[at] - 1 - self.starts[shard[at]]]
        return out


def _ngrams(h: np.ndarray, starts: int, vocabulary: Vocabulary):
    """Words' ids (the third is 0 for pairs) and counts of the n-grams that begin at the first places. A text ends with END."""
    distinct, at = np.unique(h, return_inverse=True)
    ids, counts = vocabulary.find(distinct)
    ok = (counts >= vocabulary.least)[at]
    inner = ok & (h != END)
    bits = len(distinct).bit_length()
    for n in (2, 3):
        m = max(0, min(starts, len(h) - n + 1))
        key, fine = np.zeros(m, np.int64), ok[n - 1 : n - 1 + m].copy()
        for i in range(n):
            key = key << bits | at[i : i + m]
            if i < n - 1:
                fine &= inner[i : i + m]
        key, c = np.unique(key[fine], return_counts=True)
        words_ = [ids[key >> (bits * (n - 1 - i)) & ((1 << bits) - 1)] for i in range(n)]
        yield (*words_, *[np.zeros(len(key), np.int64)] * (3 - n), c)


def _packed(columns: tuple[np.ndarray, ...]) -> tuple[int, bytes]:
    """Bytes of a number, and four columns by planes of bytes, compressed. The first holds differences."""
    a = np.stack(columns).astype(np.uint32 if max(x.max() for x in columns) < 1 << 32 else np.uint64)
    a[0] = np.diff(a[0], prepend=a.dtype.type(0))
    width = a.dtype.itemsize
    return width, pa.Codec("zstd", 1).compress(a.view(np.uint8).reshape(4, -1, width).transpose(0, 2, 1).tobytes(), asbytes=True)


def _unpacked(width: int, rows: int, data: bytes) -> np.ndarray:
    raw = np.frombuffer(pa.Codec("zstd", 1).decompress(data, 4 * width * rows, asbytes=True), np.uint8)
    a = np.ascontiguousarray(raw.reshape(4, width, rows).transpose(0, 2, 1)).view(np.uint32 if width == 4 else np.uint64)[:, :, 0].copy()
    a[0] = np.cumsum(a[0], dtype=a.dtype)
    return a.astype(np.int64)


def _sorted(x: np.ndarray, y: np.ndarray, number: bool = False):
    """Order that brings equal pairs together and where new ones begin in it, or the pairs' numbers. x is numbered where the two don't fit."""
    if x.max() >= 1 << 31 or y.max() >= 1 << 32:
        x, y = (np.unique(v, return_inverse=True)[1] for v in (x, y))
    key = x << 32 | y
    order = np.argsort(key)
    new = np.diff(key[order], prepend=-1) != 0
    if not number:
        return order, new
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(new)
    return out


def _bucket(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, buckets: int) -> np.ndarray:
    x = np.zeros(len(w1), np.uint64)
    for w in (w1, w2, w3):
        x = (x ^ w.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(buckets)).astype(np.int32)


def _grams(texts: DataFrame, folder: str, stats: dict) -> DataFrame:
    """w1, w2, w3, c of the n-grams that occur often enough; w3 is 0 for pairs.

    A task sums up its pieces and deals the n-grams to buckets by their hash; a bucket's part of a piece is one row.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * max(1, -(-2 * stats["n"] // (parts * BUCKET)))

    def count(batches: Batches) -> Batches:
        vocabulary, hashes = Vocabulary(folder, stats), Hashes()
        held: list[np.ndarray] = []
        size = 0

        def out():
            h = np.concatenate(held)
            for s in range(0, len(h), PIECE):
                for *words_, c in _ngrams(h[s : s + PIECE + 2], PIECE, vocabulary):
                    bucket = _bucket(*words_, buckets)
                    order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
                    columns, bucket = [x[order] for x in (*words_, c)], bucket[order]
                    ends = np.flatnonzero(np.diff(bucket, append=-1)) + 1
                    rows = [(int(bucket[a]), int(b - a), *_packed(tuple(x[a:b] for x in columns))) for a, b in zip([0, *ends[:-1]], ends, strict=True)] if len(bucket) else []
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows) if rows else [()] * 4, (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["bucket", "n", "width", "data"])

        for b in batches:
            for t in texts_of(b):
                held.append(hashes.of(words(t)))
                size += len(held[-1])
                if size >= PIECE:
                    yield from out()
                    held.clear()
                    size = 0
        if held:
            yield from out()

    def add(batches: Batches) -> Batches:
        now, held = None, []

        def out():
            w1, w2, w3, c = np.concatenate(held, axis=1)
            order, new = _sorted(_sorted(w1, w2, True), w3)
            first = np.flatnonzero(new)
            c = np.add.reduceat(c[order], first)
            fine = c >= stats["least"]
            cols = [x[order[first[fine]]] for x in (w1, w2, w3)] + [c[fine]]
            for i in range(0, len(cols[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in cols], names=["w1", "w2", "w3", "c"])

        for b in batches:
            for bucket, n, width, data in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if held and bucket != now:
                    yield from out()
                    held.clear()
                now = bucket
                held.append(_unpacked(width, n, data))
        if held:
            yield from out()

    dealt = texts.mapInArrow(count, "bucket int, n int, width int, data binary").repartitionById(parts, F.col("bucket") % parts)
    return dealt.sortWithinPartitions("bucket").mapInArrow(add, "w1 long, w2 long, w3 long, c long")


def _shards(n: int) -> int:
    return max(SHARDS, 1 << max(0, (-(-n // SHARD) - 1).bit_length()))


def _write(rows: DataFrame, folder: str, name: str, make) -> DataFrame:
    """rows: shard first, then columns of numbers, shards in order. make(shard, *columns): name and bytes of its file. Gives the manifest."""

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        now, held = None, []

        def put():
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            name, data = make(now, *columns)
            put_file(folder, name, data, attempt)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(data)], pa.int64()), pa.array([now], pa.int64()), pa.array([len(columns[0])], pa.int64())], names=["file", "bytes", "shard", "entries"])

        for b in batches:
            shard, *columns = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for at in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
                if len(at):
                    if held and shard[at[0]] != now:
                        yield put()
                        held = []
                    now = int(shard[at[0]])
                    held.append([x[at] for x in columns])
        if held:
            yield put()

    kind = "file string, bytes long, shard long, entries long"
    rows.mapInArrow(run, kind).write.parquet(f"{folder}/manifest-{name}")
    return rows.sparkSession.read.schema(kind).parquet(f"{folder}/manifest-{name}")


def _vocabulary_file(bits: int):
    def make(shard: int, h: np.ndarray, c: np.ndarray) -> tuple[str, bytes]:
        rest = (h.astype(np.int64).view(np.uint64) << np.uint64(bits)) >> np.uint64(bits)
        order = np.argsort(rest)
        parts, meta = EliasFano.build(rest[order]).parts("h")
        kind = np.uint32 if c.max() < 1 << 32 else np.uint64
        return f"words-{shard}.bin", pack(parts | {"c": c[order].astype(kind)}, meta)

    return make


def _trie_file(folder: str, stats: dict, shards: int):
    """File of the n-grams whose first word is shard modulo shards. Level 1 is the first words, by their number in the shard."""

    def make(shard: int, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, c: np.ndarray) -> tuple[str, bytes]:
        order = np.lexsort((w3, w2, w1))
        w1, w2, w3, c = (x[order] for x in (w1, w2, w3, c))
        pair = w3 == 0
        above = np.cumsum(pair) - 1  # a pair stands before its triples: it occurs as often as they do, or more
        first, back = np.unique(w1[pair], return_inverse=True)
        first_c = Vocabulary(folder, stats).counts(first)[back]
        parts: dict[str, np.ndarray] = {}
        meta: dict = {}
        levels = (
            (2, stats["v"] // shards + 1, w1[pair] // shards, w2[pair], c[pair], first_c),
            (3, int(pair.sum()), above[~pair], w3[~pair], c[~pair], c[pair][above[~pair]]),
        )
        for n, contexts, at, word, count, context_c in levels:
            begin = np.searchsorted(at, np.arange(contexts + 1))
            q = quantise(np.maximum(count - DISCOUNT, 0) / np.maximum(context_c, 1))
            rest = quantise(np.maximum(1 - np.bincount(at, CODE[q], minlength=contexts), 1e-7))
            # Monotone words: each range goes on from where the one before ended.
            ends = np.zeros(contexts + 1, np.int64)
            some = np.diff(begin) > 0
            ends[1:] = np.cumsum(np.where(some, word[np.maximum(begin[1:] - 1, 0)] if len(word) else 0, 0))
            for name, values in ((f"p{n}", begin), (f"w{n}", word + ends[at])):
                p, m = EliasFano.build(values).parts(name)
                parts |= p
                meta |= m
            parts |= {f"q{n}": q, f"r{n}": rest}
        return f"grams-{shard}.bin", pack(parts, meta)

    return make


@lru_cache(maxsize=4096)
def _open(folder: str, name: str):
    fs, at = files_at(folder)
    from pyarrow.fs import FileType

    if fs.get_file_info(f"{at}/{name}").type == FileType.NotFound:
        return None
    arrays, meta = unpack(memoryview(map_file(folder, name)))
    return arrays, {k: EliasFano.load(arrays, meta, k) for k in meta}


class Model:
    """Look-ups in the mapped files."""

    def __init__(self, folder: str, stats: dict):
        self.folder, self.s, self.vocabulary = folder, stats, Vocabulary(folder, stats)

    def _files(self, first: np.ndarray):
        shard = first % self.s["shards"]
        order = np.argsort(shard, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(at) and (found := _open(self.folder, f"grams-{shard[at[0]]}.bin")):
                yield at, *found

    def _pairs(self, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places of the pairs in their shards, q(bc), rest(b); -1, 0 and 1 where the model has none. b must be over 0."""
        place, q, r = np.full(len(b), -1, np.int64), np.zeros(len(b)), np.ones(len(b))
        for at, arrays, ef in self._files(b):
            context = b[at] // self.s["shards"]
            place[at] = i = self._child(ef, 2, context, c[at])
            q[at[i >= 0]] = CODE[arrays["q2"][i[i >= 0]]]
            r[at] = CODE[arrays["r2"][context]]
        return place, q, r

    def _triples(self, a: np.ndarray, place: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """q(abc), rest(ab) of pairs ab at known places."""
        q, r = np.zeros(len(a)), np.ones(len(a))
        for at, arrays, ef in self._files(a):
            i = self._child(ef, 3, place[at], c[at])
            q[at[i >= 0]] = CODE[arrays["q3"][i[i >= 0]]]
            r[at] = CODE[arrays["r3"][place[at]]]
        return q, r

    def _child(self, ef: dict[str, EliasFano], n: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Index of a context's child: the successor of the word, relative to where the range before ended."""
        p = ef[f"p{n}"].access(np.concatenate((context, context + 1))).astype(np.int64)
        begin, end = p[: len(context)], p[len(context) :]
        base = np.zeros(len(context), np.uint64)
        later = np.flatnonzero((begin > 0) & (begin < end))
        base[later] = ef[f"w{n}"].access(begin[later] - 1)
        out = np.full(len(context), -1, np.int64)
        some = np.flatnonzero((word > 0) & (begin < end))
        out[some] = ef[f"w{n}"].find(word[some].astype(np.uint64) + base[some], begin[some], end[some])
        return out

    def score(self, docs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base score, score of documents given as hashes of their tokens."""
        n, v, d = self.s["n"], self.s["v"], self.s["d"]
        lengths = np.array([len(x) for x in docs])
        begin = np.cumsum(lengths) - lengths
        h = np.concatenate(docs)
        distinct, inverse = np.unique(h, return_inverse=True)
        ids, count = self.vocabulary.find(distinct)
        base = np.log10((count + 1) / (n + v + 1))
        unknown = d * v / n if n else 1.0
        p1 = np.where(count > 0, (count - d) / max(n, 1), unknown)
        ids[count < self.s["least"]] = 0  # these are in no n-gram
        p, word = p1[inverse], ids[inverse]
        later = np.ones(len(h), bool)
        later[begin] = False
        at = np.flatnonzero(later[1:] & (word[:-1] > 0)) + 1
        if len(at):
            bits = len(distinct).bit_length()
            mask = (1 << bits) - 1
            key, back = np.unique(inverse[at - 1] << bits | inverse[at], return_inverse=True)
            b = ids[key >> bits]
            place, q, r = self._pairs(b, ids[key & mask])
            p[at] = q[back] + r[back] * p[at]
            pair = np.full(len(h), -1, np.int64)  # number of the pair that ends at a token
            pair[at] = back
            at = at[pair[at - 1] >= 0]
            at = at[place[pair[at - 1]] >= 0]
            key, back = np.unique(pair[at - 1] << bits | inverse[at], return_inverse=True)
            q, r = self._triples(b[key >> bits], place[key >> bits], ids[key & mask])
            p[at] = q[back] + r[back] * p[at]
        total = lambda x: np.add.reduceat(x, begin)
        return lengths, total((count > 0)[inverse].astype(np.int64)), total(base[inverse]), total(np.log10(p))


def learn(docs: DataFrame, train: Column | None, text_col: str = "text", least: int = LEAST) -> dict:
    """Counts the training rows and writes the model's files. Gives what a Model needs: folder and numbers.

    least: how often an n-gram of two or three words must occur to be kept; 1 keeps all of them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs if train is None else docs.where(train)
    texts = rows.select(F.coalesce(text_col, F.lit("")).alias("text"))
    counts = written(_counts(texts), "tokens")
    n, v, n1, n2 = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    folder = new_folder(spark, "lm")
    bits = _shards(v).bit_length() - 1
    shard = F.shiftrightunsigned(F.col("h"), 64 - bits).cast("int").alias("shard")
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << bits)
    made = _write(counts.select(shard, "h", "c").repartition(parts, "shard").sortWithinPartitions("shard", "h"), folder, "words", _vocabulary_file(bits))
    entries = np.zeros(1 << bits, np.int64)
    for r in made.select("shard", "entries").collect():  # a row for about SHARD / 2 words or more, or SHARDS rows
        entries[r["shard"]] = r["entries"]
    stats = {"n": n, "v": v, "bits": bits, "starts": (np.cumsum(entries) - entries).tolist(), "least": least}
    grams = written(_grams(texts, folder, stats), "grams")
    shards = _shards(grams.count())
    keyed = grams.select((F.col("w1") % shards).cast("int").alias("shard"), "w1", "w2", "w3", "c")
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    _write(keyed.repartition(parts, "shard").sortWithinPartitions("shard"), folder, "grams", _trie_file(folder, stats, shards))
    d = min(0.9, max(0.1, n1 / (n1 + 2 * n2) if n1 else 0.1))
    return {"folder": folder, "stats": stats | {"d": d, "shards": shards}}


def scores(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score of every row, without a shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        m = Model(*held.value.values())
        hashes = Hashes()
        ids: list[pa.Array] = []
        held_: list[np.ndarray] = []
        size = 0

        def out():
            n, known, base, score = m.score(held_)
            train = np.full(len(n), m.s["n"], np.int64)
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *(pa.array(x) for x in (n.astype(np.int64), known, train, base, score))], names=[id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for b in batches:
            new = [hashes.of(words(t)) for t in texts_of(b)]
            if new:
                ids.append(b.column(0))
                held_ += new
                size += sum(map(len, new))
            if size >= SCORED:
                yield out()
                ids, held_, size = [], [], 0
        if held_:
            yield out()

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col].alias("text")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
