"""Benchmark decontamination with one Aho-Corasick automaton over the normalised items.

Normalising keeps every byte's place: A-Z become a-z, every other ASCII character that isn't a letter or digit becomes a
space, bytes of non-ASCII characters stay. So an offset in the normalised text is the offset in the UTF-8 original.

The automaton holds each window of the items as a path of words. Words are numbered by a vocabulary that is looked up by
hash and compared byte by byte, nodes are numbered by level, and a node's child is found by binary search among sorted
(node, word) keys; failure links and links to the next shorter window are arrays. It is built once by a task, written to
the shared folder and mapped by all workers of a host: about ten nodes of 20 bytes a word of the items, and nothing of
it on a worker's heap but a bounded memory of words. Texts are scanned once, many at a time: where a pair of words is in
no window, the state is known without the words before, so the pieces between such places advance together.

A benchmark of more than ``MAX_ITEM_BYTES`` of text is dealt to several automata by hash of the text; each scans the words
of a batch in turn. Nothing of the benchmark is sent to the driver or broadcast.

Defined results: null text or a text without words has 0 words and no hit; items with null or wordless text have no
window; items that repeat, or that share an id, count as one id; items with a null item_id hit as others do and count as
one item together, but are left out of the ids; an empty benchmark hits nothing; repeated rows give one row each; an
empty table gives no rows; extra columns are ignored unless they are kept.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.llm.common import Batches, map_file, new_folder, put_file, small_batches, texts_of
from trailforge.llm.eliasfano import pack, unpack

#: Words of a window.
WINDOW = 10
#: Bytes of item text of one automaton, about; more items go to further automata.
MAX_ITEM_BYTES = 4_000_000
#: Words kept in a worker's memory for each automaton; when it is full the memory starts anew.
CACHE_WORDS = 250_000
#: Words scanned at once, about (a longer text is scanned alone).
SCANNED = 1 << 20

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))


def normal(text: str) -> bytes:
    """Same length as the text's UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL)


def _strings(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int64)
    return np.frombuffer(b"".join(values), np.uint8), ends


def build(items: dict[bytes, set[str | None]], size: int) -> bytes:
    """The automaton's file. items: normalised text and the ids that have it."""
    split = {t: t.split() for t in items}
    vocabulary = sorted({w for ws in split.values() for w in ws}, key=lambda w: (xxhash.xxh3_64_intdigest(w), w))
    number = {w: i + 1 for i, w in enumerate(vocabulary)}
    names = sorted({i for ids in items.values() for i in ids}, key=lambda i: (i is None, i or ""))
    place = {i: n for n, i in enumerate(names)}
    windows: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    for t in sorted(items):
        w = np.array([number[x] for x in split[t]], np.int64)
        if not len(w):
            continue
        rows = np.zeros((1, size), np.int64) if len(w) < size else np.lib.stride_tricks.sliding_window_view(w, size)
        if len(w) < size:
            rows[0, : len(w)] = w
        for i in items[t]:
            windows.append(rows)
            owner.append(np.full(len(rows), place[i], np.int64))
    rows = np.concatenate(windows) if windows else np.zeros((0, size), np.int64)
    own = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    base = len(vocabulary) + 1
    at = np.zeros(len(rows), np.int64)  # each window's node so far
    ends = np.zeros(len(rows), np.int64)
    keys: list[np.ndarray] = []
    starts = [1]  # first node of each level
    for d in range(size):
        on = np.flatnonzero(rows[:, d] > 0)
        found, back = np.unique(at[on] * base + rows[on, d], return_inverse=True)
        at[on] = ends[on] = starts[-1] + back
        keys.append(found)
        starts.append(starts[-1] + len(found))
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    n = len(key) + 1
    kind = np.int32 if n < 1 << 31 else np.int64
    fail, out, final = np.zeros(n, kind), np.zeros(n, kind), np.zeros(n, bool)
    final[ends] = True
    final[0] = False
    for d in range(1, size):  # nodes of two words and more
        own_nodes = np.arange(starts[d], starts[d + 1])
        parent, word = key[own_nodes - 1] // base, key[own_nodes - 1] % base
        fail[own_nodes] = _goto(key, base, fail, fail[parent].astype(np.int64), word)
        f = fail[own_nodes]
        out[own_nodes] = np.where(final[f], f, out[f])
    order = np.lexsort((own, ends))
    pair = np.stack((ends[order], own[order]), 1)
    pair = pair[np.append(True, (np.diff(pair, axis=0) != 0).any(1))] if len(pair) else pair
    node, first = np.unique(pair[:, 0], return_index=True)
    pairs = np.unique((rows[:, :-1] * base + rows[:, 1:])[(rows[:, :-1] > 0) & (rows[:, 1:] > 0)])
    blob, blob_at = _strings(vocabulary)
    ids, ids_at = _strings([(i or "").encode("utf-8", "surrogatepass") for i in names])
    arrays = {
        "hash": np.array([xxhash.xxh3_64_intdigest(w) for w in vocabulary], np.uint64), "words": blob, "words_at": blob_at,
        "key": key, "pairs": pairs, "fail": fail, "out": out, "final": final, "levels": np.array(starts, np.int64),
        "node": node, "node_at": np.append(first, len(pair)), "items": pair[:, 1].astype(np.int32), "ids": ids, "ids_at": ids_at,
    }
    return pack(arrays, {"base": base, "null": None in place})


def _child(key: np.ndarray, base: int, node: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Node of each node's child by a word, 0 without one."""
    want = node * base + word
    i = np.searchsorted(key, want)
    ok = (i < len(key)) & (word > 0)
    ok[ok] = key[i[ok]] == want[ok]
    return np.where(ok, i + 1, 0)


def _goto(key: np.ndarray, base: int, fail: np.ndarray, node: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The longest suffix of each node's path, followed by the word, that is a path too."""
    out = _child(key, base, node, word)
    open_ = np.flatnonzero((out == 0) & (node > 0))
    while len(open_):
        node = node.copy()
        node[open_] = fail[node[open_]]
        out[open_] = _child(key, base, node[open_], word[open_])
        open_ = open_[(out[open_] == 0) & (node[open_] > 0)]
    return out


class Automaton(dict):
    """A mapped automaton; as a dict, the numbers of the words seen so far (0 for words that no item has)."""

    def __init__(self, raw):
        super().__init__()
        self.a, meta = unpack(memoryview(raw))
        self.base, self.null = meta["base"], meta["null"]
        self.key, self.fail, self.out, self.final = (self.a[k] for k in ("key", "fail", "out", "final"))
        first = _child(self.key, self.base, np.zeros(self.base, np.int64), np.arange(self.base))
        self.first = first  # node of each word alone
        self.pairs = self.a["pairs"]
        # Most words of a text are no item's: a byte for each hash's low bits tells so without a search.
        self.mask = (1 << (16 * self.base).bit_length()) - 1
        marks = np.zeros(self.mask + 1, np.uint8)
        marks[self.a["hash"] & np.uint64(self.mask)] = 1
        self.maybe = marks.tobytes()

    def __missing__(self, word: bytes) -> int:
        h, found = xxhash.xxh3_64_intdigest(word), 0
        if not self.maybe[h & self.mask]:
            self[word] = 0
            return 0
        i = int(np.searchsorted(self.a["hash"], np.uint64(h)))
        while i < len(self.a["hash"]) and int(self.a["hash"][i]) == h:
            if self.a["words"][self.a["words_at"][i] : self.a["words_at"][i + 1]].tobytes() == word:
                found = i + 1
                break
            i += 1
        self[word] = found
        return found

    def states(self, s: np.ndarray) -> np.ndarray:
        """The automaton's state after each word (numbers; 0 between texts)."""
        state = self.first[s]
        want = s[:-1] * self.base + s[1:]
        maybe = np.flatnonzero((s[:-1] > 0) & (s[1:] > 0))
        i = np.searchsorted(self.pairs, want[maybe])
        hit = i < len(self.pairs)
        hit[hit] = self.pairs[i[hit]] == want[maybe[hit]]
        goes_on = np.zeros(len(s) + 1, bool)  # a pair of words that some window has ends here; elsewhere the state is the word's own
        goes_on[maybe[hit] + 1] = True
        begin = np.flatnonzero(goes_on[1:] & ~goes_on[:-1])
        length = np.flatnonzero(goes_on[:-1] & ~goes_on[1:]) - begin
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        now, t, left = state[begin], 0, len(begin)
        while left:
            t += 1
            left = int(np.searchsorted(-length, -t, "right"))
            if left:
                at = begin[:left] + t
                now = _goto(self.key, self.base, self.fail, now[:left], s[at])
                state[at] = now
        return state

    def scan(self, texts: list[list[bytes]]) -> tuple[np.ndarray, list[set[str | None]]]:
        """Whether each word is hit (texts follow each other, with a place between two), and the ids in each text."""
        if len(self) > CACHE_WORDS:
            self.clear()
        s = np.zeros(sum(map(len, texts)) + len(texts), np.int64)
        at, starts = 0, []
        for ws in texts:
            starts.append(at)
            s[at : at + len(ws)] = np.fromiter(map(self.__getitem__, ws), np.int64, len(ws))
            at += len(ws) + 1
        ids: list[set[str | None]] = [set() for _ in texts]
        cover = np.zeros(len(s) + 1, np.int64)
        state = self.states(s)
        place = np.flatnonzero(self.final[state] | (self.out[state] > 0))
        node = state[place]
        seen = []
        while len(place):
            fine = self.final[node]
            p, n = place[fine], node[fine]
            depth = np.searchsorted(self.a["levels"], n, "right")
            np.add.at(cover, p - depth + 1, 1)
            np.add.at(cover, p + 1, -1)
            seen.append(np.unique(np.stack((np.searchsorted(starts, p, "right") - 1, n)), axis=1))
            node = self.out[node].astype(np.int64)
            place, node = place[node > 0], node[node > 0]
        for text, n in np.concatenate(seen, axis=1).T.tolist() if seen else ():
            ids[text].update(self.items(n))
        return np.cumsum(cover[:-1]) > 0, ids

    def items(self, node: int) -> list[str | None]:
        i = int(np.searchsorted(self.a["node"], node))
        own = self.a["items"][self.a["node_at"][i] : self.a["node_at"][i + 1]].tolist()
        last = len(self.a["ids_at"]) - 2 if self.null else -1
        return [None if k == last else self.a["ids"][self.a["ids_at"][k] : self.a["ids_at"][k + 1]].tobytes().decode("utf-8", "surrogatepass") for k in own]


@lru_cache(maxsize=64)
def opened(folder: str, name: str) -> Automaton:
    """One for each worker and file; the file itself is mapped."""
    return Automaton(map_file(folder, name))


def automata(benchmark: DataFrame, size: int = WINDOW, max_item_bytes: int = MAX_ITEM_BYTES, item_col: str = "item_id", text_col: str = "text") -> tuple[str, list[str]]:
    """Builds the automata of a benchmark in tasks. Gives their folder and names."""
    spark = benchmark.sparkSession
    small_batches(spark)
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    shards = max(1, -(-total // max_item_bytes))
    folder = new_folder(spark, "automata")

    def make(batches: Batches) -> Batches:
        from pyspark import TaskContext

        items: dict[bytes, set[str | None]] = {}
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), texts_of(b, "t"), strict=True):
                if words := normal(t).split():
                    items.setdefault(b" ".join(words), set()).add(i)
        if items:
            task = TaskContext.get()
            name = f"items-{task.partitionId():05d}.bin"
            put_file(folder, name, build(items, size), task.taskAttemptId())
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    made = rows.repartitionById(shards, F.pmod(F.xxhash64("t"), F.lit(shards)).cast("int")).mapInArrow(make, "name string")
    return folder, sorted(r["name"] for r in made.collect())  # a name for each automaton


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_item_bytes: int = MAX_ITEM_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", keep: tuple[str, ...] = (), text_out: bool = False) -> DataFrame:
    """id, kept columns (and the text, with text_out), n_words, n_hit, n_items, items_sha256, contaminated, runs (hit runs of words), byte_spans (the same in the original's UTF-8 bytes), items."""
    small_batches(docs.sparkSession)
    folder, names = automata(benchmark, size, max_item_bytes, item_col)

    def run(batches: Batches) -> Batches:
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            texts = texts_of(b, "_text")
            for some in _groups(texts):
                words = [normal(t).split() for t in some]
                hit = np.zeros(sum(map(len, words)) + len(words), bool)
                ids: list[set[str | None]] = [set() for _ in some]
                for name in names:  # one, unless the benchmark is larger than the bound
                    more, found = opened(folder, name).scan(words)
                    hit |= more
                    for x, y in zip(ids, found, strict=True):
                        x |= y
                at = 0
                for text, ws, found in zip(some, words, ids, strict=True):
                    own = runs_of(hit[at : at + len(ws)])
                    at += len(ws) + 1
                    ordered = sorted(found - {None})
                    for col, v in zip(out, (len(ws), sum(e - s for s, e in own), len(found), hashlib.sha256(",".join(ordered).encode()).hexdigest(), bool(own), own, byte_spans(text, own), ordered), strict=True):
                        col.append(v)
            spans = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], *(pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), spans, spans, pa.list_(pa.string())), strict=True))],
                names=[*b.schema.names[1:], "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "runs", "byte_spans", "items"],
            )

    source = docs.select(F.col(text_col).alias("_text"), id_col, *([text_col] * text_out), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:])
    found = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, runs array<array<long>>, byte_spans array<array<long>>, items array<string>"
    return source.mapInArrow(run, f"{fields}, {found}")


def _groups(texts: list[str]):
    """Texts that are scanned at once: a word takes two characters at least."""
    some, size = [], 0
    for t in texts:
        if some and size + len(t) // 2 > SCANNED:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t) // 2
    if some:
        yield some


def runs_of(hit: np.ndarray) -> list[list[int]]:
    """Runs [from, to) of hit words."""
    if not hit.any():
        return []
    step = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    return np.stack((np.flatnonzero(step == 1), np.flatnonzero(step == -1)), 1).tolist()


def byte_spans(text: str, runs: list[list[int]]) -> list[list[int]]:
    """Places of the hit runs in the original's UTF-8 bytes: normalising moved nothing, so words are found at their places."""
    if not runs:
        return []
    at = [m.span() for m in re.finditer(rb"[^ ]+", normal(text))]
    return [[at[a][0], at[b - 1][1]] for a, b in runs]
