"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets and star-shaped edges.

1. ``sketches`` hashes each document's distinct word shingles once, keeps the least hash of each of ``BINS`` bins,
   fills empty bins from random full ones (optimal densification) and folds rows of bins to band keys.
2. Documents with equal shingle sets (by 128 bits of hash over the whole set) are one class with a number of its own;
   only classes are compared from here on.
3. Each bucket gives star-shaped edges: from the member that shares most buckets with others (of a family of copies,
   the text the others come from) to each other member. Edges are confirmed on full sets.
4. A star misses a link between two members that the centre doesn't link. So where a bucket is left in more than one
   component, the next of its ``CENTRES`` best members are centres, too, for members of other components. Small buckets,
   as of a chain of texts each similar to the next, are done with that. Where a larger one is still in more than one
   component, ``_rest`` tests the pairs across components of its family (members joined by such buckets), on full
   sets, in blocks of bounded size, and gives links only.
5. Components come from star steps on the links; a document's component is the smallest id in it.

A bucket, centre, family or class with very many members is dealt to several parts of each join (``salted_join``); texts
without words aren't joined at all.

At a similarity of 0.8 the bands miss a pair with a probability of about 5e-8.

Defined results: null text, or text without words, has an empty set and is linked with nothing; fewer words than a
shingle are one shingle; a null id links with nothing, has a null component and counts as kept; repeated rows get the
same row each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailforge.llm.common import Batches, give_back, small_batches, texts_of, written
from trailforge.llm.graph import components
from trailforge.operators.skew import hot_keys, salted_join

BINS, ROWS = 128, 4
#: Members of a bucket that are its centres, one after the other.
CENTRES = 4
#: Shingles of one block of a family in ``_rest``; a task holds two blocks.
BLOCK_SHINGLES = 1 << 16

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_RNG = np.random.default_rng(20240229)
_WORD = _RNG.integers(0, 1 << 63, (64, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Places tried for each empty bin, in order.
_TRY = _RNG.integers(0, BINS, (BINS, 1024), dtype=np.int64)
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of lower-cased UTF-8 bytes."""
    b = np.frombuffer(raw, np.uint8)
    inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
    if not inside.any():
        return np.empty(0, np.uint64)
    step = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    lengths = ends - starts
    at = np.flatnonzero(inside)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first, lengths)
    v = _WORD[place & 63, b[at]]
    if (far := place >= 64).any():
        v[far] *= (place[far] >> 6).astype(np.uint64) * np.uint64(2) + np.uint64(3)
    return _mix(np.add.reduceat(v, first) + lengths.astype(np.uint64) * _M3)


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    w = word_hashes(text.encode("utf-8", "surrogatepass").translate(_LOWER))
    if not len(w):
        return w
    n = max(1, len(w) - size + 1)
    k = min(size, len(w))
    h = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        h = _mix(h * _M3 + w[i : i + n])
    return np.unique(h)


def signature(u: np.ndarray) -> np.ndarray:
    """Least hash of each bin; empty bins take that of a random full one."""
    at = np.searchsorted(u, _EDGES)
    full = np.append(at[1:], len(u)) > at
    out = u[np.minimum(at, len(u) - 1)]
    empty = np.flatnonzero(~full)
    if len(empty):
        tries = full[_TRY[empty]]
        first = tries.argmax(1)
        source = _TRY[empty, first]
        lost = ~tries[np.arange(len(empty)), first]
        source[lost] = np.flatnonzero(full)[empty[lost] % full.sum()]
        out[empty] = out[source]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(-1, ROWS)
    h = np.arange(1, len(rows) + 1, dtype=np.uint64) * _M3
    for i in range(ROWS):
        h = _mix(h * _M3 + rows[:, i])
    return h.view(np.int64)


def _key(u: np.ndarray) -> tuple[int, int]:
    """128 bits of hash of a whole set, as two longs."""
    h = xxhash.xxh3_128_intdigest(u.tobytes())
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def sketches(docs: DataFrame, size: int, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, n_shingles, k1, k2 (hash of the whole set; null where that is empty), bands, kept columns."""
    small_batches(docs.sparkSession)

    def run(batches: Batches) -> Batches:
        for b in batches:
            n, keys, bands = [], [], []
            for t in texts_of(b, "_text"):
                u = shingles(t, size)
                n.append(len(u))
                keys.append(_key(u) if len(u) else (None, None))
                bands.append(band_keys(signature(u)) if len(u) else [])
            k1, k2 = zip(*keys, strict=True) if keys else ((), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), *b.columns[2:]],
                names=["id", "n_shingles", "k1", "k2", "bands", *b.schema.names[2:]],
            )

    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("_text"), *(docs[c].alias(f"_keep_{c}") for c in keep))
    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[2:])
    return source.mapInArrow(run, f"id {source.schema[0].dataType.simpleString()}, n_shingles long, k1 long, k2 long, bands array<long>{kept}")


def _sets(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """node, hashes of the wanted classes' (id, node, k1, k2) full sets, each once."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            sets = [shingles(t, size) for t in texts_of(b)]
            k1, k2 = zip(*(_key(u) if len(u) else (None, None) for u in sets), strict=True) if sets else ((), ())
            own = [b.column(b.schema.get_field_index(k)) for k in ("node", "w1", "w2")]
            yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), *own, pa.array([u.view(np.int64) for u in sets], pa.list_(pa.int64()))], names=["k1", "k2", "node", "w1", "w2", "hashes"])

    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    want = wanted.select("id", "node", F.col("k1").alias("w1"), F.col("k2").alias("w2"))
    # An id may have several texts: only those of the class's set count.
    found = texts.join(want, "id").select("text", "node", "w1", "w2").mapInArrow(run, "k1 long, k2 long, node long, w1 long, w2 long, hashes array<long>")
    return found.where("k1 = w1 and k2 = w2").select("node", "hashes").dropDuplicates(["node"])


def links(docs: DataFrame, classes: DataFrame, size: int, per_cent: int, id_col: str, text_col: str) -> DataFrame:
    """a, b: links between classes (node, id, k1, k2, n_shingles, bands) that make the same components as all links."""
    members = classes.select("node", F.explode("bands").alias("key"))
    buckets = written(members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    total = buckets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    hot = hot_keys(buckets, ("key",), "size", total)
    members = written(salted_join(members, buckets, ("key",), hot, F.col("node")), "buckets")
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.desc("node"))
    first = members.join(score, "node").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= CENTRES)
    centres = written(first.select("key", F.col("node").alias("centre"), "rank"), "centres")
    starred = salted_join(members, centres.where("rank = 1"), ("key",), hot, F.col("node"))
    edges = written(starred.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "stars")
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    sets = written(_sets(docs, classes.join(ends, "node"), size, id_col, text_col), "sets")
    inner = components(confirmed(edges, sets, per_cent))

    def opened(rows: DataFrame, least: int) -> DataFrame:
        """node, key, comp of the buckets of rows (node, key) that have more members than ``least``, in more than one component."""
        at = written(rows.join(inner.withColumnRenamed("root", "comp"), "node", "left").select("node", "key", F.coalesce("comp", "node").alias("comp")), "members")
        keys = at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
        keys = written(keys.where((F.col("lo") != F.col("hi")) & (F.col("n") > least)).select("key", "n"), "open-buckets")
        hot = hot_keys(keys, ("key",), "n", keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        return salted_join(at, keys, ("key",), hot, F.col("node"))

    # The other centres of buckets that a star left in more than one component.
    still = written(opened(members.select("node", "key"), 2), "open-members")
    others = centres.where("rank > 1").join(inner.select(F.col("node").alias("centre"), F.col("root").alias("own")), "centre", "left")
    tried = salted_join(still, others.select("key", "centre", F.coalesce("own", "centre").alias("own")), ("key",), hot, F.col("node")).where("comp <> own")
    tried = written(tried.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), "stars")
    inner = components(inner.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(confirmed(tried, sets, per_cent)))
    # Of at most CENTRES + 1 members, every pair has one of the centres in it.
    left = opened(still.select("node", "key"), CENTRES + 1)
    family = written(salted_join(left, centres.where("rank = 1"), ("key",), hot, F.col("node")).where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "families")
    more = _rest(family, inner.withColumnRenamed("root", "comp"), sets, per_cent)
    # The components so far stand for their links.
    return inner.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)


def confirmed(edges: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Those of the edges (a, b) that full sets (node, hashes) bear out."""
    a, b = (sets.select(F.col("node").alias(x), F.col("hashes").alias(f"h{x}")) for x in "ab")
    sized = F.size("ha") + F.size("hb")
    # A centre may have very many edges: its set is copied to as many parts as they take.
    spokes = written(edges.groupBy("b").agg(F.count("*").alias("n")), "spokes")
    hot = hot_keys(spokes, ("b",), "n", spokes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    # 100 * common >= per_cent * union, where union = both sizes - common.
    joined = salted_join(edges.join(a, "a"), b, ("b",), hot, F.col("a")).where(F.least(F.size("ha"), F.size("hb")) * 100 >= F.greatest(F.size("ha"), F.size("hb")) * per_cent)
    both = joined.select("a", "b", sized.alias("both"), F.size(F.array_intersect("ha", "hb")).alias("common"))
    return written(both.where(F.col("common") * 100 >= (F.col("both") - F.col("common")) * per_cent).select("a", "b"), "links")


def _rest(edges: DataFrame, inner: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Links across the components (node, comp) of a family that no star could show."""
    family = components(edges).withColumnRenamed("root", "family")
    sizes = sets.select("node", F.size("hashes").alias("size"))
    at = family.join(inner, "node", "left").join(sizes, "node").select("node", "family", F.coalesce("comp", "node").alias("comp"), "size")
    by_family = at.groupBy("family").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.ceil(F.sum("size") / F.lit(BLOCK_SHINGLES)).cast("int").alias("m"))
    open_ = written(by_family.where("n > 2 and lo <> hi").select("family", "n", "m"), "open")
    hot = hot_keys(open_, ("family",), "n", open_.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    rows = salted_join(at.select("node", "family", "comp"), open_.select("family", "m"), ("family",), hot, F.col("node")).join(sets, "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("m")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    rows = rows.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp", "hashes")

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(across(pdf, per_cent), columns=["a", "b"]).astype("int64")

    # Dealt by block, not by family: a large family's blocks go to many tasks.
    return rows.repartition("family", "i", "j").groupBy("family", "i", "j").applyInPandas(test, "a long, b long")


def across(pdf: pd.DataFrame, per_cent: int) -> list[tuple[int, int]]:
    """Links of a block (or between its two blocks) that join different components, without those that follow."""
    i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    node, own = pdf["node"].to_numpy(), pdf["own"].to_numpy()
    comp = dict(zip(node.tolist(), pdf["comp"].tolist(), strict=True))
    n = np.array([len(h) for h in pdf["hashes"]])
    who = np.repeat(np.arange(len(pdf)), n)
    _, shingle = np.unique(np.concatenate(list(pdf["hashes"])), return_inverse=True)
    order = np.lexsort((who, shingle))
    who, shingle = who[order], shingle[order]
    keep = np.bincount(shingle)[shingle] > 1  # a hash of one member alone is common to no pair
    who, shingle = who[keep], shingle[keep]
    shingle = np.unique(shingle, return_inverse=True)[1] if len(shingle) else shingle
    left = np.flatnonzero(own == i)
    right = np.flatnonzero(own == j)
    place = np.full(len(pdf), -1)
    place[right] = np.arange(len(right))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out: list[tuple[int, int]] = []
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        common = np.zeros((len(rows), len(right)), np.float32)
        total = int(shingle.max()) + 1 if len(shingle) else 0
        for s in range(0, total, 4096):
            a, b = np.searchsorted(shingle, (s, s + 4096))
            w, c = who[a:b], shingle[a:b] - s
            x = np.zeros((len(pdf), 4096), np.float32)
            x[w, c] = 1
            common += x[rows] @ x[right].T
        least = np.minimum(n[rows][:, None], n[right][None, :])
        both = n[rows][:, None] + n[right][None, :]
        hit = (common * 100 >= (both - common) * per_cent) & (least > 0)
        for p, q in zip(*np.nonzero(hit), strict=True):
            u, v = int(node[rows[p]]), int(node[right[q]])
            if u == v or root(comp[u]) == root(comp[v]):
                continue
            parent[root(comp[u])] = root(comp[v])
            out.append((u, v))
    return out


def near_duplicates(docs: DataFrame, size: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, n_shingles, component_id, kept, component (the component's own number, any; null where a row is in none), kept columns of every row."""
    sketch = written(sketches(docs, size, id_col, text_col, keep), "sketches")
    give_back(docs.sparkSession)
    rows = sketch.where("k1 is not null and id is not null")
    by_set = rows.groupBy("k1", "k2").agg(F.min(F.struct("id", "n_shingles", "bands")).alias("c"), F.count("*").alias("n"))
    # Numbers that differ for different sets; fixed by being written.
    classes = written(by_set.select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "n", "c.id", "c.n_shingles", "c.bands"), "classes")
    joined = written(components(links(docs, classes, size, per_cent, id_col, text_col)), "components")
    ids = classes.select("node", "k1", "k2", "id").join(joined, "node", "left").select("k1", "k2", "id", F.coalesce("root", "node").alias("root"))
    least = ids.groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    n_classes, n_rows = classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = salted_join(ids, least.select("root", "component_id"), ("root",), hot_keys(least, ("root",), "n", n_classes), F.col("id")).select("k1", "k2", "component_id", F.col("root").alias("component"))
    # Rows without a set or an id aren't joined.
    known = salted_join(rows.drop("bands"), found, ("k1", "k2"), hot_keys(classes, ("k1", "k2"), "n", n_rows), F.col("id"))
    alone = sketch.where("k1 is null or id is null").drop("bands").withColumns({"component_id": F.col("id"), "component": F.lit(None).cast("long")})
    out = known.unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", kept.alias("kept"), "component", *(F.col(f"_keep_{c}").alias(c) for c in keep))
