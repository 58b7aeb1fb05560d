"""Nearest neighbours by randomly rotated one-bit codes with error bounds and exact reranking.

A vector's residual to the centre is filled up with zeros to ``EXPAND`` times its length and rotated by a random orthogonal
matrix; its code is the signs of the rotated coordinates, one bit each, packed in words. With the residual's length and
the code's own alignment with it, two scalars, the code gives an unbiased estimate of the inner product with a query and a
bound on its error. A query's rotated residual is rounded to ``PLANES`` bits, so an estimate is a sum of counted bits of
packed words (code and plane); the rounding's own error is part of the bound.

In each block a query first measures the vectors of the least estimates exactly, which gives a k-th distance; then all
vectors whose lower bound isn't beyond it are measured exactly in double precision, and the others dropped. ``EPSILON``
widens the bound: the wider, the more are reranked and the surer the result.

The index (a row for each block of at most ``VECTOR_BLOCK`` vectors) is written to the shared folder and holds every row,
vectors in the precision they came in. Queries are broadcast in rounds of at most ``ROUND_BYTES`` and compared in blocks of
``QUERY_BLOCK``. A task scans its part of the index once a round and gives each query's k best; no pairs are shuffled, and
the last ranking is cut to k rows of each query before it is.

Defined results: null vectors, zero vectors, vectors with null or non-finite components, and vectors of another length
than the most frequent one take no part, neither do null ids; ties go to the smaller id; repeated rows (an id twice)
are candidates each, but never for their own id, and of a repeated query the least vector asks; a distance beyond the range
of doubles is infinite and ranks last; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailforge.llm.common import Batches, written

QUERY_BLOCK = 64
VECTOR_BLOCK = 8192
#: Most bytes of query vectors broadcast in one round.
ROUND_BYTES = 64_000_000
EPSILON = 1.9
#: Bits of a code for each component of a vector; bits to which a query's components are rounded.
EXPAND, PLANES = 4, 4
#: Vectors of the least estimates measured first, as a multiple of k.
FIRST = 4


def rotation(dim: int, seed: int = 11, expand: int = EXPAND) -> np.ndarray:
    """The first dim columns of a random orthogonal matrix, whose size is a multiple of 64: residuals end in zeros."""
    size = -(-dim * expand // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """One-bit codes of a block of vectors about a centre."""

    def __init__(self, bits: np.ndarray, norm: np.ndarray, align: np.ndarray):
        self.bits, self.norm, self.align = bits, norm, align  # bits: vectors by words
        self.ones = np.bitwise_count(bits).sum(1, dtype=np.int64)

    @staticmethod
    def of(x: np.ndarray, centre: np.ndarray, rot: np.ndarray) -> "Codes":
        residual = (x - centre) @ rot.T
        norm = np.linalg.norm(residual, axis=1)
        # Inner product of the unit residual with its code, which is +-1 / sqrt(bits).
        align = np.abs(residual).sum(1) / np.sqrt(len(rot)) / np.where(norm > 0, norm, 1)
        align[norm == 0] = 1.0
        return Codes(np.packbits(residual >= 0, axis=1, bitorder="little").view("<u8"), norm, align)

    def estimates(self, q: np.ndarray, centre: np.ndarray, rot: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
        """Estimates and lower bounds of squared distances, queries by vectors."""
        size = len(rot)
        r = (q - centre) @ rot.T
        length = np.linalg.norm(r, axis=1)
        unit = r / np.where(length > 0, length, 1)[:, None]
        low = unit.min(1)
        step = np.maximum((unit.max(1) - low) / ((1 << PLANES) - 1), 1e-12)
        level = np.rint((unit - low[:, None]) / step[:, None]).astype(np.uint8)
        counted = np.zeros((len(q), len(self.norm)), np.int32)
        for p in range(PLANES):
            plane = np.packbits(level >> p & 1, axis=1, bitorder="little").view("<u8")
            for w in range(size // 64):
                counted += np.bitwise_count(self.bits[:, w][None, :] & plane[:, w][:, None]).astype(np.int32) << p
        dot = (2 * (low[:, None] * self.ones[None, :] + step[:, None] * counted) - unit.sum(1)[:, None]) / np.sqrt(size)
        own = np.maximum(0, 1 - self.align**2) / max(1, size - 1)
        error = epsilon * np.sqrt(own[None, :] + (step**2 / 12)[:, None]) / self.align
        base = self.norm[None, :] ** 2 + (length**2)[:, None]
        scale = 2 * length[:, None] * self.norm[None, :]
        cosine = dot / self.align
        return base - scale * cosine, base - scale * (cosine + error)


def _arrays(b: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return b.column(0).to_numpy(zero_copy_only=False), b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def index(vectors: DataFrame, centre: np.ndarray, rot: np.ndarray, kind: str = "<f8") -> DataFrame:
    """One row for each block of vectors: ids, vectors (as kind), bits, and the two scalars of each. Every row (id, v) is in it."""
    dim = len(centre)

    def run(batches: Batches) -> Batches:
        def block(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            c = Codes.of(x, centre, rot)
            parts = (ids.astype("<i8"), x.astype(kind), c.bits, c.norm, c.align)
            return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["ids", "v", "bits", "norm", "align"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            held.append(_arrays(b, dim))
            while sum(len(i) for i, _ in held) >= VECTOR_BLOCK:
                ids, x = np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])
                yield block(ids[:VECTOR_BLOCK], x[:VECTOR_BLOCK])
                held = [(ids[VECTOR_BLOCK:], x[VECTOR_BLOCK:])]
        if sum(len(i) for i, _ in held):
            yield block(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]))

    return vectors.mapInArrow(run, "ids binary, v binary, bits binary, norm binary, align binary")


class Best:
    """The k nearest found so far of each query."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.d = np.full((len(ids), k), np.inf)
        self.at = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, codes: Codes, ids: np.ndarray, x: np.ndarray, centre: np.ndarray, rot: np.ndarray, epsilon: float) -> int:
        """Gives the number of exact distances taken."""
        taken = 0
        for s in range(0, len(self.ids), QUERY_BLOCK):
            about, low = codes.estimates(self.q[s : s + QUERY_BLOCK], centre, rot, epsilon)
            for i in range(len(low)):
                n = s + i
                lo = low[i]
                own = ids == self.ids[n]
                lo[own] = about[i, own] = np.inf
                first = np.arange(len(ids)) if len(ids) <= FIRST * self.k else np.argpartition(about[i], FIRST * self.k)[: FIRST * self.k]
                done = first[~own[first]]
                self._measured(n, ids[done], x[done])
                # Not "at most": bounds that overflowed are no bounds.
                more = ~(lo > self.d[n, -1] ** 2 * (1 + 1e-5) + 1e-9) & ~own
                more[done] = False
                more = np.flatnonzero(more)
                self._measured(n, ids[more], x[more])
                taken += len(done) + len(more)
        return taken

    def _measured(self, n: int, ids: np.ndarray, x: np.ndarray) -> None:
        if len(ids):
            d = np.sqrt(((x.astype(np.float64) - self.q[n]) ** 2).sum(1))
            d, at = np.concatenate((self.d[n], d)), np.concatenate((self.at[n], ids))
            order = np.lexsort((at, d))[: self.k]
            self.d[n], self.at[n] = d[order], at[order]


def search(vectors: DataFrame, every: int = 100, k: int = 10, epsilon: float = EPSILON, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = own.where("id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    dims = fine.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = dims["dim"] if dims else 1
    fine = fine.where(F.size("v") == dim)
    mean = fine.select(*(F.avg(F.get("v", F.lit(i))).alias(f"m{i}") for i in range(dim))).first()
    centre, rot = np.array([x or 0.0 for x in mean]), rotation(dim)
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"
    blocks = written(index(fine, centre, rot, kind), "codes")
    queries = fine.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    # Rounds of queries, each of a bounded size, by hash of the id; the usual case is one.
    rounds = max(1, -(-queries.count() * 8 * dim // ROUND_BYTES))
    found = None
    for n in range(rounds):
        rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == n).orderBy("id").collect()
        held = spark.sparkContext.broadcast((np.array([r["id"] for r in rows], np.int64), np.array([r["v"] for r in rows], np.float64).reshape(-1, dim)))
        got = blocks.mapInArrow(_scan(held, centre, rot, k, epsilon, kind), "query_id long, vec_id long, d double")
        found = got if found is None else found.unionByName(got)
    nearest = Window.partitionBy("query_id").orderBy("d", "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("d").alias("score"))


def _scan(held, centre: np.ndarray, rot: np.ndarray, k: int, epsilon: float, kind: str):
    dim = len(centre)

    def run(batches: Batches) -> Batches:
        best = Best(*held.value, k)
        for b in batches:
            for ids, v, bits, norm, align in zip(*(c.to_pylist() for c in b.columns), strict=True):
                norm = np.frombuffer(norm)
                codes = Codes(np.frombuffer(bits, "<u8").reshape(len(norm), -1), norm, np.frombuffer(align))
                best.add(codes, np.frombuffer(ids, "<i8"), np.frombuffer(v, kind).reshape(-1, dim), centre, rot, epsilon)
        i, j = np.nonzero(best.at != np.iinfo(np.int64).max)
        yield pa.RecordBatch.from_arrays([pa.array(best.ids[i]), pa.array(best.at[i, j]), pa.array(best.d[i, j])], names=["query_id", "vec_id", "d"])

    return run
