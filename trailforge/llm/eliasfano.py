"""Elias-Fano coded monotone sequences over mapped bytes; all queries work on arrays of arguments at once."""

from __future__ import annotations

import json

import numpy as np

_U1 = np.uint64(1)
# Bytes of a word: the lowest bits, the highest bits; the place of each byte's k-th one.
_LOW, _TOP = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_PLACE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.uint8)


def pack(parts: dict[str, np.ndarray], meta: dict) -> bytes:
    """Named arrays and a small head as one file; arrays begin at multiples of 8."""
    head: dict = {"meta": meta, "at": {}}
    body, at = [], 0
    for name, a in parts.items():
        raw = np.ascontiguousarray(a).tobytes()
        head["at"][name] = (at, len(a), a.dtype.str)
        raw += b"\0" * (-len(raw) % 8)
        body.append(raw)
        at += len(raw)
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(body)


def unpack(raw) -> tuple[dict[str, np.ndarray], dict]:
    n = int.from_bytes(raw[:8], "little")
    head = json.loads(bytes(raw[8 : 8 + n]))
    return {k: np.frombuffer(raw, np.dtype(kind), size, 8 + n + at) for k, (at, size, kind) in head["at"].items()}, head["meta"]


class EliasFano:
    """A monotone sequence of n values up to u: low bits packed, high bits in unary, a sum of ones for each word."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.l, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.zeros = np.arange(len(ones)) * 64 - ones

    @staticmethod
    def build(values: np.ndarray) -> "EliasFano":
        v = values.astype(np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        bits = np.empty((n, low_bits), np.uint8)
        for i in range(low_bits):
            bits[:, i] = (v >> np.uint64(i)) & _U1
        low = _words(bits.ravel())
        marks = np.zeros(n + (top >> low_bits) + 2, np.uint8)
        marks[(v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        high = _words(marks)
        sums = np.cumsum(np.bitwise_count(high), dtype=np.int64)
        return EliasFano(n, low_bits, low, high, np.concatenate(([0], sums)))

    def parts(self, name: str) -> tuple[dict[str, np.ndarray], dict]:
        return {f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones}, {name: (self.n, self.l)}

    @staticmethod
    def load(arrays: dict[str, np.ndarray], meta: dict, name: str) -> "EliasFano":
        return EliasFano(*meta[name], *(arrays[f"{name}.{x}"] for x in ("low", "high", "ones")))

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.l)
        w, s = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        # A field may go over into the next word; a shift by 64 is taken in two steps.
        out = (self.low[w] >> s) | ((self.low[w + 1] << (np.uint64(63) - s)) << _U1)
        return out & np.uint64((1 << self.l) - 1)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero of the high bits."""
        before = self.ones if one else self.zeros
        w = np.searchsorted(before, k, "right") - 1
        left = (k - before[w]).astype(np.uint64)
        word = self.high[w] if one else ~self.high[w]
        x = word - ((word >> _U1) & np.uint64(0x5555555555555555))
        x = (x & np.uint64(0x3333333333333333)) + ((x >> np.uint64(2)) & np.uint64(0x3333333333333333))
        sums = ((x + (x >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _LOW  # ones up to each byte
        shift = np.bitwise_count(((left * _LOW | _TOP) - sums) & _TOP).astype(np.uint64) << np.uint64(3)
        left -= (sums << np.uint64(8)) >> shift & np.uint64(0xFF)
        return w * 64 + (shift + _PLACE[word >> shift & np.uint64(0xFF), left]).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        if not len(i):
            return np.zeros(0, np.uint64)
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.l)) | self.lows(i)

    def find(self, x: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Index of each x inside its range [begin, end), or -1: the successor's bucket by its high bits, then by halves."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        x = x.astype(np.uint64)
        h = (x >> np.uint64(self.l)).astype(np.int64)
        zeros = len(self.high) * 64 - self.n
        fine = np.flatnonzero(h < zeros)
        h, q = h[fine], x[fine]
        hi = self._select(h, False) - h
        lo = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - h + 1, 0)
        if begin is not None:
            lo, hi = np.maximum(lo, begin[fine]), np.minimum(hi, end[fine])
        want = q & np.uint64((1 << self.l) - 1)
        last = hi.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.lows(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        at = np.flatnonzero(lo < last)
        hit = at[self.lows(lo[at]) == want[at]]
        out[fine[hit]] = lo[hit]
        return out


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits, the least first, as words of 64; one spare word at the end."""
    raw = np.packbits(bits, bitorder="little")
    return np.append(raw, np.zeros(-len(raw) % 8 + 8, np.uint8)).view("<u8")
