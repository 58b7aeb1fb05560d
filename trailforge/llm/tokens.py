"""Token counts of whole texts, with overlap resynchronisation for huge documents.

``PreTokens`` finds the pre-tokens (the pieces inside which BPE merges happen) of ordinary text itself and asks the
tokenizers library for each distinct piece once; anything outside the range of characters where that is known to be
equal goes through the library whole. Documents longer than ``chunk_chars`` are encoded in overlapping chunks with
offsets. Two chunks are spliced at a boundary between pre-tokens that both of them have: the scan for pre-tokens has no
memory before the place where a pre-token starts, so from a common start on, the later chunk is right up to its own
unstable end. A boundary counts as stable only if the chunk goes on for at least ``GUARD`` characters after it. Where
no common stable boundary lies in the overlap, the overlap is doubled until one does; where none lies in the whole
chunk, the chunk becomes ``GROW`` times as long, so that a run without boundaries is read little more than once.

Which expression splits a text is read from the file's own normalizer and pre-tokenizer; with others than the two known
ones, every text goes through the library whole.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows give one row each; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trailforge.llm.common import Batches, small_batches, texts_of

#: Longest text encoded in one go; longer ones are cut into overlapping chunks.
CHUNK_CHARS = 16384
#: Characters of the first overlap.
OVERLAP_CHARS = 256
#: A pre-token's end looks at most one character ahead; a boundary needs this many more characters in its chunk.
GUARD = 4
#: Factor by which a chunk without a boundary grows.
GROW = 4
#: Distinct pieces and their characters kept in a worker's memory; when it is full the memory starts anew.
CACHE_PIECES, CACHE_CHARS = 700_000, 32_000_000

# Letters and numbers among the characters the fast path accepts: categories L and N up to U+024F.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Anything else: characters whose class, case or normal form may differ between Python and the library.
_UNSURE = re.compile("[^\t\n\r -~\xa1-įı-ɏ]")
#: The same where texts are lower-cased: also letters whose lower-case form isn't among the accepted ones (as U+0181, U+023A).
_UNSURE_LOWER = re.compile("[^" + re.escape("".join(c for c in map(chr, range(0x250)) if not _UNSURE.search(c + c.lower()))) + "]")
#: The two settings whose splits are known, as the files state them (normalizer, pre_tokenizer).
_BYTE_SETTING = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
_WORD_SETTING = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
_BYTE_SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
_WORD_SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")


def splitter(path: str) -> tuple[re.Pattern | None, bool]:
    """The expression that splits ordinary text as the file's own settings do, and whether text is lower-cased first."""
    with open(path, encoding="utf-8") as f:
        setting = json.load(f)
    now = (setting.get("normalizer"), setting.get("pre_tokenizer"))
    plain = setting["model"].get("type") == "BPE" and not setting["model"].get("dropout")
    if not plain or any(t.get("normalized") or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in setting.get("added_tokens", [])):
        return None, False
    return (_BYTE_SPLIT, False) if now == _BYTE_SETTING else (_WORD_SPLIT, True) if now == _WORD_SETTING else (None, False)


def _byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = itertools.count(0x100)
    return [chr(b if b in own else next(rest)) for b in range(256)]


_BYTE_CHAR = _byte_chars()


class PreTokens:
    """Encoder of one tokenizers file. ``ids`` gives little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.split, self.lower = splitter(path)
        self.unsure = _UNSURE_LOWER if self.lower else _UNSURE
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.merge = self.tok.model.tokenize
        self.cache: dict[str, bytes] = {}
        self.chars = 0

    def plain(self, text: str) -> bool:
        """Whether our own split into pre-tokens is known to equal the library's."""
        return self.split is not None and not self.unsure.search(text) and not any(s in text for s in self.special)

    def pieces(self, text: str) -> list[str]:
        return self.split.findall(text.lower() if self.lower else text)

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(new) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self.cache.clear()
            self.chars = 0
            new = list(pieces)
        self.chars += sum(map(len, new))
        for p in new:  # a piece is one pre-token, so the model alone gives its ids
            self.cache[p] = struct.pack(f"<{len(t := self.merge(''.join(map(_BYTE_CHAR.__getitem__, p.encode()))))}I", *[x.id for x in t])

    def ids_plain(self, text: str) -> bytes:
        pieces, get = self.pieces(text), self.cache.get
        out = list(map(get, pieces))
        if None in out:
            self.learn(set(pieces))
            out = list(map(self.cache.get, pieces))
        return b"".join(out)

    def ids_whole(self, text: str) -> bytes:
        if self.plain(text):
            return self.ids_plain(text)
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def spans(self, text: str) -> tuple[np.ndarray, list[bytes]]:
        """Start of each pre-token (first of all 0, last of all the length) and the ids of each."""
        if self.plain(text) and len(text.lower()) == len(text):
            low = text.lower() if self.lower else text
            found = [(m.start(), m[0]) for m in self.split.finditer(low)]
            self.learn({p for _, p in found})
            return np.array([s for s, _ in found] + [len(text)]), [self.cache[p] for _, p in found]
        e = self.tok.encode(text, add_special_tokens=False)
        starts, parts, last = [], [], object()
        for i, w, (s, _) in zip(e.ids, e.word_ids, e.offsets, strict=True):
            if w != last or w is None:
                starts.append(s)
                parts.append([])
                last = w
            parts[-1].append(i)
        return np.array([*starts, len(text)]), [np.array(p, "<u4").tobytes() for p in parts]

    def ids(self, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> bytes:
        """Ids of a whole text; those longer than ``chunk`` by overlapping chunks."""
        if len(text) <= chunk or self.split is None:
            return self.ids_whole(text)
        return b"".join(self.resynchronised(text, chunk, overlap))

    def resynchronised(self, text: str, chunk: int, overlap: int):
        """Splice the chunks' ids. Strings of added tokens are cut out first, as the library does."""
        if self.special and any(s in text for s in self.special):
            for part in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text):
                if part:
                    yield self.ids_whole(part) if part in self.special or len(part) <= chunk else b"".join(self.resynchronised(part, chunk, overlap))
            return
        begin, end = 0, chunk
        starts, parts = self.spans(text[:end])
        k = 0  # first pre-token of the chunk that isn't given out
        while end < len(text):
            at = starts[:-1] + begin
            width = overlap
            while True:
                if width >= end - begin:  # no common boundary inside the whole chunk: take a longer one from its start
                    begin = int(at[k])  # a proven boundary
                    end = min(len(text), begin + GROW * max(chunk, end - begin))
                    starts, parts = self.spans(text[begin:end])
                    k = 0
                    break
                stable = at[k:][(at[k:] <= end - GUARD) & (at[k:] >= end - width + GUARD)]
                if not len(stable):
                    width *= 2
                    continue
                to = min(len(text), end - width + max(chunk, 2 * width))
                nxt, nparts = self.spans(text[end - width : to])
                common = np.intersect1d(stable, nxt[:-1] + end - width)
                # A chunk may begin inside a pre-token, and its first boundaries be artefacts of the cut: only those
                # that the earlier chunk has too, and that are stable there, are taken.
                if len(common):
                    cut = common[-1]
                    j = int(np.searchsorted(at, cut))
                    yield from parts[k:j]
                    begin, end = end - width, to
                    starts, parts, k = nxt, nparts, int(np.searchsorted(nxt[:-1] + begin, cut))
                    break
                width *= 2
        yield from parts[k:]


@lru_cache(maxsize=4)
def encoder(path: str) -> PreTokens:
    """One encoder for each worker process and file."""
    return PreTokens(path)


@lru_cache(maxsize=2)
def pieces_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def count(text: str, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of one whole text as the file's library gives them. Sentencepiece files are encoded whole."""
    if path.endswith(".model"):
        return len(pieces_model(path).encode(text))
    return len(encoder(path).ids(text, chunk, overlap)) // 4


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row. No shuffle; memory is one Arrow batch and the cache of pieces."""
    small_batches(docs.sparkSession)
    fields = docs.select(id_col).schema
    kind = fields[0].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        for b in batches:
            texts = texts_of(b)
            n = [count(t, tokenizer, chunk_chars, overlap_chars) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(docs[id_col], docs[text_col].alias("text")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
