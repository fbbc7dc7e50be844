"""Byte-level BPE by monoid tree reduction: encode halves, join neighbours, decode up the tree.

An element is the encoding of one stretch of text. Joining two elements re-encodes a
window around their border and keeps the tokens outside it, once these provably
stay as they are:

* between two characters that no match of the pattern can hold together (a letter
  and a blank, a digit and a letter) every scan ends one match and begins the
  next, so text on one side never changes tokens on the other;
* inside one long match, a row of tokens is the encoding of its bytes exactly when
  each neighbouring pair is the encoding of its own bytes: the first merge across a
  border of the row would also be made in the pair alone.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import lists, per_batch, texts

LEAF_CHARS = 4096
LEAF_BYTES = 256
FIRST_WINDOW = 32

# Borders that no match crosses, whatever precedes or follows. An apostrophe may bind to a letter, a blank to
# anything, and the control characters are left out because engines disagree whether they are blanks.
_BORDER = regex.compile(
    r"(?<=\p{L})(?![\p{L}\x1c-\x1f\x85])(?=.)"
    r"|(?<=\p{N})(?![\p{N}\x1c-\x1f\x85])(?=.)"
    r"|(?<=[^\s\p{L}\p{N}'\x1c-\x1f\x85])(?=[ \t\n\r\p{L}\p{N}])"
    r"|(?<=')(?=[ \t\n\r\p{N}])",
    regex.DOTALL,
)


class TreeBpe:
    """Encoder and decoder over a rank file. Equal to encoding the whole text at once."""

    def __init__(self, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._pattern = regex.compile(pattern)
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self._bytes[rank] = piece
        self._lengths = np.array([len(b) for b in self._bytes], np.int64)
        self._leaf_chars, self._leaf_bytes = leaf_chars, leaf_bytes
        self._stays = lru_cache(1 << 16)(self._pair_stays)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self._leaf_chars:
            return self._plain(text)
        middle = len(text) // 2
        near = text[max(0, middle - self._leaf_chars) : middle + self._leaf_chars]
        if not _BORDER.search(near):
            begin, end = self._unbroken(text, middle)
            if end - begin == len(text):
                return self._run(text)
            parts = (self.encode(text[:begin]), self._run(text[begin:end]), self.encode(text[end:]))
            return np.concatenate(parts)
        return self._join(text, middle, self.encode(text[:middle]), self.encode(text[middle:]))

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self._leaf_chars:
            return b"".join([self._bytes[i] for i in ids.tolist()])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def _plain(self, text: str) -> np.ndarray:
        return self._bpe.encode_to_numpy(text, disallowed_special=())

    def _join(self, text: str, cut: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Grow a window around ``cut`` until it begins and ends at a border, and encode that anew."""
        width = FIRST_WINDOW
        while True:
            begin, end = max(0, cut - width), min(len(text), cut + width)
            # One more character on each side lets the borders at the window's own ends be seen.
            base = max(0, begin - 1)
            borders = [base + m.start() for m in _BORDER.finditer(text[base : end + 1])]
            low = max((b for b in borders if begin <= b <= cut), default=0 if begin == 0 else None)
            high = min((b for b in borders if cut <= b <= end), default=end if end == len(text) else None)
            if low is not None and high is not None:
                break
            width *= 2
        if low == high:
            return np.concatenate((left, right))
        kept = self._tokens_before(left, len(text[low:cut].encode()))
        dropped = self._tokens_within(right, len(text[cut:high].encode()))
        return np.concatenate((left[:kept], self._plain(text[low:high]), right[dropped:]))

    def _tokens_before(self, ids: np.ndarray, tail: int) -> int:
        return len(ids) - self._tokens_within(ids[::-1], tail)

    def _tokens_within(self, ids: np.ndarray, size: int) -> int:
        """How many tokens from the start hold exactly ``size`` bytes."""
        return int(np.searchsorted(np.cumsum(self._lengths[ids[:size]]), size)) + 1 if size else 0

    def _unbroken(self, text: str, at: int) -> tuple[int, int]:
        """The stretch around ``at`` that holds no border."""
        width = 2 * self._leaf_chars
        begin = end = None
        while begin is None or end is None:
            low, high = max(0, at - width), min(len(text), at + width)
            borders = [low + m.start() for m in _BORDER.finditer(text[low:high])]
            begin = max((b for b in borders if b <= at), default=0 if low == 0 else None)
            end = min((b for b in borders if b > at), default=len(text) if high == len(text) else None)
            width *= 2
        return begin, end

    def _run(self, text: str) -> np.ndarray:
        """A stretch without borders: few, possibly very long matches."""
        parts = [self._match(m.group().encode()) for m in self._pattern.finditer(text)]
        return np.array([i for part in parts for i in part], np.uint32)

    def _match(self, piece: bytes) -> list[int]:
        if len(piece) <= self._leaf_bytes:
            return self._bpe._encode_single_piece(piece)
        middle = len(piece) // 2
        return self._join_tokens(self._match(piece[:middle]), self._match(piece[middle:]))

    def _join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        width = 1
        while True:
            before, after = left[:-width], right[width:]
            window = b"".join([self._bytes[i] for i in left[-width:] + right[:width]])
            inner = self._bpe._encode_single_piece(window)
            if (not before or self._stays(before[-1], inner[0])) and (not after or self._stays(inner[-1], after[0])):
                return before + inner + after
            width *= 2

    def _pair_stays(self, first: int, second: int) -> bool:
        return self._bpe._encode_single_piece(self._bytes[first] + self._bytes[second]) == [first, second]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text.

    Null and empty texts have no ids. Rows stay as many as they are; ids of documents may be
    null or repeated, and further columns are not looked at. The rank file lies at the same
    place on every machine.
    """

    def make():
        bpe = TreeBpe(ranks_path, pattern)

        def run(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "ids": lists([bpe.encode(t) for t in texts(batch, "_text")], pa.int32())}

        return run

    return per_batch(docs.select("doc_id", F.col(text).alias("_text")), "doc_id long, ids array<int>", make)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with ``decoded``, the bytes that the ids stand for."""

    def make():
        bpe = TreeBpe(ranks_path, pattern)

        def run(batch: pa.RecordBatch) -> dict:
            column = batch.column(1)
            flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            decoded = [bpe.decode(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            return {"doc_id": batch.column(0), "ids": column, "decoded": pa.array(decoded, pa.binary())}

        return run

    return per_batch(encoded.select("doc_id", "ids"), "doc_id long, ids array<int>, decoded binary", make)


def digests(decoded: DataFrame) -> DataFrame:
    """Token count and SHA-256 of ids and bytes, for comparing whole encodings by a short row."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
