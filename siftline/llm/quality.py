"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Words become codes in order of first use, and a rolling polynomial hash over random
64-bit values of the codes names every window of n words, for several n at once. All
counts are over whole texts; one text is one row, so nothing is grouped or shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import per_batch, slices, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass(frozen=True)
class Limits:
    """A text is kept if each share of its characters stays within the limit.

    ``ngrams``: words in a window -> most characters inside windows found twice or more.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    ngrams: dict[int, float] = field(
        default_factory=lambda: {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
    )
    line_chars: float = 0.30


def _mixed(codes: np.ndarray) -> np.ndarray:
    """One well-spread 64-bit value per code; different codes stay different."""
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RollingHashes:
    """Hashes of all windows of a text: sums of value times base to the position, modulo 2**64."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        powers = np.full(n + 1, _BASE, np.uint64)
        inverse = np.full(n + 1, _BASE_INVERSE, np.uint64)
        powers[0] = inverse[0] = 1
        self._inverse = np.multiply.accumulate(inverse)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mixed(codes) * np.multiply.accumulate(powers)[:n], out=self._sums[1:])

    def of(self, n: int) -> np.ndarray:
        windows = len(self._sums) - n
        if windows <= 0:
            return np.zeros(0, np.uint64)
        return (self._sums[n:] - self._sums[:windows]) * self._inverse[:windows]


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """True for the words inside a window of ``n`` that begins where ``starts`` is true."""
    steps = np.zeros(words + 1, np.int32)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + n, -1)
    return np.cumsum(steps[:-1]) > 0


def _triples(codes: np.ndarray) -> np.ndarray:
    """An exact key for every window of three words."""
    size = int(codes.max()) + 1
    if size < 1 << 21:
        return (codes[:-2] * size + codes[1:-1]) * size + codes[2:]
    windows = np.stack((codes[:-2], codes[1:-1], codes[2:]), axis=1)
    return np.unique(windows, axis=0, return_inverse=True)[1].reshape(-1)


def measure(text: str, limits: Limits) -> tuple:
    """Word and line counts, the duplicated shares by n, and the verdicts of one text."""
    words = WORD.findall(text)
    n = len(words)
    seen: dict[str, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    chars = int(lengths.sum())
    lines, dup_lines, dup_line_chars = set(), 0, 0
    for line in text.split("\n"):
        if line in lines:
            dup_lines += 1
            dup_line_chars += sum(map(len, WORD.findall(line)))
        elif WORD.search(line):
            lines.add(line)
    repeat_words = int(covered(repeated(_triples(codes)), 3, n).sum()) if n >= 3 else 0
    shares = dict.fromkeys(limits.ngrams, 0.0)
    if repeat_words or (chars and min(limits.ngrams, default=3) < 3):
        hashes = RollingHashes(codes)
        for size in sorted(limits.ngrams):
            starts = repeated(hashes.of(size))
            if not starts.any() and size >= 3:
                break  # a longer window repeats only where its beginning repeats
            shares[size] = float(lengths[covered(starts, size, n)].sum() / chars)
    failed = n < limits.min_words or 100 * repeat_words > limits.max_repeat_percent * n
    line_share = dup_line_chars / chars if chars else 0.0
    fine = line_share <= limits.line_chars and all(shares[k] <= most for k, most in limits.ngrams.items())
    symbols = sum(text.count(s) for s in SYMBOLS)
    return n, chars, symbols, dup_lines, repeat_words, list(shares.values()), line_share, failed, fine and not failed


_NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ngram_shares", "line_share",
    "base_failed", "kept",
)
_TYPES = (pa.int64(),) * 5 + (pa.list_(pa.float64()), pa.float64(), pa.bool_(), pa.bool_())
_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ngram_shares array<double>, line_share double, base_failed boolean, kept boolean"
)


def rate(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: the counts, the duplicated shares and the verdict.

    A null or empty text has no words: all counts are 0, and it fails. Null and repeated ids
    are passed through; other columns are not looked at.
    """

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            columns = zip(*(measure(t, limits) for t in texts(batch)), strict=True)
            made = {k: pa.array(v, t) for k, v, t in zip(_NAMES, columns, _TYPES, strict=True)}
            return {"doc_id": batch.column(0)} | made

        return run

    return per_batch(docs.select("doc_id", "text"), _SCHEMA, make)


def kept_rows(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is kept."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array([measure(t, limits)[-1] for t in texts(part)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def without_shares(rated: DataFrame) -> DataFrame:
    return rated.withColumn("top_share", F.array_max("ngram_shares")).drop("ngram_shares")
