"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes.

Words are runs of letters and digits, or of one other character, found for a whole piece of text at once in
numpy. Their features are the shapes of the seven words around (letters, digits, case, length, a space before) and
those of them that are on a short list of cue words; the field adds a weight for each pair of neighbouring
labels. It is trained by gradient descent on a small labelled table. Words that no stretch around them can lift
above "no data", even with the best of all pairs, have that label on the best path; what is left
between them is decoded by Viterbi, stretches of one length together.

Spans that the field finds are added to those of the patterns unless they overlap one.
"""

from __future__ import annotations

import hashlib
import re
import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import pii_samples
from siftline.llm.common import per_batch, texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", "email", "phone", "secret", "id")
ORDER = {k: i for i, k in enumerate((*KINDS, *LABELS[3:]))}
PIECE = 1 << 20  # characters looked at together; more if none of their words is sure to be no data
TRAIN_ROWS = 4000  # labelled rows the field is trained on at most
STEPS = 150
PENALTY = 1e-3
BREAK = 50.0  # against a label on the break of a line
AROUND = (-3, -2, -1, 0, 1, 2, 3)

# Patterns of the base kinds. The look-behind only skips starts that cannot match.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELT = re.compile(r"\w\W+at\W+\w+(\W+dot\W+|\.)\w")
_NO_DIGIT = re.compile(r"[^0-9]")


def _luhn(digits: str) -> bool:
    twice = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns, by start, then kind."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            end = domain.end()
            found.append((begin, "email", end))
        else:
            end = max(end, at + 1)  # what is before this sign cannot begin a later match
        at = text.find("@", max(end, at + 1))
    for m in _IP.finditer(text):
        # A long part is over 255 unless it begins with zeros.
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), "card", m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
            found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], ORDER[s[1]]))


# Words and their shapes.

_DIGIT, _LOWER, _UPPER, _LETTER, _SIGN, _BREAK, _NO_HEX = (np.uint8(1 << i) for i in range(7))
_LINE = 10
_HEX = "0123456789abcdefABCDEF"
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LENGTHS = np.array([2, 3, 5, 9, 16])
_MIXED_LENGTHS = np.array([5, 9, 16, 24, 40, 64])
_MIXED = 21 + 4 * 6
_PUNCT = _MIXED + 6 * 7
EDGE = _PUNCT + len(_SIGNS) + 1
SHAPES = 2 * (EDGE + 1)
_PAD = 2 * EDGE

# Words that announce personal data.
CUES = (
    "token", "key", "secret", "password", "passwd", "pwd", "api", "apikey", "bearer", "credential", "access",
    "phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "móvil", "téléphone",
    "ssn", "social", "security", "iban", "passport", "license", "licence", "id", "tax", "konto", "account",
    "at", "dot", "email", "mail", "contact",
    "version", "page", "pages", "isbn", "commit", "sha", "sha256", "md5", "hash", "checksum", "order", "vol", "no",
)


@lru_cache(1)
def _classes() -> np.ndarray:
    """What a character is, for the first 65,536."""
    out = np.full(1 << 16, _LETTER | _NO_HEX, np.uint8)
    for c in map(chr, range(1 << 16)):
        if c in "\x20\t\n\x0b\x0c\r":
            kind = np.uint8(0)
        elif "0" <= c <= "9":
            kind = _DIGIT
        elif c.islower():
            kind = _LOWER | (np.uint8(0) if c in _HEX else _NO_HEX)
        elif c.isupper():
            kind = _UPPER | (np.uint8(0) if c in _HEX else _NO_HEX)
        elif c.isalnum() or "̀" <= c <= "ͯ":
            kind = _LETTER | _NO_HEX
        else:
            kind = _SIGN
        out[ord(c)] = kind
    out[_LINE] = _BREAK
    return out


@lru_cache(1)
def _cues() -> tuple[dict[str, int], np.ndarray]:
    """Number of each cue, and a table of what a cue can begin, end and measure."""
    table = np.zeros(1 << 16, bool)
    for cue in CUES:
        for shown in (cue, cue.title(), cue.upper()):
            table[(ord(shown[0]) * 1021 + ord(shown[-1]) * 31 + len(shown)) & 0xFFFF] = True
    return {cue: i + 1 for i, cue in enumerate(CUES)}, table


@dataclass
class Words:
    """Starts and ends of the words of a piece, their shapes and their cues."""

    starts: np.ndarray
    ends: np.ndarray
    shapes: np.ndarray
    cues: np.ndarray


def words_of(text: str) -> Words:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _classes()[np.minimum(points, 0xFFFF)]
    other = points > 0xFFFF
    if other.any():
        kinds = np.where(other, _SIGN, kinds)
    wordy = (kinds & 15) > 0
    same = (wordy[1:] & wordy[:-1]) | (~wordy[1:] & ~wordy[:-1] & (points[1:] == points[:-1]) & (kinds[1:] & _SIGN > 0))
    begins = np.flatnonzero(np.concatenate(([True], ~same)) & (kinds > 0)) if len(points) else np.zeros(0, np.int64)
    if not len(begins):
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, empty, empty)
    stops = np.concatenate((begins[1:], [len(points)]))
    gap = kinds == 0
    # A word ends where its run does: at the next word, or at the first gap before that.
    gaps = np.concatenate((np.flatnonzero(gap), [len(points)]))
    ends = np.minimum(stops, gaps[np.searchsorted(gaps, begins)])
    bits = np.bitwise_or.reduceat(kinds, begins)
    inner = kinds.copy()
    inner[begins] = 0
    inside = np.bitwise_or.reduceat(inner, begins)
    lengths = ends - begins
    first = points[begins]
    digits, letters = (bits & _DIGIT) > 0, (bits & 14) > 0
    upper, lower = (bits & _UPPER) > 0, (bits & (_LOWER | _LETTER)) > 0
    case = np.where(~upper, 0, np.where(~lower, 2, np.where((kinds[begins] & _UPPER > 0) & (inside & _UPPER == 0), 1, 3)))
    shapes = np.minimum(lengths, 20)
    shapes = np.where(letters & ~digits, 21 + case * 6 + np.searchsorted(_LENGTHS, lengths, "right"), shapes)
    mixed = ((bits & _NO_HEX) > 0) * 3 + np.where(~upper, 0, np.where(~lower, 1, 2))
    shapes = np.where(letters & digits, _MIXED + mixed * 7 + np.searchsorted(_MIXED_LENGTHS, lengths, "right"), shapes)
    signs = np.full(128, len(_SIGNS), np.int64)
    signs[[ord(c) for c in _SIGNS]] = np.arange(len(_SIGNS))
    shapes = np.where(letters | digits, shapes, _PUNCT + signs[np.minimum(first, 127)])
    broken = (bits & _BREAK) > 0
    spaced = (begins == 0) | gap[begins - 1] | (kinds[begins - 1] & _BREAK > 0)
    shapes = np.where(broken, _PAD, shapes * 2 + spaced)
    numbers, table = _cues()
    cues = np.zeros(len(begins), np.int64)
    likely = letters & table[(first * 1021 + points[ends - 1] * 31 + lengths) & 0xFFFF]
    for i in np.flatnonzero(likely).tolist():
        cues[i] = numbers.get(text[begins[i] : ends[i]].lower(), 0)
    return Words(begins, ends, shapes, cues)


def _around(values: np.ndarray, edge: int) -> list[np.ndarray]:
    """The values at each offset of AROUND, ``edge`` beyond the ends."""
    n, reach = len(values), max(AROUND)
    padded = np.full(n + 2 * reach, edge, values.dtype)
    padded[reach : reach + n] = values
    return [padded[reach + o : reach + o + n] for o in AROUND]


# The field.


@dataclass
class Field:
    """Weights: of shapes and cues by offset and label, and of neighbouring labels."""

    shapes: np.ndarray
    cues: np.ndarray
    pairs: np.ndarray

    def __post_init__(self):
        # One table per offset for a word's shape and cue together.
        self._both = (self.shapes[:, :, None] + self.cues[:, None]).reshape(len(AROUND), -1, len(LABELS))
        t = self.pairs - self.pairs[0, 0]
        self._inside = float(t[1:, 1:].max())
        self._ends = max(float(t[0, 1:].max()), 0.0) + max(float(t[1:, 0].max()), 0.0)
        # The most that pairs gain by one label other than "none", whatever the neighbours have; one may be missing.
        left, right = (t[:, 1:] - t[:, :1]).max(0), (t[1:] - t[:1]).max(1)
        self._alone = float((np.maximum(left, 0.0) + np.maximum(right, 0.0)).max())

    def emissions(self, words: Words) -> np.ndarray:
        both = words.shapes * self.cues.shape[1] + words.cues
        edge = _PAD * self.cues.shape[1]
        out = sum(self._both[k].take(at, axis=0) for k, at in enumerate(_around(both, edge)))
        out[words.shapes == _PAD, 1:] -= BREAK
        return out

    def labels(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The best label of every word, and which words have "none" whatever words and labels are around them.

        Giving "none" to all words of a stretch labelled otherwise costs at most the sum of their margins, and of a pair for each
        but one, and of the two ends: where no stretch around a word has a positive sum, it is "none".
        """
        emissions = self.emissions(words)
        n = len(emissions)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, bool)
        margins = emissions[:, 1:].max(1) - emissions[:, 0]
        sure = margins + self._alone < -1e-6
        sums = np.concatenate(([0.0], np.cumsum(margins + self._inside)))
        most = np.maximum.accumulate(sums[:0:-1])[::-1] - np.minimum.accumulate(sums[:-1])
        out = np.zeros(n, np.int64)
        doubtful = np.flatnonzero(most >= self._inside - self._ends - 1e-6)
        if not len(doubtful):
            return out, sure
        cuts = np.flatnonzero(np.diff(doubtful) > 1) + 1
        starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(doubtful)]))
        for length in np.unique(stops - starts).tolist():
            begin = starts[stops - starts == length]
            at = doubtful[begin[:, None] + np.arange(length)]
            out[at] = viterbi(emissions[at], self.pairs, at[:, 0] > 0, at[:, -1] < n - 1)
        return out, sure


def viterbi(emissions: np.ndarray, pairs: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The best labels of sequences of one length (sequence, word, label); a word labelled 0 stands before or after where said."""
    count, length, labels = emissions.shape
    score = emissions[:, 0] + np.where(before[:, None], pairs[0], 0.0)
    steps = np.zeros((count, length, labels), np.int8)
    for i in range(1, length):
        through = score[:, :, None] + pairs
        steps[:, i] = through.argmax(1)
        score = through.max(1) + emissions[:, i]
    score = score + np.where(after[:, None], pairs[:, 0], 0.0)
    out = np.zeros((count, length), np.int64)
    out[:, -1] = score.argmax(1)
    for i in range(length - 1, 0, -1):
        out[:, i - 1] = steps[np.arange(count), i, out[:, i]]
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis, keepdims=True))).squeeze(axis)


def _gradients(emissions: np.ndarray, pairs: np.ndarray, truth: np.ndarray, mask: np.ndarray):
    """Expected minus true label counts by word, and by pair, of padded sequences."""
    count, length, labels = emissions.shape
    forward, backward = np.zeros_like(emissions), np.zeros_like(emissions)
    forward[:, 0] = emissions[:, 0]
    for i in range(1, length):
        step = _log_sum(forward[:, i - 1, :, None] + pairs, 1) + emissions[:, i]
        forward[:, i] = np.where(mask[:, i, None], step, forward[:, i - 1])
    for i in range(length - 2, -1, -1):
        step = _log_sum(pairs + (emissions[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
        backward[:, i] = np.where(mask[:, i + 1, None], step, backward[:, i])
    total = _log_sum(forward[:, -1], 1)
    word = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
    both = mask[:, 1:]
    pair = forward[:, :-1, :, None] + pairs + (emissions[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
    pair = (np.exp(np.minimum(pair, 0.0)) * both[..., None, None]).sum((0, 1))
    np.subtract.at(word, (*np.nonzero(mask), truth[mask]), 1.0)
    np.subtract.at(pair, (truth[:, :-1][both], truth[:, 1:][both]), 1.0)
    return word, pair


def _sequence(text: str, spans: list[tuple[str, int, int]]) -> tuple[Words, np.ndarray]:
    words = words_of(text)
    truth = np.zeros(len(words.starts), np.int64)
    for kind, start, end in spans:
        truth[(words.starts < end) & (words.ends > start)] = LABELS.index(kind)
    return words, truth


def fit(labelled: DataFrame, max_rows: int = TRAIN_ROWS) -> Field:
    """A field for (text, spans array<struct<kind, start, end>>); of more than ``max_rows`` rows those with the least hashes.

    Spans of kinds that are no label are not learnt, a null text or list is empty. Without rows
    the field finds nothing.
    """
    rows = labelled.select("text", "spans").orderBy(F.xxhash64("text", F.to_json("spans"))).limit(max_rows).collect()
    return trained([(r.text or "", [tuple(s) for s in r.spans or [] if s[0] in LABELS]) for r in rows])


def trained(rows: list[tuple[str, list[tuple[str, int, int]]]]) -> Field:
    """Minimise the penalised negative log likelihood with momentum and a step per weight."""
    pairs_of = [s for s in (_sequence(*r) for r in rows) if len(s[1])]
    kinds = len(LABELS)
    weights = [np.zeros((len(AROUND), SHAPES, kinds)), np.zeros((len(AROUND), len(CUES) + 1, kinds)), np.zeros((kinds, kinds))]
    weights[0][AROUND.index(0), :, 0] = 1.0  # what was never seen is no personal data
    if not pairs_of:
        return Field(*weights)
    chunks = []
    pairs_of.sort(key=lambda s: len(s[1]))
    for begin in range(0, len(pairs_of), 256):
        part = pairs_of[begin : begin + 256]
        longest = len(part[-1][1])
        mask, truth = np.zeros((len(part), longest), bool), np.zeros((len(part), longest), np.int64)
        ids = np.zeros((2, len(AROUND), len(part), longest), np.int64)
        for i, (words, labels) in enumerate(part):
            n = len(labels)
            mask[i, :n], truth[i, :n] = True, labels
            for k, (s, c) in enumerate(zip(_around(words.shapes, _PAD), _around(words.cues, 0), strict=True)):
                ids[0, k, i, :n], ids[1, k, i, :n] = s, c
        chunks.append((mask, truth, ids))
    start = [w.copy() for w in weights]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        slopes = [np.zeros_like(w) for w in weights]
        for mask, truth, ids in chunks:
            emissions = sum(weights[f][k][ids[f, k]] for f in (0, 1) for k in range(len(AROUND)))
            word, pair = _gradients(emissions, weights[2], truth, mask)
            slopes[2] += pair
            errors = word[mask]
            for f in (0, 1):
                for k in range(len(AROUND)):
                    at = ids[f, k][mask]
                    for y in range(kinds):
                        slopes[f][k, :, y] += np.bincount(at, errors[:, y], slopes[f].shape[1])
        for w, g, m, s, w0 in zip(weights, slopes, mean, square, start, strict=True):
            g = g / len(pairs_of) + PENALTY * (w - w0)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= 0.1 * (1 - step / (STEPS + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Field(*weights)


# Spans.


def _plausible(kind: str, found: str) -> bool:
    """Whether what the field found has the least that its kind needs."""
    digits = sum(map(str.isdigit, found))
    if kind == "phone":
        return 7 <= digits <= 15
    if kind == "email":
        return "@" in found or bool(_SPELT.search(found.lower()))
    return len(found) >= 8 if kind == "secret" else digits >= 6


def field_spans(text: str, field: Field) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the words that the field labels alike, without breaks of lines."""
    found, at, reach, size = [], 0, max(AROUND), PIECE
    carried = 0  # words at the beginning of a piece that only give context
    while at < len(text):
        piece = text[at : at + size]
        last = at + size >= len(text)
        words = words_of(piece)
        labels, sure = field.labels(words)
        n = len(labels)
        stop = n
        if not last:
            safe = np.flatnonzero(sure[carried : max(carried, n - reach - 1)]) + carried
            if not len(safe) or safe[-1] < carried + reach:
                size *= 2  # one stretch from end to end
                continue
            stop = int(safe[-1])
        live = labels[carried:stop]
        edges = np.flatnonzero(np.diff(live)) + 1
        for a, b in zip(np.concatenate(([0], edges)).tolist(), np.concatenate((edges, [len(live)])).tolist(), strict=True):
            if b > a and live[a]:
                kind, begin, end = LABELS[live[a]], int(words.starts[carried + a]), int(words.ends[carried + b - 1])
                if _plausible(kind, piece[begin:end]):
                    found.append((at + begin, kind, at + end))
        if last:
            break
        # The next piece begins some words before the first one that is not settled.
        at, carried, size = at + int(words.starts[stop - reach]), reach, PIECE
    return found


def spans(text: str, field: Field) -> tuple[list, list]:
    """The spans of the patterns, and these with those of the field that overlap none of them."""
    base = base_spans(text)
    added, every = field_spans(text, field), list(base)
    if added and base:
        starts = np.array([s[0] for s in base])
        ends = np.maximum.accumulate(np.array([s[2] for s in base]))
        before = np.searchsorted(starts, [s[2] for s in added])
        added = [s for s, k in zip(added, before.tolist(), strict=True) if not k or ends[k - 1] <= s[0]]
    every += added
    return base, sorted(every, key=lambda s: (s[0], ORDER[s[1]]))


def _joined(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in found)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), a row per document.

    Counts and hash are of the patterns' spans, ``spans`` lists all of them as kind:start:end in code points. A
    null text is empty: no spans, and the hash of the empty text. Null and repeated ids are passed
    through; other columns are not looked at. Texts of any length are read whole, in pieces.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast((field.shapes, field.cues, field.pairs))

    def make():
        known = Field(*broadcast.value)

        def run(batch: pa.RecordBatch) -> dict:
            found = [spans(t, known) for t in texts(batch)]
            counts = {f"n_{k}": pa.array([sum(s[1] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS}
            hashes = [hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in found]
            every = [_joined(s) for _, s in found]
            return {"doc_id": batch.column(0)} | counts | {"base_sha256": pa.array(hashes, pa.string()), "spans": pa.array(every, pa.string())}

        return run

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return per_batch(docs.select("doc_id", "text"), schema, make, rows=500)


def labelled(spark: SparkSession, rows: int = 1200, seed: int = 7) -> DataFrame:
    """The small labelled table of this module, as (text, spans)."""
    schema = "text string, spans array<struct<kind: string, start: int, end: int>>"
    return spark.createDataFrame(pii_samples.rows(rows, seed), schema)


if sys.byteorder != "little":  # pragma: no cover
    raise ImportError("code points are read as little-endian numbers")
