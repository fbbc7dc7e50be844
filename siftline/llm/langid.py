"""Language identification: scripts narrow the candidates, Viterbi over word scores labels spans.

A word scores each language by log-probabilities of its hashed character n-grams. The
path of languages over the words of a text pays a penalty for every switch, so a
passage in another language becomes a span of its own and a single odd word does not.
All texts of a batch walk one step at a time together in numpy.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import slices, text_slices, texts

# Bounds of the sample of labelled rows that the scores are fitted on: expected documents per language.
TRAIN_DOCS = 3000
BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
SWITCH_PENALTY = 12.0
OTHER_SCRIPT = -30.0
MIN_SCRIPT_SHARE = 0.01
CACHE_WORDS = 200_000
STEP_WORDS = 300_000
WALK_ROWS = 10_000  # texts that walk together: few have the length of the longest
UNKNOWN = "und"

# First code point, last code point and name of the Unicode ranges that tell scripts apart.
SCRIPTS = (
    (0x0041, 0x024F, "latin"), (0x0250, 0x02FF, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"),
    (0x0530, 0x058F, "armenian"), (0x0590, 0x05FF, "hebrew"), (0x0600, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"),
    (0x0980, 0x09FF, "bengali"), (0x0A00, 0x0A7F, "gurmukhi"), (0x0A80, 0x0AFF, "gujarati"), (0x0B80, 0x0BFF, "tamil"),
    (0x0C00, 0x0C7F, "telugu"), (0x0C80, 0x0CFF, "kannada"), (0x0D00, 0x0D7F, "malayalam"), (0x0D80, 0x0DFF, "sinhala"),
    (0x0E00, 0x0E7F, "thai"), (0x0E80, 0x0EFF, "lao"), (0x0F00, 0x0FFF, "tibetan"), (0x1000, 0x109F, "myanmar"),
    (0x10A0, 0x10FF, "georgian"), (0x1100, 0x11FF, "hangul"), (0x1200, 0x139F, "ethiopic"), (0x1780, 0x17FF, "khmer"),
    (0x1800, 0x18AF, "mongolian"), (0x1E00, 0x1EFF, "latin"), (0x1F00, 0x1FFF, "greek"), (0x3040, 0x30FF, "kana"),
    (0x3400, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"), (0xFB50, 0xFDFF, "arabic"), (0xFE70, 0xFEFC, "arabic"),
)
_STARTS = [s[0] for s in SCRIPTS]
SCRIPT_NAMES = sorted({s[2] for s in SCRIPTS}) + ["other"]
_NUMBER = {name: i for i, name in enumerate(SCRIPT_NAMES)}

_WORD = re.compile(r"[^\W\d_]+")


def script_of(word: str) -> int:
    """The script of the first letter."""
    point = ord(word[0])
    at = bisect.bisect_right(_STARTS, point) - 1
    return _NUMBER[SCRIPTS[at][2] if at >= 0 and point <= SCRIPTS[at][1] else "other"]


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case. Numerals that are not letters are left out."""
    return [w for w in _WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def grams(word: str) -> list[int]:
    """Buckets of the character n-grams of a word with its ends marked, and of the word itself."""
    marked = f"<{word}>"
    parts = [marked[i : i + n] for n in ORDERS for i in range(len(marked) - n + 1)] + [marked]
    return [zlib.crc32(p.encode()) % BUCKETS for p in parts]


@dataclass
class Model:
    """Per language the log-probability of each bucket, and the scripts it is written in."""

    langs: list[str]
    table: np.ndarray  # BUCKETS x languages
    scripts: np.ndarray  # scripts x languages: is it a candidate


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on a sample of the labelled rows: all, or about ``train_docs`` per language picked by a hash of the id.

    Rows without text, language or id teach nothing. The counts that reach the driver are as
    many as languages times buckets.
    """
    labelled = docs.select("doc_id", "text", "lang").where("doc_id is not null and lang is not null and text is not null")
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    share = F.create_map(*(F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, train_docs / n))))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count(batches):
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(words_of(text))
        for lang, counted in words.items():
            sums, scripts = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)
            for word, n in counted.items():
                np.add.at(sums, grams(word), n)
                scripts[script_of(word)] += n * len(word)
            at, used = np.flatnonzero(sums), np.flatnonzero(scripts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (len(at) + len(used)), pa.string()),
                    "bucket": pa.array(np.concatenate((at, -1 - used)), pa.int64()),
                    "n": pa.array(np.concatenate((sums[at], scripts[used])), pa.int64()),
                }
            )

    partial = sample.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    rows = partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows.lang.unique())
    number = rows.lang.map({k: i for i, k in enumerate(langs)}).to_numpy(np.int64)
    bucket, n = rows.bucket.to_numpy(np.int64), rows.n.to_numpy(np.float64)
    table, letters = np.zeros((BUCKETS, len(langs))), np.zeros((len(SCRIPT_NAMES), len(langs)))
    table[bucket[bucket >= 0], number[bucket >= 0]] = n[bucket >= 0]
    letters[-1 - bucket[bucket < 0], number[bucket < 0]] = n[bucket < 0]
    table = np.log((table + 0.5) / (table.sum(0) + 0.5 * BUCKETS))
    return Model(langs, table.astype(np.float32), letters / letters.sum(0) >= MIN_SCRIPT_SHARE)


class Labeller:
    """Spans of languages for texts, by a fitted model."""

    def __init__(self, model: Model, penalty: float = SWITCH_PENALTY):
        self._model, self._penalty = model, penalty
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._scores = np.zeros((0, len(self._model.langs)), np.float32)
        self._written = np.zeros(0, bool)  # is the script of the word that of a language

    def label(self, batch: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each text its spans: first word, words, letters, number of the language."""
        return [[s[:4] for s in spans] for spans in self.weigh(batch)]

    def weigh(self, batch: list[str]) -> list[list[tuple[int, int, int, int, int]]]:
        """The spans of ``label``, each with its letters of words in a script of some language."""
        out: list = [[] for _ in batch]
        order = sorted(range(len(batch)), key=lambda i: -len(batch[i]))  # texts of like length walk together
        held, total = [], 0
        for i in order:
            words = words_of(batch[i])
            if words:
                held.append((i, words))
                total += len(words)
            if total >= STEP_WORDS:
                self._walk(held, out)
                held, total = [], 0
        if held:
            self._walk(held, out)
        return out

    def _indexes(self, held) -> tuple[np.ndarray, np.ndarray]:
        new = set().union(*(w for _, w in held)).difference(self._known)
        if new:
            if len(self._known) + len(new) > CACHE_WORDS:
                self._forget()
                new = set().union(*(w for _, w in held))
            fresh = list(new)
            found = [grams(w) for w in fresh]
            starts = np.cumsum([0] + [len(g) for g in found[:-1]])
            scores = np.add.reduceat(self._model.table[np.concatenate(found)], starts, axis=0) / len(ORDERS)
            candidates = self._model.scripts[[script_of(w) for w in fresh]]
            scores[~candidates & candidates.any(1, keepdims=True)] = OTHER_SCRIPT
            # Only differences count: the best candidate of a word has 0, and no word outweighs a switch by far.
            scores = np.maximum(scores - np.where(candidates, scores, -np.inf).max(1, keepdims=True, initial=-1e9), OTHER_SCRIPT)
            scores[~candidates.any(1)] = 0
            self._known.update(zip(fresh, range(len(self._scores), len(self._scores) + len(fresh)), strict=True))
            self._scores = np.concatenate((self._scores, scores.astype(np.float32)))
            self._written = np.concatenate((self._written, candidates.any(1)))
        known = self._known
        index = np.fromiter((known[w] for _, ws in held for w in ws), np.int64)
        return index, np.fromiter((len(w) for _, ws in held for w in ws), np.int64)

    def _walk(self, held, out) -> None:
        held = sorted(held, key=lambda x: -len(x[1]))
        index, letters = self._indexes(held)
        lengths = np.array([len(w) for _, w in held])
        starts = np.cumsum(lengths) - lengths
        emitted = self._scores[index]
        came = np.zeros(emitted.shape, np.int16)
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than t
        best = emitted[starts].copy()
        stay = np.arange(best.shape[1])
        for t in range(1, lengths[0]):
            m = active[t]
            now = best[:m]
            top = now.argmax(1)
            switched = now[np.arange(m), top][:, None] - self._penalty
            stays = now >= switched
            at = starts[:m] + t
            came[at] = np.where(stays, stay, top[:, None])
            best[:m] = np.where(stays, now, switched) + emitted[at]
        label = np.zeros(len(index), np.int16)
        state = best.argmax(1)
        for t in range(lengths[0] - 1, -1, -1):
            m = active[t]
            at = starts[:m] + t
            label[at] = state[:m]
            state[:m] = came[at, state[:m]]
        sums = np.concatenate(([0], np.cumsum(letters)))
        counted = np.concatenate(([0], np.cumsum(letters * self._written[index])))
        changes = np.flatnonzero(label[1:] != label[:-1]) + 1
        edges = np.unique(np.concatenate((starts, changes, [len(label)])))
        text = np.searchsorted(starts, edges[:-1], side="right") - 1
        for a, b, k in zip(edges[:-1].tolist(), edges[1:].tolist(), text.tolist(), strict=True):
            out[held[k][0]].append((a - int(starts[k]), b - a, int(sums[b] - sums[a]), int(label[a]), int(counted[b] - counted[a])))


def judge(spans: list[tuple[int, int, int, int, int]], langs: list[str]) -> tuple[str, float]:
    """The language with the most letters and its share of the letters; ties go to the name that sorts first.

    Letters of words whose script no language uses are in the whole, but count for no language.
    """
    if not spans or not langs:
        return UNKNOWN, 0.0
    letters: Counter = Counter()
    for _, _, _, lang, n in spans:
        letters[lang] += n
    lang = min(letters, key=lambda k: (-letters[k], langs[k]))
    return langs[lang], letters[lang] / sum(s[2] for s in spans)


_SCHEMA = "doc_id long, lang_pred string, score double, spans array<struct<first_word: int, words: int, lang: string>>"


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: language, its share of the letters, and the spans by word.

    A text that is null or has no letter, and any text if nothing was learnt, is ``und`` with
    score 0 and no spans. Null and repeated ids are passed through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        langs, labeller = shared.value.langs, Labeller(shared.value)
        # Texts that walk together are bounded in number and bytes.
        for batch in (p for b in batches for part in slices(b, WALK_ROWS) for p in text_slices(part)):
            spans = labeller.weigh(texts(batch)) if langs else [[]] * batch.num_rows
            judged = [judge(s, langs) for s in spans]
            named = [[{"first_word": a, "words": n, "lang": langs[k]} for a, n, _, k, _ in s] for s in spans]
            kind = pa.list_(pa.struct([("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
            columns = {
                "doc_id": batch.column(0),
                "lang_pred": pa.array([j[0] for j in judged], pa.string()),
                "score": pa.array([j[1] for j in judged], pa.float64()),
                "spans": pa.array(named, kind),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)


def kept_rows(docs: DataFrame, model: Model, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that have a language with at least ``min_score`` of the letters.

    If nothing was learnt there is no language to judge by, and only texts without a letter go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        langs, labeller = shared.value.langs, Labeller(shared.value)
        for part in (p for batch in batches for p in text_slices(batch)):
            if langs:
                judged = [judge(s, langs) for s in labeller.weigh(texts(part))]
                kept = [lang != UNKNOWN and score >= min_score for lang, score in judged]
            else:
                kept = [bool(words_of(t)) for t in texts(part)]
            yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``: rows that are not learnt from, by the CRC of the id; a null id is neither."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))


def train_rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
