"""Packing by lexical retrieval: a sharded BM25 index fills the window of each seed document.

Documents are dealt to shards by content, so that lexical neighbours meet whatever file they come from. The key of
a document are three weighted min-hashes of its terms: the chance that two documents share one is their weighted
overlap, and copies share all. Documents are ordered by their key and the order is cut into shards of a bounded
number of tokens; a frequent first hash is spread by the second, and a key that very many documents share by row. One
pass tokenises and counts in how many documents a term occurs; the weights of the hashes and those of BM25 come from
these counts, of all documents.

A task indexes a shard and fills one window after another: the seed comes first, then its unused BM25
neighbours, best first. The document that is cut at the end of a window is the next seed, so only the last window
of a shard is not full; that one is split into sequences whose lengths are powers of two. The driver sees counts of
terms and of first hashes, which are as many as the vocabulary has ids, and keys with very many documents.
"""

from __future__ import annotations

import math
import os
import re
import string
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer, pre_tokenizers

from siftline.llm.common import slices, text_slices, written

WINDOW = 2048
SHARD_TOKENS = 1 << 20
SPREAD_TOKENS = 1 << 20  # a first hash with more is spread by the second
HOT_TOKENS = 16 << 20  # a key with more is spread by row; at most tokens / HOT_TOKENS keys are
HASHES = 3
CACHE_WORDS = 200_000
TOGETHER = 1000
GROUP_BYTES = 8 << 20
COUNT_DOCS = 256
K1, B = 1.2, 0.75

# Behind the letters of a word a run of these marks is a unit of its own for the tokenizer; an apostrophe may not be.
_MARKS = string.punctuation.replace("'", "")
_WORD_END = "</w>"
_BLANKS = re.compile("[\t-\r ]+")


def _has_lower(text: str, lower: str) -> bool:
    """Whether no character's lower case depends on its place, or on composing."""
    return text.isascii() or (len(lower) == len(text) and "Σ" not in text and unicodedata.is_normalized("NFC", text))


def _lowered(text: str) -> str:
    """The text in lower case, but for words whose lower case is left to the tokenizer."""
    lower = text.lower()
    if _has_lower(text, lower):
        return lower
    return " ".join(low if _has_lower(word, low := word.lower()) else word for word in _BLANKS.split(text))


class WordTokens:
    """Ids of texts by a tokenizer that drops blanks: each distinct word between blanks is looked up, or encoded, once.

    A word is its letters and the marks behind them. Unknown units of this sort are encoded together, and
    their ids told apart by the tokens that end a word; what has long not been met is forgotten.
    """

    def __init__(self, path: str, end_id: int | None, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        self.path, self.end_id = path, end_id
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        # Units are normal and apart: the same model encodes them without looking for that again.
        self._units = Tokenizer.from_file(path)
        self._units.encode_special_tokens = True
        self._units.normalizer = None
        self._units.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.vocabulary = len(self._ends)
        self.dtype = np.dtype("<u2" if len(self._ends) <= 1 << 16 else "<u4")
        self._end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        self._most, self._known, self._before = cache_words, {"": b""}, {"": b""}

    def encode(self, text: str) -> bytes:
        """The ids as bytes of ``dtype``, with the end id."""
        return self.encode_column(pa.array([text], pa.string()))[0].as_py()

    def encode_column(self, column: pa.Array) -> pa.BinaryArray:
        """The ids of each text of a column; a null is the empty text."""
        if not len(column):
            return pa.array([], pa.binary())
        lowered = [_lowered(text or "") for text in column.to_numpy(zero_copy_only=False)]
        # Blanks of ASCII part units for every tokenizer of this sort; a word with others inside is left to it.
        words = pc.ascii_split_whitespace(pa.array(lowered, pa.large_string()))
        firsts, coded = words.offsets.to_numpy() - words.offsets[0].as_py(), words.flatten().dictionary_encode()
        units, parts = _parted(coded.dictionary)
        ids = pa.array([*self._ids_of(units.to_numpy(zero_copy_only=False).tolist()), self._end], pa.binary())
        codes = np.insert(parts[coded.indices.to_numpy()].ravel(), 2 * firsts[1:], len(units))  # the end id of each text
        joined = ids.take(pa.array(codes))
        _, ends, data = joined.buffers()
        bounds = np.frombuffer(ends, np.int32, len(codes) + 1, joined.offset * 4)[2 * firsts + np.arange(len(firsts))]
        return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(bounds), data])

    def _ids_of(self, units: list[str]) -> list[bytes]:
        """The ids of distinct units."""
        if len(self._known) > self._most:
            self._before, self._known = self._known, {}
        known, before = self._known, self._before
        new = [unit for unit in units if unit not in known]
        met = [unit for unit in new if unit in before]
        known.update(zip(met, map(before.__getitem__, met), strict=True))
        plain, others = [], []
        for unit in new:
            if unit not in before:
                alone = unit.isascii() and unit.isalpha() or not unit.strip(_MARKS) or unit.isalpha() and _has_lower(unit, unit.lower())
                (plain if alone else others).append(unit)
        for at in range(0, len(plain), TOGETHER):
            part = plain[at : at + TOGETHER]
            known.update(zip(part, self._together(part), strict=True))
        known.update(zip(others, self._whole(others), strict=True))
        return list(map(known.__getitem__, units))

    def _together(self, units: list[str]) -> list[bytes]:
        """Ids of single units, encoded as one text."""
        ids = np.array(self._units.encode_batch_fast([" ".join(units)], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(units) or ends[-1] != len(ids):
            return self._whole(units)
        data, width = ids.tobytes(), self.dtype.itemsize
        cuts = [0, *(ends * width).tolist()]
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _whole(self, parts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]


def _parted(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct units, and of each word the two that it consists of: letters and the marks behind them, or itself and nothing."""
    cores = pc.utf8_rtrim(words, characters=_MARKS)
    marks = pc.replace_substring_regex(words, r"^\pL+", "")
    sizes = pc.add(pc.binary_length(cores), pc.binary_length(marks))
    # A word that the tokenizer has to make normal stays whole.
    normal = pc.string_is_ascii(cores).to_numpy(zero_copy_only=False).copy()
    normal[~normal] = [_has_lower(core, core.lower()) for core in cores.filter(pa.array(~normal)).to_numpy(zero_copy_only=False)]
    plain = pc.and_(pc.and_(pc.utf8_is_alpha(cores), pa.array(normal)), pc.equal(sizes, pc.binary_length(words)))
    both = pa.concat_arrays([pc.if_else(plain, cores, words), pc.if_else(plain, marks, "")])
    coded = both.dictionary_encode()
    return coded.dictionary, np.ascontiguousarray(coded.indices.to_numpy().reshape(2, -1).T)


@lru_cache(maxsize=2)
def word_tokens(path: str, end_id: int | None) -> WordTokens:
    """One per process: the next task of a worker goes on with what the last one learnt."""
    return WordTokens(path, end_id)


def terms_by_document(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences), sorted by document and term."""
    flat = np.concatenate(ids)
    width = int(flat.max()).bit_length() if len(flat) else 0
    kind = np.uint32 if width + len(ids).bit_length() <= 32 else np.uint64  # narrow keys sort faster
    owner = np.repeat(np.arange(len(ids), dtype=kind), [len(x) for x in ids])
    pairs, occurrences = np.unique((owner << kind(width)) | flat.astype(kind), return_counts=True)
    terms = pairs & kind((1 << width) - 1)
    return (pairs >> kind(width)).astype(np.int64), terms.astype(np.int64), occurrences


def bm25_weights(terms: np.ndarray, tf: np.ndarray, lengths: np.ndarray, idf: np.ndarray, mean_tokens: float) -> np.ndarray:
    return idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths / mean_tokens))


def inverse_frequencies(docs: np.ndarray, total: int) -> np.ndarray:
    """BM25's weight of a term from the number of documents it is in."""
    return np.log1p((total - docs + 0.5) / (docs + 0.5))


class Keys:
    """Weighted min-hashes of documents: of each document the terms with the least exponential draws by weight."""

    def __init__(self, idf: np.ndarray, mean_tokens: float):
        self._idf, self._mean = idf, mean_tokens
        uniform = np.random.default_rng(0).random((HASHES, len(idf)))
        self._draws = -np.log1p(-uniform) + 1e-12

    def of(self, documents: int, docs: np.ndarray, terms: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Hashes by document; -1 for one without terms."""
        out = np.full((HASHES, documents), -1, np.int32)
        if not len(docs):
            return out
        weights = bm25_weights(terms, tf, lengths[docs], self._idf, self._mean) + 1e-9
        first = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
        sizes = np.diff(np.append(first, len(docs)))
        for k, draws in enumerate(self._draws):
            values = draws[terms] / weights
            least = np.repeat(np.minimum.reduceat(values, first), sizes)
            at = np.flatnonzero(values == least)
            out[k, docs[at[::-1]]] = terms[at[::-1]]  # of equal ones the first
        return out


_TOKENS = "doc_id long, ids binary, n int, counts binary"
_HASHES = ", ".join(f"h{k} int" for k in range(HASHES))


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, weights: tuple[np.ndarray, float] | None = None) -> DataFrame:
    """Two sorts of rows. Of documents: little-endian ids of the whole text and the end id, and how many; a null text has
    the end id alone. Of tasks: in how many of its documents each term occurs, then documents and tokens in all. With
    ``weights``, the keys are added.
    """

    def run(batches):
        tokens = word_tokens(tokenizer_path, end_id)
        found, total, size = np.zeros(tokens.vocabulary, np.int64), 0, 0
        for batch in batches:
            for part in text_slices(batch, most=GROUP_BYTES):
                encoded = tokens.encode_column(part.column("text"))
                lengths = []
                for at in range(0, len(encoded), COUNT_DOCS):
                    ids = [np.frombuffer(data.as_buffer(), tokens.dtype) for data in encoded[at : at + COUNT_DOCS]]
                    found += np.bincount(terms_by_document(ids)[1], minlength=len(found))
                    lengths += map(len, ids)
                total, size = total + part.num_rows, size + sum(lengths)
                columns = {"doc_id": part.column(0), "ids": encoded, "n": pa.array(lengths, pa.int32())}
                yield pa.RecordBatch.from_pydict(columns | {"counts": pa.nulls(part.num_rows, pa.binary())})
        nothing = {"doc_id": pa.nulls(1, pa.int64()), "ids": pa.nulls(1, pa.binary()), "n": pa.nulls(1, pa.int32())}
        counts = np.concatenate((found, [total, size])).astype("<i8").tobytes()
        yield pa.RecordBatch.from_pydict(nothing | {"counts": pa.array([counts], pa.binary())})

    out = docs.select("doc_id", "text").mapInArrow(run, _TOKENS)
    return out if weights is None else keyed(out, word_tokens(tokenizer_path, end_id).dtype, weights)


def keyed(tokenized: DataFrame, dtype: np.dtype, weights: tuple[np.ndarray, float]) -> DataFrame:
    """The rows with the key of each document; -1 for one without ids."""
    shared = tokenized.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        key = Keys(*shared.value)
        for batch in batches:
            for part in slices(batch, COUNT_DOCS):
                ids = [np.frombuffer(data.as_buffer() or b"", dtype) for data in part.column("ids")]
                hashes = key.of(len(ids), *terms_by_document(ids), np.array([len(x) for x in ids], np.int64))
                columns = dict(zip(part.schema.names, part.columns, strict=True))
                yield pa.RecordBatch.from_pydict(columns | {f"h{k}": pa.array(h) for k, h in enumerate(hashes)})

    return tokenized.mapInArrow(run, StructType(tokenized.schema.fields + StructType.fromDDL(_HASHES).fields))


def term_counts(tokenized: DataFrame, vocabulary: int) -> tuple[np.ndarray, int, int]:
    """In how many documents each term occurs, how many documents there are, and how many tokens."""

    def add(batches):
        out = np.zeros(vocabulary + 2, np.int64)
        for batch in batches:
            for data in batch.column(0):
                out += np.frombuffer(data.as_buffer(), "<i8")
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "n": pa.array(out[at], pa.int64())})

    parts = tokenized.where("counts IS NOT NULL").select("counts").mapInArrow(add, "at long, n long")
    sums = parts.groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # as many rows as the vocabulary has ids, and two
    out = np.zeros(vocabulary + 2, np.int64)
    out[sums["at"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out[:-2], int(out[-2]), int(out[-1])


def term_weights(docs: DataFrame, tokens: WordTokens) -> tuple[np.ndarray, float]:
    """Weights of terms and the mean length, from all documents."""
    return weights_of(*term_counts(tokenize(docs, tokens.path, tokens.end_id), tokens.vocabulary))


def weights_of(counts: np.ndarray, total: int, size: int) -> tuple[np.ndarray, float]:
    return inverse_frequencies(counts, total), max(1.0, size / max(total, 1))


sampled_weights = term_weights  # the name of before; nothing is sampled


class Bm25Shard:
    """An inverted index over the documents of one shard, with term weights from all documents."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean_tokens: float):
        lengths = np.array([len(x) for x in ids], np.int64)
        docs, terms, tf = terms_by_document(ids)
        self._doc_starts = np.searchsorted(docs, np.arange(len(ids) + 1))
        self._doc_terms = terms
        weights = bm25_weights(terms, tf, lengths[docs], idf, mean_tokens).astype(np.float32)
        order = np.argsort(terms, kind="stable")
        self._postings, self._weights = docs[order], weights[order]
        self._vocabulary, starts = np.unique(terms[order], return_index=True)
        self._starts = np.append(starts, len(terms))
        self._docs = len(ids)

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard for the terms of ``doc``."""
        terms = self._doc_terms[self._doc_starts[doc] : self._doc_starts[doc + 1]]
        at = np.searchsorted(self._vocabulary, terms)
        begin, size = self._starts[at], self._starts[at + 1] - self._starts[at]
        ends = np.cumsum(size)
        index = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)
        return np.bincount(self._postings[index], self._weights[index], self._docs)


def fill_windows(lengths: list[int], scores, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length); ``scores(doc)`` ranks the neighbours of a seed.

    Equal scores go by position. Every token is in exactly one piece.
    """
    unused = np.ones(len(lengths), bool)
    sequences, pieces, room = [], [], window
    queue: list[int] = []  # neighbours of the window's seed, best last
    doc, start, first = -1, 0, 0
    while True:
        if doc < 0:
            while queue and not unused[queue[-1]]:
                queue.pop()
            if queue:
                doc = queue.pop()
            else:
                while first < len(lengths) and not unused[first]:
                    first += 1
                if first == len(lengths):
                    break
                doc = first
            unused[doc], start = False, 0
        size = min(room, lengths[doc] - start)
        pieces.append((doc, start, size))
        start, room = start + size, room - size
        if room and len(pieces) == 1:  # the seed ends inside its window
            ranking = scores(doc)
            neighbours = np.flatnonzero(unused)
            queue = neighbours[np.argsort(-ranking[neighbours], kind="stable")][::-1].tolist()
        if not room:
            sequences.append(pieces)
            pieces, room, queue = [], window, []
        if start == lengths[doc]:
            doc = -1
    return sequences + _powers_of_two(pieces)


def _powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces of a window that is not full, cut into sequences of lengths 2**k, longest first."""
    left, out, pieces = sum(p[2] for p in pieces), [], list(reversed(pieces))
    while left:
        room, sequence = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            doc, start, size = pieces.pop()
            taken = min(room, size)
            sequence.append((doc, start, taken))
            room -= taken
            if taken < size:
                pieces.append((doc, start + taken, size - taken))
        out.append(sequence)
    return out


_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "padded_length long"
)


def _rows(sequences, doc_ids, ids, first_sequence, window):
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length")
    rows = []
    for k, pieces in enumerate(sequences):
        offset, total = 0, sum(p[2] for p in pieces)
        padded = total if total & (total - 1) == 0 else window
        for doc, start, size in pieces:
            crc = zlib.crc32(ids[doc][start : start + size].astype("<u4").tobytes())
            rows.append((doc_ids[doc], start, size, crc, len(ids[doc]), first_sequence + k, offset, padded))
            offset += size
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def dealt(tokenized: DataFrame) -> DataFrame:
    """The documents, in tasks that hold all of a first hash, or of a key where that is frequent, in the order of their keys."""
    spark = tokenized.sparkSession
    docs = tokenized.where("counts IS NULL").drop("counts")
    names = [f"h{k}" for k in range(HASHES)]
    sizes = written(docs.groupBy(*names).agg(F.sum("n").alias("_key")), "keys")  # the keys are made twice, not stored with the ids
    firsts = sizes.groupBy("h0").agg(F.sum("_key").alias("_first"))  # as many rows as the vocabulary has ids
    hot = sizes.where(F.col("_key") > HOT_TOKENS)
    sized = docs.join(F.broadcast(firsts), "h0").join(F.broadcast(hot), names, "left")
    second = F.when(F.col("_first") > SPREAD_TOKENS, F.col("h1")).otherwise(0)
    salt = F.coalesce(F.pmod(F.xxhash64("place"), F.ceil(F.col("_key") / HOT_TOKENS)), F.lit(0))
    tokens = sizes.agg(F.sum("_key")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(tokens / (8 * SHARD_TOKENS)))
    keyed = sized.select("doc_id", "ids", *names, "place", second.alias("_second"), salt.alias("_salt"))
    return keyed.repartition(tasks, "h0", "_second", "_salt").sortWithinPartitions(*names, "_salt", "place").select("doc_id", "ids")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """One row per piece of a document: where its tokens stand in which sequence.

    A null or empty text is one token, the end id. Repeated rows are packed as often as they
    occur; a null id stays null. Columns other than doc_id and text are not looked at. No
    documents give no rows.
    """
    spark = docs.sparkSession
    tokens = word_tokens(tokenizer_path, end_id)
    dtype = tokens.dtype
    tokenized = tokenize(docs, tokenizer_path, end_id)
    tokenized = written(tokenized.withColumn("place", F.monotonically_increasing_id()), "tokens")
    weights = weights_of(*term_counts(tokenized, tokens.vocabulary))
    shared = spark.sparkContext.broadcast(weights)

    def shards(batches):
        doc_ids, ids, held = [], [], 0
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids.append(doc)
                ids.append(np.frombuffer(data.as_py(), dtype))
                held += len(ids[-1])
                if held >= SHARD_TOKENS:
                    yield doc_ids, ids
                    doc_ids, ids, held = [], [], 0
        if ids:
            yield doc_ids, ids

    def run(batches):
        # The rows of a task and their order are fixed, so a repeated task gives the same numbers.
        idf, mean_tokens = shared.value
        next_sequence = TaskContext.get().partitionId() << 40
        for doc_ids, ids in shards(batches):
            index = Bm25Shard(ids, idf, mean_tokens)
            sequences = fill_windows([len(x) for x in ids], index.scores, window)
            yield _rows(sequences, doc_ids, ids, next_sequence, window)
            next_sequence += len(sequences)

    return dealt(keyed(tokenized.where("counts IS NULL"), dtype, weights)).mapInArrow(run, _SCHEMA)
