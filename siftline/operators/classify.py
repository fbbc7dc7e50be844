"""Tag each message PROFANITY or SAFE by case-insensitive substring lookup.

Three exact forms, picked by the size of the word list:

* a short list is an OR chain of ``contains``, inside whole-stage codegen;
* a longer list is one prefix-sharing alternation, a single pass over the text
  whatever the number of words;
* a list too big for an expression stays a table: rare parts of its words find the places
  of a text that are worth a look-up.

The first two are stateless and shuffle nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftline.operators.lexicon import TRIMMED, clean_words
from siftline.schema import PROFANITY, SAFE
from siftline.session import shared_dir

# Where one pass of the alternation starts to beat a chain of contains.
CHAIN_MAX_WORDS = 32

# Alternatives tried in turn before the next character splits them.
PLAIN_BRANCHES = 4

# Join form: lengths of the parts of words that texts are searched for, the characters of texts that
# are looked at at once, and the most bits of a filter over such parts.
GRAMS = (1, 2, 3, 6)
PIECE_CHARS = 1 << 16
FILTER_MAX_BITS = 1 << 24

# Tables of at most so many short rows are sent to every executor; larger ones are shuffled.
BROADCAST_MAX_ROWS = 500_000


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True when ``text`` holds any word; false for null or empty text and lists."""
    cleaned = sorted({w.strip(TRIMMED).lower() for w in words if w} - {""})
    if not cleaned:
        return F.lit(False)
    lowered = F.lower(text)
    if len(cleaned) <= CHAIN_MAX_WORDS:
        hit = reduce(Column.__or__, (F.contains(lowered, F.lit(w)) for w in cleaned))
    else:
        hit = F.regexp_instr(lowered, F.lit(alternation(cleaned))) > 0
    return F.coalesce(hit, F.lit(False))


def alternation(words: Iterable[str]) -> str:
    """A regular expression that finds any of ``words``, common prefixes merged.

    A word that starts with another word of the list is left out: wherever it
    matches, the shorter one does. Alternatives are tried one after another, so
    many of them are first halved by a look at the next character.
    """
    tree: dict = {}
    for word in sorted(words):
        node = tree
        for char in word:
            if "" in node:
                break
            node = node.setdefault(char, {})
        else:
            node[""] = {}
    return _branches(list(tree.items()))


def _branches(options: list[tuple[str, dict]]) -> str:
    if len(options) <= PLAIN_BRANCHES:
        parts = [
            re.escape(char) + ("" if "" in rest else _branches(list(rest.items())))
            for char, rest in options
        ]
    else:
        middle = len(options) // 2
        parts = [
            f"(?=[{''.join(re.escape(char) for char, _ in half)}]){_branches(half)}"
            for half in (options[:middle], options[middle:])
        ]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def tag(profane: Column) -> Column:
    return F.when(profane, F.lit(PROFANITY)).otherwise(F.lit(SAFE))


def classify(messages: DataFrame, words: Iterable[str] | DataFrame) -> DataFrame:
    """Overwrite ``profanity_type``; an incoming value is ignored."""
    if isinstance(words, DataFrame):
        return classify_by_join(messages, words)
    return messages.withColumn("profanity_type", tag(contains_any(F.col("message_body"), words)))


def profane_only(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("profanity_type") == PROFANITY)


def _widths(words: DataFrame) -> Column:
    """The length of the parts of a ``word``: the largest of GRAMS that fits."""
    width = F.lit(GRAMS[0])
    for wider in GRAMS[1:]:
        width = F.when(F.length("word") >= wider, wider).otherwise(width)
    return width


def _parts(text: str, width: int) -> Column:
    """The parts of ``width`` characters of a text, one for each place where one begins."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{width}}}))."), F.lit(1))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _hashed(chars: list[np.ndarray]) -> np.ndarray:
    """64 bits of each part, given by its first characters, its second ones and so on."""

    def packed(some: list[np.ndarray]) -> np.ndarray:
        return reduce(lambda left, right: (left << np.uint64(21)) | right, some[1:], some[0].astype(np.uint64))

    out = packed(chars[:3]) * np.uint64(0x9E3779B97F4A7C15)
    if chars[3:]:
        out = ((out ^ (out >> np.uint64(31))) + packed(chars[3:])) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def _hashed_grams(grams: list[str]) -> np.ndarray:
    sizes, out = np.array([len(gram) for gram in grams], np.int64), np.zeros(len(grams), np.uint64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        out[at] = _hashed(list(_codes("".join(grams[k] for k in at)).reshape(-1, size).T))
    return out


class BloomFilter:
    """A test that holds for every gram of a table, and for few other texts; of a column, or of all places of texts."""

    def __init__(self, words: np.ndarray):
        self._words, self._step = words, PIECE_CHARS

    def has(self, hashed: np.ndarray) -> np.ndarray:
        last, out = np.uint64(64 * len(self._words) - 1), True
        for place in (hashed & last, (hashed >> np.uint64(32)) & last):
            out = out & ((self._words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
        return out

    def __call__(self, gram: Column) -> Column:
        return F.pandas_udf(lambda grams: grams.iloc[:0].astype(bool) if grams.empty else type(grams)(self.has(_hashed_grams(grams.tolist()))), "boolean")(gram)

    def found(self, codes: np.ndarray, ends: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of the joined texts that end at ``ends``: places of parts that may be in the table, their texts, their hashes."""
        for start in range(0, len(codes) - width + 1, self._step):
            some = codes[start : start + self._step + width - 1]
            size = len(some) - width + 1
            hashed = _hashed([some[k : k + size] for k in range(width)])
            at = np.flatnonzero(self.has(hashed))
            places = at + start
            owner = np.searchsorted(ends, places, "right")
            inside = places + width <= ends[owner]
            yield places[inside], owner[inside], hashed[at[inside]]


def bloom_filter(grams: DataFrame) -> BloomFilter:
    """The filter of a table of distinct ``gram``s.

    The bits, at most FILTER_MAX_BITS, go to every task; beyond a sixteenth of as many grams it
    lets more through.
    """
    bits = min(max(1 << 10, 1 << (16 * grams.count()).bit_length()), FILTER_MAX_BITS)

    def places(batches):
        for batch in batches:
            hashed = _hashed_grams(batch.column(0).to_pylist())
            both = np.unique(np.concatenate((hashed, hashed >> np.uint64(32))) & np.uint64(bits - 1))
            yield pa.RecordBatch.from_pydict({"place": pa.array(both.astype(np.int64))})

    place = F.col("place")
    marked = (
        grams.select("gram")
        .mapInArrow(places, "place long")
        .select(F.shiftright(place, 6).alias("id"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("id")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.int64)
    words[marked["id"].to_numpy()] = marked["word"].to_numpy()
    return BloomFilter(words.view(np.uint64))


def _runs(batch: pa.RecordBatch, most: int) -> Iterator[tuple[int, list[str], np.ndarray, np.ndarray]]:
    """Runs of texts of about ``most`` characters: their first row, the texts, their joined characters and where each ends."""
    texts, first, size = batch.column("text").to_pylist(), 0, 0
    for row, text in enumerate(texts):
        size += len(text)
        if size >= most or row == len(texts) - 1:
            part = texts[first : row + 1]
            yield first, part, _codes("".join(part)), np.cumsum([len(text) for text in part])
            first, size = row + 1, 0


def _part_counts(texts: DataFrame, known: BloomFilter, widths: list[int]) -> DataFrame:
    """(gram, n): how many texts hold it; of all grams that the filter lets through."""
    shared = texts.sparkSession.sparkContext.broadcast(known)
    most = 16 * PIECE_CHARS

    def run(batches):
        known = shared.value
        for batch in batches:
            for _, part, codes, ends in _runs(batch, most):
                whole = "".join(part)
                for width in widths:
                    found = list(known.found(codes, ends, width))
                    if not found:
                        continue
                    places, owner, hashed = (np.concatenate(x) for x in zip(*found, strict=True))
                    if not len(places):
                        continue
                    order = np.argsort(hashed, kind="stable")  # by text among equal ones
                    places, owner = places[order], owner[order]
                    other = np.zeros(len(places) - 1, bool)  # compared by character: no hash decides
                    for k in range(width):
                        chars = codes[places + k]
                        other |= chars[1:] != chars[:-1]
                    firsts = np.flatnonzero(np.concatenate(([True], other)))
                    counted = np.concatenate(([True], other | (owner[1:] != owner[:-1])))
                    grams = [whole[at : at + width] for at in places[firsts].tolist()]
                    yield pa.RecordBatch.from_pydict({"gram": pa.array(grams, pa.string()), "n": pa.array(np.add.reduceat(counted.astype(np.int64), firsts))})

    return texts.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _part_places(texts: DataFrame, known: BloomFilter, widths: list[int], longest: int) -> DataFrame:
    """(key, gram, lead, near): the parts that the filter lets through, each with the text around and its place therein."""
    shared = texts.sparkSession.sparkContext.broadcast(known)
    most, before = 16 * PIECE_CHARS, longest - 1

    def run(batches):
        known = shared.value
        for batch in batches:
            for first, part, codes, ends in _runs(batch, most):
                begins = np.concatenate(([0], ends[:-1]))
                for width in widths:
                    for places, owner, _ in known.found(codes, ends, width):
                        at = places - begins[owner]
                        lead = np.minimum(at, before)
                        grams, near = [], []
                        for text, place, begin in zip(owner.tolist(), at.tolist(), (at - lead).tolist(), strict=True):
                            grams.append(part[text][place : place + width])
                            near.append(part[text][begin : begin + 2 * longest])
                        columns = {"key": batch.column("key").take(pa.array(owner + first)), "gram": pa.array(grams, pa.string())}
                        yield pa.RecordBatch.from_pydict(columns | {"lead": pa.array(lead, pa.int32()), "near": pa.array(near, pa.string())})

    schema = StructType([texts.schema["key"], *StructType.fromDDL("gram string, lead int, near string").fields])
    return texts.select("key", "text").mapInArrow(run, schema)


def rarest_parts(words: DataFrame, texts: DataFrame, widths: list[int]) -> DataFrame:
    """(word, gram, offset): of each word the part that the fewest ``texts`` hold. A word of which some part is in none is left out."""
    width = _widths(words)
    parts = F.coalesce(*(F.when(width == w, _parts("word", w)) for w in widths))
    every = words.select("word", F.posexplode(parts).alias("offset", "gram"))
    counts = _part_counts(texts, bloom_filter(every.select("gram").distinct()), widths)
    ranked = every.join(counts, "gram", "left").select("word", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "gram").alias("part"))
    best = ranked.groupBy("word").agg(F.min("part").alias("part")).where("part.n > 0")
    return best.select("word", "part.gram", "part.offset")


def profane_texts(texts: DataFrame, words: DataFrame, broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The keys of those ``texts`` (key, text) that hold a word of a cleaned ``word`` table.

    Each word is found by its rarest part. A Bloom filter over these parts thins the places of a
    text before they become rows. A place that is left leads to the lengths and offsets of the words with its
    part, not to the words: each stretch of the text so given is looked up as a whole. A few words too short
    for a part of the largest size are looked for directly.
    """
    spark = texts.sparkSession
    short = words.where(F.length("word") < GRAMS[-1]).limit(CHAIN_MAX_WORDS + 1).collect()
    direct = texts.select("key").limit(0)
    if 0 < len(short) <= CHAIN_MAX_WORDS:
        hit = reduce(Column.__or__, (F.contains("text", F.lit(w.word)) for w in short))
        direct = texts.where(hit).select("key")
        texts, words = texts.where(~hit), words.where(F.length("word") >= GRAMS[-1])
    bounds = words.agg(F.max(F.length("word")).alias("longest"), F.count("*").alias("n"), F.collect_set(_widths(words)).alias("widths")).first()
    if not bounds.n:
        return direct.distinct()
    longest, widths = bounds.longest, sorted(bounds.widths)
    small = bounds.n <= broadcast_rows

    path = shared_dir(spark, "rare-parts")
    rarest_parts(words, texts, widths).write.parquet(path)
    rare = spark.read.schema("word string, gram string, offset int").parquet(path)
    shapes = F.collect_set(F.struct("offset", F.length("word").alias("chars"))).alias("shapes")
    anchors = rare.groupBy("gram").agg(shapes)
    places = _part_places(texts, bloom_filter(rare.select("gram").distinct()), widths, longest)
    hits = places.join(F.broadcast(anchors) if small else anchors, "gram")
    stretches = hits.select("key", "lead", "near", F.inline("shapes")).where("lead >= offset")
    found = F.expr("substring(near, lead - offset + 1, chars)")
    looked_up = stretches.select("key", found.alias("word"))
    kept = rare.select("word")
    return direct.union(looked_up.join(F.broadcast(kept) if small else kept, "word", "left_semi").select("key")).distinct()


def classify_by_join(messages: DataFrame, words: DataFrame, broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``classify`` for a table of words of any size (batch input), cleaned as a list would be.

    The keys of profane texts are written to the shared folder once. While they are few they
    are broadcast and the messages stay where they are; otherwise copies of a text are
    screened once, and adaptive execution can split a text with very many copies.
    """
    words = clean_words(words)
    lowered = F.lower("message_body")
    key = F.unhex(F.sha2(lowered, 256))
    texts = messages.select(key.alias("key"), lowered.alias("text")).where(F.length("text") > 0)
    if not broadcast_rows:
        texts = texts.dropDuplicates(["key"])
    spark = messages.sparkSession
    path = shared_dir(spark, "profane-texts")
    profane_texts(texts, words, broadcast_rows).select(F.col("key").alias("_text"), F.lit(True).alias("_profane")).write.parquet(path)
    flagged = spark.read.schema("_text binary, _profane boolean").parquet(path)
    if flagged.limit(broadcast_rows + 1).count() <= broadcast_rows:
        flagged = F.broadcast(flagged)
    return (
        messages.withColumn("_text", key)
        .join(flagged, "_text", "left")
        .withColumn("profanity_type", tag(F.coalesce("_profane", F.lit(False))))
        .drop("_text", "_profane")
    )
