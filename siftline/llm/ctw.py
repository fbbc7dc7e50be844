"""Language-model scoring by context-tree weighting over binary-decomposed byte contexts.

A byte is eight binary decisions, and each decision has its own tree of contexts: the
bytes before it, most recent first, to a depth of five. A node holds the zeros and ones
seen in its context, its Krichevsky-Trofimov estimate, and the weight of stopping there
against going deeper, which follows from the estimates of the whole subtree. So every
probability mixes the estimates of all depths.

The corpus is read in blocks of documents. A block lists its different contexts with
the byte that follows (six bytes in all), and how often learning documents have them.
The sums over all blocks make the trees: the subtrees below two bytes of context are
computed where Spark deals them, the two levels above from their sums, which are at
most 256 * 255 rows. The probabilities then go back to the blocks that need them, so no
task holds the model of the whole corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import written

DEPTH = 5
TOP = 2
END = 0xFF  # no byte of UTF-8; follows every text and precedes it as its context
BLOCK_BYTES = 32 << 20
TASKS = 4
CHUNK = 1 << 20
CACHE_WORDS = 100_000
READ_DOCS = 256
TREE_ROWS = 200_000
GRAM, WORD = 0, 1


def lowered(text: str | None) -> bytes:
    """The bytes that are modelled: UTF-8 with A-Z in lower case."""
    return (text or "").encode().lower()


def gram_codes(data: bytes) -> np.ndarray:
    """For each byte of a text and its end: the bytes before it, most recent highest, and the byte lowest."""
    padded = np.full(len(data) + DEPTH + 1, END, np.uint64)
    padded[DEPTH:-1] = np.frombuffer(data, np.uint8)
    n = len(data) + 1
    codes = np.zeros(n, np.uint64)
    for back in range(1, DEPTH + 1):
        codes = (codes << np.uint64(8)) | padded[DEPTH - back : DEPTH - back + n]
    return (codes << np.uint64(8)) | padded[DEPTH:]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


class _Sums:
    """Sums of counts by key, kept sorted and merged now and then."""

    def __init__(self):
        self._keys, self._counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._keys.append(keys)
        self._counts.append(counts)
        if sum(map(len, self._keys[1:])) > len(self._keys[0]) // 2 + CHUNK:
            self.merge()

    def count(self, keys: np.ndarray, learn: bool) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.add(found, counts if learn else np.zeros(len(found), np.int64))

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate(self._keys), np.concatenate(self._counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self._keys, self._counts = [keys[first]], [np.add.reduceat(counts, first) if len(first) else counts]
        return self._keys[0], self._counts[0]


def _word_hashes(words) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def _rows(table: pa.Table, *names: str):
    """The rows of a group, a few as Python values at a time."""
    for batch in table.select(list(names)).to_batches(max_chunksize=READ_DOCS):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _collect(table: pa.Table) -> pa.Table:
    """The different contexts and words of a block, with their counts in documents to learn from."""
    grams, words, counts = _Sums(), _Sums(), {}
    held: dict[bool, list[np.ndarray]] = {True: [], False: []}
    sizes = {True: 0, False: 0}

    def note_words():
        words.add(_word_hashes(counts), np.fromiter(counts.values(), np.int64, len(counts)))
        counts.clear()

    for text, learn in _rows(table, "text", "learn"):
        data = lowered(text)
        held[learn].append(gram_codes(data))
        sizes[learn] += len(data) + 1
        if sizes[learn] > CHUNK:
            grams.count(np.concatenate(held[learn]), learn)
            held[learn], sizes[learn] = [], 0
        for word in data.split():
            counts[word] = counts.get(word, 0) + learn
        counts[b"\n"] = counts.get(b"\n", 0) + learn
        if len(counts) > CACHE_WORDS:
            note_words()
    note_words()
    for learn, codes in held.items():
        if codes:
            grams.count(np.concatenate(codes), learn)
    keys, key_counts = grams.merge()
    hashes, hash_counts = words.merge()
    n = len(keys) + len(hashes)
    return pa.table(
        {
            "block": pa.array(np.full(n, table["block"][0].as_py(), np.int64)),
            "kind": pa.array(np.repeat(np.array([GRAM, WORD], np.int32), [len(keys), len(hashes)])),
            "key": pa.array(_signed(np.concatenate((keys, hashes)))),
            "n": pa.array(np.concatenate((key_counts, hash_counts))),
        }
    )


def _log_gamma(z: np.ndarray) -> np.ndarray:
    """By Stirling's series, moved up by seven where it is exact to double precision."""
    product = np.ones_like(z)
    for i in range(7):
        product *= z + i
    z = z + 7
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    zeros, ones = zeros.astype(np.float64), ones.astype(np.float64)
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - math.log(math.pi) - _log_gamma(zeros + ones + 1)


def mixed(log_stop: np.ndarray, log_deeper: np.ndarray) -> np.ndarray:
    """Log of the weighted probability of a node: half its own estimate, half its children's."""
    return np.logaddexp(log_stop, log_deeper) - math.log(2)


def stop_weight(log_stop: np.ndarray, log_deeper: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(log_deeper - log_stop, -700, 700)))


def subtrees(codes: np.ndarray, counts: np.ndarray, depth: int = DEPTH, top: int = TOP):
    """Mix all depths from ``depth`` up to ``top`` for sorted distinct codes.

    Returns per code the probabilities of its eight bits, and per node at ``top`` its context,
    bit prefix (with a leading one), zeros, ones, and log of the weighted probability.
    """
    level, n = codes, counts
    to_level = np.arange(len(codes))
    bits = np.zeros((len(codes), 8))
    children: list = []
    for d in range(depth, top - 1, -1):
        if d < depth:
            below, below_rows = level, to_level
            shorter = ((below >> np.uint64(16)) << np.uint64(8)) | (below & np.uint64(255))
            level, up = np.unique(shorter, return_inverse=True)
            n = np.bincount(up, n, len(level))
            to_level = up[below_rows]
        nodes = []
        for j in range(8):
            keys = level >> np.uint64(8 - j)
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            node = np.cumsum(np.concatenate(([False], keys[1:] != keys[:-1])))
            bit = ((level >> np.uint64(7 - j)) & np.uint64(1)).astype(np.int64)
            ones, total = np.add.reduceat(n * bit, first), np.add.reduceat(n, first)
            log_stop = log_kt(total - ones, ones)
            seen = np.where(bit == 1, ones[node], total[node] - ones[node])
            estimate = ((seen + 0.5) / (total[node] + 1))[to_level]
            if d == depth:
                log_weighted, bits[:, j] = log_stop, estimate
            else:
                child_first, child_weighted = children[j]
                deeper = np.bincount(node[up[child_first]], child_weighted, len(first))
                weight = stop_weight(log_stop, deeper)[node][to_level]
                log_weighted = mixed(log_stop, deeper)
                bits[:, j] = weight * estimate + (1 - weight) * bits[:, j]
            nodes.append((first, log_weighted))
            if d == top:
                prefix = (np.uint64(1) << np.uint64(j)) | ((level[first] & np.uint64(255)) >> np.uint64(8 - j))
                nodes[-1] = (level[first] >> np.uint64(8), prefix, total - ones, ones, log_weighted)
        children = nodes
    return bits, tuple(np.concatenate(c) for c in zip(*children, strict=True))


_TREE = "key long, bits binary, recent int, prefix int, zeros long, ones long, log_weighted double"


def _subtree_rows(batches):
    """Rows of two sorts: a code and its bits below two bytes of context; sums for a node of one byte of context."""

    def rows(keys, counts):
        bits, (context, prefix, zeros, ones, weighted) = subtrees(keys, counts)
        none = np.zeros(0)
        node, at = np.unique((context >> np.uint64(8) << np.uint64(8)) | prefix, return_inverse=True)
        sums = [np.bincount(at, v, len(node)) for v in (zeros, ones, weighted)]
        first = {
            "key": pa.array(_signed(keys)), "bits": pa.array([b.tobytes() for b in bits.astype(np.float32)], pa.binary()),
            "recent": pa.nulls(len(keys), pa.int32()), "prefix": pa.nulls(len(keys), pa.int32()),
            "zeros": pa.nulls(len(keys), pa.int64()), "ones": pa.nulls(len(keys), pa.int64()),
            "log_weighted": pa.nulls(len(keys), pa.float64()),
        }
        yield pa.RecordBatch.from_pydict(first)
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.nulls(len(node), pa.int64()), "bits": pa.nulls(len(node), pa.binary()),
                "recent": pa.array((node >> np.uint64(8)).astype(np.int32)), "prefix": pa.array((node & np.uint64(255)).astype(np.int32)),
                "zeros": pa.array(sums[0].astype(np.int64)), "ones": pa.array(sums[1].astype(np.int64)),
                "log_weighted": pa.array(sums[2]),
            }
        )

    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate((keys, batch.column(0).to_numpy().view(np.uint64)))
        counts = np.concatenate((counts, batch.column(1).to_numpy()))
        if len(keys) >= TREE_ROWS:
            # Sorted, so all but the last two-byte context are complete.
            below = np.uint64(8 * (DEPTH - TOP + 1))
            whole = int(np.searchsorted(keys, keys[-1] >> below << below))
            if whole:
                yield from rows(keys[:whole], counts[:whole])
                keys, counts = keys[whole:], counts[whole:]
    if len(keys):
        yield from rows(keys, counts)


def top_levels(sums) -> tuple[np.ndarray, ...]:
    """Stop weights and estimates of the root and of one byte of context, from the summed nodes below.

    ``sums`` has recent, prefix, zeros, ones and log_weighted, at most 256 * 255 rows.
    """
    counts, deeper = np.zeros((2, 256, 256)), np.zeros((256, 256))
    recent, prefix = sums.recent.to_numpy(np.int64), sums.prefix.to_numpy(np.int64)
    counts[0, recent, prefix], counts[1, recent, prefix] = sums.zeros.to_numpy(), sums.ones.to_numpy()
    deeper[recent, prefix] = sums.log_weighted.to_numpy(np.float64)
    stop = log_kt(counts[0], counts[1])
    root = counts.sum(1)
    root_deeper = mixed(stop, deeper).sum(0)
    estimates = [(c + 0.5) / (c.sum(0) + 1) for c in (counts, root)]  # bit x (context) x prefix
    return stop_weight(stop, deeper), estimates[0], stop_weight(log_kt(*root), root_deeper), estimates[1]


def log10_bytes(keys: np.ndarray, bits: np.ndarray, top: tuple[np.ndarray, ...]) -> np.ndarray:
    """Log10 probability of the byte of each code, all depths mixed."""
    weight1, estimate1, weight0, estimate0 = top
    recent, byte = (keys >> np.uint64(8 * DEPTH)).astype(np.int64), (keys & np.uint64(255)).astype(np.int64)
    out = np.zeros(len(keys))
    for j in range(8):
        prefix, bit = (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1
        p = bits[:, j]
        p = weight1[recent, prefix] * estimate1[bit, recent, prefix] + (1 - weight1[recent, prefix]) * p
        p = weight0[prefix] * estimate0[bit, prefix] + (1 - weight0[prefix]) * p
        out += np.log10(p)
    return out


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
    "score double, n_bytes long, bits_per_byte double"
)


class _Lookup:
    """Sums of the logs of the codes of many documents, which are sorted together: neighbours are found one after another."""

    def __init__(self, codes: np.ndarray, logs: np.ndarray, documents: int):
        self._codes, self._logs, self.sums = codes, logs, np.zeros(documents)
        self._held: list[np.ndarray] = []
        self._size, self._first, self._last = 0, 0, 0

    def add(self, document: int, grams: np.ndarray) -> None:
        if document - self._first > 0xFFFF:
            self.flush()
        if not self._held:
            self._first = document
        # Six bytes of a code, and two for the document.
        self._held.append((grams << np.uint64(16)) | np.uint64(document - self._first))
        self._size, self._last = self._size + len(grams), document
        if self._size >= CHUNK:
            self.flush()

    def flush(self) -> None:
        if not self._held:
            return
        packed = np.sort(np.concatenate(self._held))
        codes = packed >> np.uint64(16)
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        found = self._logs[np.searchsorted(self._codes, codes[first])]
        values = np.repeat(found, np.diff(np.append(first, len(codes))))
        owner = (packed & np.uint64(0xFFFF)).astype(np.int64)
        sums = np.bincount(owner, values, self._last - self._first + 1)
        self.sums[self._first : self._last + 1] += sums
        self._held, self._size = [], 0


def _score(docs: pa.Table, known: pa.Table, train_tokens: int, vocabulary: int) -> pa.Table:
    kinds, keys, values = (known[n].to_numpy() for n in ("kind", "key", "value"))
    keys = keys.view(np.uint64)

    def sorted_part(kind):
        part = np.flatnonzero(kinds == kind)
        part = part[np.argsort(keys[part])]
        return keys[part], values[part]

    codes, logs = sorted_part(GRAM)
    hashes, counts = sorted_part(WORD)
    rates = np.log10((counts + 1) / (train_tokens + vocabulary + 1))
    number: dict[bytes, int] = {}
    rows: list[list] = [[], [], [], []]
    lookup = _Lookup(codes, logs, docs.num_rows)
    for document, (text,) in enumerate(_rows(docs, "text")):
        data = lowered(text)
        words = [*data.split(), b"\n"]  # the end is a token that no word can be
        if len(number) > CACHE_WORDS:
            number.clear()
        new = [w for w in set(words) if w not in number]
        if new:
            number.update(zip(new, np.searchsorted(hashes, _word_hashes(new)).tolist(), strict=True))
        at = np.fromiter((number[w] for w in words), np.int64, len(words))
        grams = gram_codes(data)
        for start in range(0, len(grams), CHUNK):
            lookup.add(document, grams[start : start + CHUNK])
        row = (len(words), int((counts[at] > 0).sum()), float(rates[at].sum()), len(grams))
        for column, value in zip(rows, row, strict=True):
            column.append(value)
    lookup.flush()
    scores, sizes = lookup.sums, np.array(rows[3], np.int64)
    n = docs.num_rows
    return pa.table(
        {
            "doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(rows[0], pa.int64()),
            "n_known": pa.array(rows[1], pa.int64()), "train_tokens": pa.array([train_tokens] * n, pa.int64()),
            "base_score": pa.array(rows[2], pa.float64()), "score": pa.array(scores), "n_bytes": pa.array(sizes),
            "bits_per_byte": pa.array(scores * -math.log2(10) / sizes),
        }
    )


def score(docs: DataFrame) -> DataFrame:
    """One row per document with the log10 probabilities of its whole text by a unigram and by the context trees.

    Learnt from documents whose CRC of the id, modulo 7, is not 2; those where it is are held
    out. A document without an id is scored, but neither learnt from nor held out. Null is the
    empty text, whose only symbol is its end. ``n_bytes`` counts the end, ``bits_per_byte`` is the code length by the
    trees over these. Texts are modelled
    with A-Z in lower case. Repeated rows are scored and learnt from as often as they occur.
    Columns other than doc_id and text are not looked at.
    """
    spark = docs.sparkSession
    rest = F.crc32(F.col("doc_id").cast("string")) % 7
    rows = docs.select(
        "doc_id", "text", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), F.coalesce(rest != 2, F.lit(False)).alias("learn")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", F.crc32(F.encode("text", "utf-8"))), F.lit(blocks)).alias("block")
    # More tasks than blocks, so that few tasks get two of them.
    rows = rows.select("*", block).repartition(TASKS * blocks, "block")

    found = rows.groupBy("block").applyInArrow(_collect, "block long, kind int, key long, n long")
    found = written(found, "contexts")
    sums = written(found.groupBy("kind", "key").agg(F.sum("n").alias("n")), "context-sums")
    words = sums.where(F.col("kind") == WORD)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("different")).first()

    grams = sums.where(F.col("kind") == GRAM).select("key", "n")
    context = F.shiftright("key", 8 * (DEPTH - TOP + 1))
    dealt = grams.repartition(context).sortWithinPartitions("key")
    trees = written(dealt.mapInArrow(_subtree_rows, _TREE), "trees")
    nodes = trees.where("key is null").groupBy("recent", "prefix")
    nodes = nodes.agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "log_weighted")))
    top = spark.sparkContext.broadcast(top_levels(nodes.toPandas()))

    def mix(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            bits = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, 8).astype(np.float64)
            logs = log10_bytes(keys.view(np.uint64), bits, top.value)
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(keys), GRAM, np.int32)), "key": batch.column(0), "value": pa.array(logs)})

    model = trees.where("key is not null").select("key", "bits").mapInArrow(mix, "kind int, key long, value double")
    model = model.union(words.select("kind", "key", F.col("n").cast("double")))
    known = found.select("block", "kind", "key").join(model, ["kind", "key"]).repartition(TASKS * blocks, "block")

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score(left, right, total.n, total.different)

    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(scored, _SCORED)
