"""Packing: tokens against the library, every id in exactly one piece, full windows."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as contract
from siftline.llm import packing
from siftline.llm.packing import Bm25Shard, WordTokens, fill_windows

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


WORDS = WordTokens(PATH, None, cache_words=50)


@pytest.mark.parametrize(
    "text",
    [
        "", "  ", "It's  WE'LL\n\nno\tend", "É́tude ﬁ Ａｂ１２３", "a\x1cb c\x85d\xa0e", "日本語 の テキスト",
        "<|endoftext|> x", "x" * 500, " ́a ́b 　", "İSTANBUL Σίσυφος ΣΑΣ",
    ],
)
def test_word_wise_ids_equal_the_whole_text(whole, text):
    assert np.frombuffer(WORDS.encode(text), WORDS.dtype).tolist() == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é́'1.\n\t \x1c\x85 !語ŉΣ"), max_size=60))
def test_any_text_gives_the_same_ids(text):
    tokenizer = test_any_text_gives_the_same_ids.tokenizer
    assert np.frombuffer(WORDS.encode(text), WORDS.dtype).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


test_any_text_gives_the_same_ids.tokenizer = Tokenizer.from_file(PATH)
test_any_text_gives_the_same_ids.tokenizer.encode_special_tokens = True


def test_a_column_is_encoded_by_its_distinct_words(whole, monkeypatch):
    tokens = WordTokens(PATH, 1, cache_words=4)
    sent, encode = [], tokens._together
    monkeypatch.setattr(tokens, "_together", lambda units: sent.extend(units) or encode(units))
    column = pa.array(["One two, TWO. one", None, "it's, one... ΣΑΣ Σας two!", "", "É́a e\u0301a éa; İx ix <|endoftext|>", "a.b, two"] * 50)
    for part in (column, column.slice(3, 7), column.slice(0, 0)):
        found = [np.frombuffer(data, tokens.dtype).tolist() for data in tokens.encode_column(part).to_pylist()]
        assert found == [[*whole(text or ""), 1] for text in part.to_pylist()]
    assert sent.count("two") == 1 and sent.count("one") == 1 and "two," not in sent


def check_pieces(rows, ids_of, window=2048):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == ids_of.keys()
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids_of[doc])
            assert r.ids_crc32 == zlib.crc32(np.array(ids_of[doc][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids_of[doc])
    used = padded = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        used, padded = used + at, padded + (at if at & (at - 1) == 0 else window)
    assert padded == used


def test_query_packs_every_token_once(spark, whole):
    rows = contract.queries()["op8_packing"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    check_pieces(rows, {r.doc_id: [*whole(r.text or ""), 1] for r in docs})


def test_edge_rows(spark, whole):
    long = "word " * 5000
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (3, long, 5), (4, "same text", 5), (5, "same text", 5)],
        "doc_id long, text string, length int",
    )
    rows = packing.pack(docs, PATH).collect()
    check_pieces(rows, {r.doc_id: [*whole(r.text or ""), 1] for r in docs.collect()})
    repeated = spark.createDataFrame([(None, "x y"), (7, "z"), (7, "z")], "doc_id long, text string")
    rows = packing.pack(repeated, PATH).collect()
    assert sum(r.length for r in rows) == 7 and sum(r.length for r in rows if r.doc_id is None) == 3
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_scores_equal_plain_bm25():
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 12, rng.integers(1, 30)) for _ in range(20)]
    df = np.array([sum(t in x for x in ids) for t in range(12)])
    idf = np.log1p((20 - df + 0.5) / (df + 0.5))
    mean = sum(map(len, ids)) / 20
    index = Bm25Shard(ids, idf, mean)
    for query in range(20):
        expected = []
        for x in ids:
            norm = packing.K1 * (1 - packing.B + packing.B * len(x) / mean)
            tf = [int((x == t).sum()) for t in np.unique(ids[query])]
            parts = zip(tf, idf[np.unique(ids[query])], strict=True)
            expected.append(sum(w * f * (packing.K1 + 1) / (f + norm) for f, w in parts))
        assert index.scores(query) == pytest.approx(expected)


def test_neighbours_fill_the_window_of_their_seed():
    scores = {0: [9, 0, 5, 0], 1: [0, 9, 0, 5]}
    sequences = fill_windows([3, 3, 5, 5], lambda d: np.array(scores.get(d, [0] * 4), float), 8)
    assert sequences == [[(0, 0, 3), (2, 0, 5)], [(1, 0, 3), (3, 0, 5)]]


def topics(spark, per_topic, count):
    """Documents of ``count`` topics in files of their own: no two of a topic are near each other."""
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(40 * count)]
    rows = [(k * count + t, " ".join(rng.permutation(words[40 * t : 40 * t + 40]).tolist() * 3)) for k in range(per_topic) for t in range(count)]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, per_topic), "doc_id long, text string"), rows


@pytest.mark.parametrize("shard_tokens", [1 << 20, 1000])
def test_neighbours_in_other_files_share_a_window(spark, whole, monkeypatch, shard_tokens):
    monkeypatch.setattr(packing, "SHARD_TOKENS", shard_tokens)
    docs, rows = topics(spark, 4, 10)
    ids = {d: [*whole(text), 1] for d, text in rows}
    window = min(map(len, ids.values())) * 2
    packed = packing.pack(docs, PATH, window=window).collect()
    check_pieces(packed, ids, window)
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    # While a topic has documents left, what stands behind a whole seed is of its topic.
    seeded = [sorted(p, key=lambda r: r.offset)[:2] for p in by_sequence.values()]
    fresh = [(a.doc_id % 10, b.doc_id % 10) for a, b in (p for p in seeded if len(p) == 2) if a.length == a.doc_tokens]
    # By chance one in ten would be; a shard may end, or a topic be used up, behind a seed.
    assert len(fresh) >= 5 and sum(a == b for a, b in fresh) >= 0.8 * len(fresh)


def test_keys_are_shared_in_proportion_to_the_overlap():
    rng = np.random.default_rng(8)
    idf, key = rng.random(3000) + 0.2, None
    key = packing.Keys(idf, 100.0)
    same, half, other = 0, 0, 0
    for _ in range(300):
        terms = rng.permutation(3000)
        base, near, far = terms[:100], np.r_[terms[:67], terms[100:133]], terms[1000:1100]
        ids = [np.sort(x) for x in (base, rng.permutation(base), near, far)]
        docs, found, tf = packing.terms_by_document(ids)
        h = key.of(4, docs, found, tf, np.full(4, 100))
        same, half, other = same + (h[:, 0] == h[:, 1]).sum(), half + (h[:, 0] == h[:, 2]).sum(), other + (h[:, 0] == h[:, 3]).sum()
    assert same == 900 and other == 0 and 0.38 < half / 900 < 0.62  # 67 of 133 terms are shared


def test_counts_of_one_pass_are_those_of_the_documents(spark, whole):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    tokens = packing.word_tokens(PATH, 1)
    tokenized = packing.tokenize(docs, PATH, 1, packing.sampled_weights(docs, tokens)).persist()
    counts, total, size = packing.term_counts(tokenized, tokens.vocabulary)
    ids = [[*whole(r.text or ""), 1] for r in docs.collect()]
    expected = np.zeros(tokens.vocabulary, np.int64)
    for x in ids:
        expected[np.unique(x)] += 1
    assert counts.tolist() == expected.tolist() and (total, size) == (len(ids), sum(map(len, ids)))


def test_hashes_are_weighted_by_all_documents(spark, whole, monkeypatch):
    rows = [(i, f"alpha w{i % 3}") for i in range(5000)] + [(9000 + i, "beta gamma") for i in range(3000)]
    docs, seen, made = spark.createDataFrame(rows, "doc_id long, text string"), [], packing.keyed
    monkeypatch.setattr(packing, "keyed", lambda tokenized, dtype, weights: seen.append(weights) or made(tokenized, dtype, weights))
    packing.pack(docs, PATH)
    ids = [[*whole(text), 1] for _, text in rows]
    counts = np.zeros(packing.word_tokens(PATH, 1).vocabulary)
    for x in ids:
        counts[np.unique(x)] += 1
    idf, mean_tokens = seen[0]
    assert idf == pytest.approx(packing.inverse_frequencies(counts, len(ids))) and mean_tokens == sum(map(len, ids)) / len(ids)


def test_hot_keys_are_spread(spark, whole, monkeypatch):
    monkeypatch.setattr(packing, "SPREAD_TOKENS", 500)
    monkeypatch.setattr(packing, "HOT_TOKENS", 1000)
    monkeypatch.setattr(packing, "SHARD_TOKENS", 700)
    rows = [(i, "one text that many documents share, word by word") for i in range(400)] + [(1000 + i, f"word{i} of its own") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    tokens = packing.word_tokens(PATH, 1)
    tokenized = packing.tokenize(docs, PATH, 1, packing.sampled_weights(docs, tokens)).withColumn("place", packing.F.monotonically_increasing_id())
    held = packing.dealt(packing.written(tokenized, "test-tokens")).groupBy(packing.F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 450 and max(r["count"] for r in held) < 300
    check_pieces(packing.pack(docs, PATH).collect(), {d: [*whole(t), 1] for d, t in rows})


def test_windows_of_a_shard_are_those_of_plain_greedy_filling():
    rng = np.random.default_rng(9)
    ids = [rng.integers(0, 40, rng.integers(1, 50)) for _ in range(60)]
    df = np.array([sum(t in x for x in ids) for t in range(40)])
    index = Bm25Shard(ids, packing.inverse_frequencies(df, 60), 25.0)
    unused, plain, window = list(range(60)), [], 64
    left = [len(x) for x in ids]
    pending = None
    while unused or pending is not None:
        seed = pending if pending is not None else unused.pop(0)
        pending, taken, room = None, [], window
        order = [seed]
        while order and room:
            doc = order.pop(0)
            size = min(room, left[doc])
            taken.append((doc, len(ids[doc]) - left[doc], size))
            left[doc], room = left[doc] - size, room - size
            if left[doc]:
                pending = doc
            elif room and len(taken) == 1:
                scores = index.scores(seed)
                order = sorted(unused, key=lambda d: (-scores[d], d))
            if order and room:
                unused.remove(order[0])
        plain.append(taken)
    made = fill_windows([len(x) for x in ids], index.scores, window)
    assert made[: len(plain) - 1] == plain[:-1]
    assert [p for s in made[len(plain) - 1 :] for p in s if p[2]] and sum(p[2] for s in made for p in s) == sum(map(len, ids))
