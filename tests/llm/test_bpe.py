"""Byte-level BPE against the library on whole texts, and exact round trips."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from siftline.llm import bpe
from siftline.llm.bpe import TreeBpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


SMALL = TreeBpe(RANKS, PATTERN, leaf_chars=7, leaf_bytes=5)
NORMAL = TreeBpe(RANKS, PATTERN)
CASES = [
    "",
    "a",
    "it's we'll 'tis they'rexyz don''t o'clock 's's'd",
    "   many    blanks \n\n\t x \r\n   ",
    "x" * 3000,
    "ab" * 900 + " tail",
    "\n" * 700 + "end",
    " " * 900,
    "日本語のテキスト、漢字。" * 60,
    "a1b2c3" * 100 + "''''''" * 30 + "'s" * 50,
    "emoji 🚀🚀🚀 ́combining \x1c\x1d\x85 controls   nbsp",
    "<|endoftext|> stays text",
    "thé quick 123456789 brown-fox!!! ...",
]


@pytest.mark.parametrize("text", CASES)
def test_equal_to_whole_text(whole, text):
    expected = whole.encode_ordinary(text)
    for tree in (SMALL, NORMAL):
        ids = tree.encode(text)
        assert ids.tolist() == expected
        assert tree.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aab e'sré12 \n\t.-!語'ĺ\x1c"), max_size=120))
def test_any_cut_gives_the_same_tokens(text):
    assert SMALL.encode(text).tolist() == NORMAL.encode(text).tolist()


def test_long_unbroken_text_joins_by_token_pairs(whole):
    text = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(6000))
    tree = TreeBpe(RANKS, PATTERN, leaf_chars=64, leaf_bytes=32)
    assert tree.encode(text).tolist() == whole.encode_ordinary(text)


def test_query_matches_whole_encoding(spark, whole):
    rows = contract.queries()["op10_byte_bpe"](spark, SF_DIR).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for row in rows:
        ids = whole.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (None, "the", "z"), (3, "hi", None), (3, "hi", None)],
        "doc_id long, text string, ids string",
    )
    rows = bpe.digests(bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 0, 1, 1, 1]  # "hi" and "the" are tokens
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.ids_sha256, r.decoded_sha256) for r in rows if not r.n_tokens] == [(empty, empty)] * 2
    assert bpe.digests(bpe.decode(bpe.encode(docs.limit(0), RANKS, PATTERN), RANKS, PATTERN)).count() == 0
