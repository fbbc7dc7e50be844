"""Repetition rules against plain Python over whole texts."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from siftline.llm import quality
from siftline.llm.quality import Limits, measure

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def inside(words, n):
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    counts = Counter(windows)
    return {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(n)}


def brute(text, limits=Limits()):
    words = WORD.findall(text)
    lines, dups, dup_chars = [], 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in lines:
                dups += 1
                dup_chars += sum(map(len, WORD.findall(line)))
            lines.append(line)
    chars = sum(map(len, words))
    repeats = len(inside(words, 3))
    shares = {n: sum(len(words[i]) for i in inside(words, n)) / chars if chars else 0 for n in limits.ngrams}
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    fine = all(shares[n] <= most for n, most in limits.ngrams.items()) and dup_chars <= limits.line_chars * chars
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), chars, symbols, dups, repeats, list(shares.values()), failed, fine and not failed


def plain(measured):
    return (*measured[:5], *measured[5], *measured[7:])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab c\n#\x0b "), max_size=150))
def test_equal_to_plain_python(text):
    expected = brute(text)
    assert plain(measure(text, Limits())) == pytest.approx((*expected[:5], *expected[5], *expected[6:]))


def test_query_matches_plain_python(spark):
    rows = {r.doc_id: r for r in contract.queries()["op5_repetition"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        row, expected = rows[doc.doc_id], brute(doc.text or "")
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == expected[:5]
        assert (row.base_failed, row.kept) == expected[6:]


def test_repetition_is_caught_and_prose_stays():
    prose = " ".join(f"w{i * 37 % 1009}" for i in range(300))
    assert measure(prose, Limits())[-1]
    assert not measure("\n".join([" ".join(f"w{i}" for i in range(12))] * 9), Limits())[-1]
    assert not measure(prose + " " + " ".join(["one two three four five six"] * 40), Limits())[-1]


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (None, "a " * 60, 1), (3, "x", 2), (3, "x", 2)], "doc_id long, text string, kept int"
    )
    rows = quality.rate(docs).collect()
    assert len(rows) == 5 and not any(r.kept for r in rows)
    assert [r.n_words for r in rows if r.doc_id in (1, 2)] == [0, 0]
    assert quality.kept_rows(docs).columns == docs.columns
    assert quality.rate(docs.limit(0)).count() == 0


def test_sizes_below_three_do_not_need_a_repeated_triple():
    text = "a b x1 a b x2 a b x3 a b x4"  # no three words repeat
    limits = Limits(ngrams={1: 0.5, 2: 0.4}, min_words=1)
    shares, kept = measure(text, limits)[5], measure(text, limits)[-1]
    assert shares == [8 / 16, 8 / 16] and not kept
