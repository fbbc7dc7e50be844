"""Personal data: the patterns against plain regular expressions, the field against brute force and held-out rows."""

import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from siftline.llm import pii, pii_samples

SF_DIR = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], pii.ORDER[s[1]]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("a.b@-1234 5+()6\n%é9"), max_size=60))
def test_patterns_equal_plain_regular_expressions(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", ["4111 1111 1111 1111", "x 4111-1111-1111-1111, 10.0.0.256 10.0.0.255 1.2.3.4.5.6.7.8", "+1 (017) 555-7713", "a@b@c.de@f.g"])
def test_patterns_on_real_shapes(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    long = "1" * 300_000 + " " + "1." * 100_000 + "a" * 300_000 + "@" + "b" * 300_000 + "+1" + " " * 300_000
    begin = time.perf_counter()
    assert [s[1] for s in pii.base_spans(long)] == ["ip"] * 25_000
    assert time.perf_counter() - begin < 10


def plain_words(text):
    out, at = [], 0
    while at < len(text):
        kind = lambda c: 0 if c in " \t\x0b\x0c\r" else 1 if c.isalnum() or "̀" <= c <= "ͯ" else 3 if c == "\n" else 2
        end = at + 1
        if kind(text[at]) == 1:
            while end < len(text) and kind(text[end]) == 1:
                end += 1
        elif kind(text[at]) == 2:
            while end < len(text) and text[end] == text[at]:
                end += 1
        if kind(text[at]):
            out.append((at, end))
        at = end
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB1é .,=\n\t*字"), max_size=40))
def test_words(text):
    words = pii.words_of(text)
    assert list(zip(words.starts.tolist(), words.ends.tolist(), strict=True)) == plain_words(text)
    assert (words.shapes < pii.SHAPES).all() and (words.shapes >= 0).all()


@pytest.fixture(scope="module")
def field():
    return pii.trained(pii_samples.rows(1200, 7))


def random_field(seed):
    draw = np.random.default_rng(seed)
    k = len(pii.LABELS)
    shapes = draw.normal(0, 0.7, (len(pii.AROUND), pii.SHAPES, k))
    return pii.Field(shapes, draw.normal(0, 0.7, (len(pii.AROUND), len(pii.CUES) + 1, k)), draw.normal(0, 1.0, (k, k)))


@pytest.mark.parametrize("seed", range(12))
def test_best_path_equals_all_paths(seed):
    field = random_field(seed)
    for text in ("aB 1 = x", "token 12-34", "a\nb 7", "x"):
        words = pii.words_of(text)
        emissions = field.emissions(words)
        paths = itertools.product(range(len(pii.LABELS)), repeat=len(words.starts))
        score = lambda p: sum(emissions[i, y] for i, y in enumerate(p)) + sum(field.pairs[a, b] for a, b in itertools.pairwise(p))
        assert tuple(field.labels(words)[0].tolist()) == max(paths, key=score)


@pytest.mark.parametrize("which", ["trained", 3, 4])
def test_cut_sequences_equal_one_viterbi(field, which):
    field = field if which == "trained" else random_field(which)
    for text, _ in pii_samples.rows(150, 5):
        words = pii.words_of(text + "\n" + text + " " + text)
        whole = pii.viterbi(field.emissions(words)[None], field.pairs, np.array([False]), np.array([False]))[0]
        assert field.labels(words)[0].tolist() == whole.tolist()


def test_held_out_rows_are_found(field):
    right = found = true = 0
    for text, expected in pii_samples.rows(1500, 99):
        got = {(kind, a, b) for a, kind, b in pii.field_spans(text, field)}
        right, found, true = right + len(got & set(expected)), found + len(got), true + len(expected)
    assert right / found > 0.97 and right / true > 0.97


def test_long_texts_in_pieces_equal_one_piece(field, monkeypatch):
    text = " ".join(t for t, _ in pii_samples.rows(400, 11)) + "\n" + "7-" * 500
    whole = pii.field_spans(text, field)
    for size in (64, 300, 5000):
        monkeypatch.setattr(pii, "PIECE", size)
        assert pii.field_spans(text, field) == whole
    assert len(whole) > 100


def test_query_matches_plain_python(spark):
    rows = {r.doc_id: r for r in contract.queries()["op12_pii"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(rows) == len(docs)
    secrets = 0
    for doc in docs:
        text = doc.text or ""
        base = plain_spans(text)
        row, joined = rows[doc.doc_id], [f"{k}:{a}:{b}" for a, k, b in base]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in base) for k in PLAIN]
        assert row.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        spans = row.spans.split(",") if row.spans else []
        assert set(joined) <= set(spans)
        planted = {f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer(r'token = "([0-9a-f]{40})"', text)}
        assert set(spans) - set(joined) == planted
        secrets += len(planted)
    assert secrets > 0


def test_edge_rows(spark, field):
    schema = "doc_id long, text string, spans int, n_ip string"
    rows = [(1, None, 1, "a"), (2, "", 1, "a"), (None, "a@b.co 1.2.3.4", 1, "a"), (3, "\n \n", 1, "a"), (4, "𝒳 x@y.zz 😀", 1, "a"), (4, "𝒳 x@y.zz 😀", 1, "a")]
    docs = spark.createDataFrame(rows, schema)
    found = sorted(pii.find(docs, field).collect(), key=lambda r: (r.doc_id or 0, r.spans))
    assert [r.spans for r in found] == ["email:0:6,ip:7:14", "", "", "", "email:2:8", "email:2:8"]
    assert found[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find(docs.limit(0), field).count() == 0
    nothing = pii.fit(spark.createDataFrame([(None, None)], "text string, spans array<struct<kind: string, start: int, end: int>>"))
    assert [r.spans for r in pii.find(docs.where("doc_id = 4"), nothing).collect()] == ["email:2:8"] * 2
    assert pii.find(docs, pii.fit(pii.labelled(spark).limit(0))).count() == 6


def test_unknown_kinds_and_null_spans_are_not_learnt(spark):
    rows = [("x token 1", [("other", 0, 1)]), (None, None), ('token = "aaaa1111bbbb2222"', [("secret", 9, 25)])]
    field = pii.fit(spark.createDataFrame(rows, "text string, spans array<struct<kind: string, start: int, end: int>>"))
    assert pii.field_spans('token = "cccc1111dddd2222"', field) == [(9, "secret", 25)]
