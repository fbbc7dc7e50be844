"""Language identification: held-out accuracy, spans, and Viterbi against plain Python."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from siftline.llm import langid
from siftline.llm.langid import Labeller

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return langid.fit(langid.train_rows(docs))


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in contract.queries()["op4_language"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        assert rows[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1)
        assert 0 <= rows[d.doc_id].score <= 1
    unseen = [d for d in docs if rows[d.doc_id].held_out and d.lang and len(d.text or "") > 40]
    assert np.mean([rows[d.doc_id].lang_pred == d.lang for d in unseen]) > 0.97


def plain_path(scores, penalty):
    best, came = scores[0].astype(float), []
    for s in scores[1:]:
        top = int(best.argmax())
        back = [k if best[k] >= best[top] - penalty else top for k in range(len(best))]
        came.append(back)
        best = np.maximum(best, best[top] - penalty) + s
    state = int(best.argmax())
    path = [state]
    for back in reversed(came):
        state = back[state]
        path.append(state)
    return path[::-1]


def test_walk_equals_plain_viterbi(spark, model):
    docs = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40).collect()]
    mixed = [a[:300] + " " + b[:300] for a, b in zip(docs, docs[1:], strict=False)] + ["", "...", "one"]
    labeller = Labeller(model)
    for text, spans in zip(mixed, labeller.label(mixed), strict=True):
        words = langid.words_of(text)
        if not words:
            assert spans == []
            continue
        scores = labeller._scores[[labeller._known[w] for w in words]]
        path = plain_path(scores, langid.SWITCH_PENALTY)
        assert [k for _, n, _, k in spans for _ in range(n)] == path
        assert sum(s[2] for s in spans) == sum(map(len, words))


def test_mixed_text_has_a_span_per_language(spark, model):
    docs = {r.lang: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect() if len(r.text) > 1000}
    text = docs["en"][:800] + " " + docs["fr"][:500]
    row = langid.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert {s.lang for s in row.spans} == {"en", "fr"}
    assert row.lang_pred == "en" and 0.5 < row.score < 0.75


def test_edge_rows(spark, model):
    docs = spark.createDataFrame(
        [(1, None, 0.1), (2, "", 0.1), (3, "123 ... ½ ²", 0.1), (None, "the and of that", 0.1), (4, "Привет", 0.1), (4, "Привет", 0.1)],
        "doc_id long, text string, score double",
    )
    rows = langid.identify(docs, model).collect()
    assert [(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3)] == [("und", 0.0)] * 3
    assert [r.lang_pred for r in rows if r.doc_id is None] == ["en"]
    assert len(rows) == 6 and all(r.lang_pred in model.langs for r in rows if r.doc_id == 4)
    assert langid.kept_rows(docs, model).columns == docs.columns
    assert langid.identify(docs.limit(0), model).count() == 0


def test_nothing_learnt(spark):
    none = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = langid.fit(none)
    assert langid.identify(none, model).first().lang_pred == "und"


def test_scripts():
    names = [langid.SCRIPT_NAMES[langid.script_of(w)] for w in ("word", "Ünï", "слово", "語", "ひ", "한", "ᚠ")]
    assert names == ["latin", "latin", "cyrillic", "han", "kana", "hangul", "other"]


def test_a_script_of_no_language_is_no_evidence(spark, model):
    docs = spark.createDataFrame([(1, "Привет мир"), (2, "語 文字"), (3, "the and of that"), (4, "the and Привет мир всем")], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert [found[d][1] for d in (1, 2, 3)] == [0.0, 0.0, 1.0] and found[4][1] == pytest.approx(6 / 19)
    assert all(lang in model.langs for lang, _ in found.values())
    assert [r.doc_id for r in langid.kept_rows(docs, model).collect()] == [3]
