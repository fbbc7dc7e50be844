"""Screening by word list: every form must give the same answer."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftline.operators import classify as c
from siftline.operators.lexicon import words_table
from siftline.sources.local import messages

THREE = ["crate", "old brick", "muddy"]

CASES = [
    ("somebody left a crate outside", THREE, True),
    ("SOMEBODY LEFT A CRATE OUTSIDE", THREE, True),
    ("Somebody left a CrAtE outside", THREE, True),
    ("somebody left a crate outside", ["CRATE", "MUDDY"], True),
    ("the concrateful of it", ["crate"], True),
    ("crated, recrated, uncrate", ["crate"], True),
    ("muddy boots beside an Old Brick and a crate", THREE, True),
    ("%&/ crate (=)", ["crate"], True),
    ("语言 crate ñandú", ["crate"], True),
    ("Nothing of note in this line. " * 1000 + "crate", ["crate"], True),
    ("Nothing of note in this line", THREE, False),
    (None, THREE, False),
    ("", THREE, False),
    ("  ", THREE, False),
    ("\t", THREE, False),
    ("\n", THREE, False),
    ("\n \t", THREE, False),
    ("somebody left a crate outside", [], False),
    ("nothing ~ here + at $ all", THREE, False),
    ("a stray blank never matches", ["", " \t"], False),
    ("an old brick wall", ["old brick"], True),
    ("one.two", ["one.two"], True),
    ("oneXtwo", ["one.two"], False),
    ("here is one letter q", ["q", "much longer words beside it"], True),
    ("none of that letter", ["q", "much longer words beside it"], False),
    ("spaces around are not part of it", ["  Around ", None], True),
]


@pytest.mark.parametrize("words", sorted({tuple(case[1]) for case in CASES}, key=str))
def test_cases(spark, words):
    cases = [case for case in CASES if tuple(case[1]) == words]
    rows = messages(
        spark, [{"message_id": str(i), "message_body": body} for i, (body, _, _) in enumerate(cases)]
    )
    expected = {str(i): "PROFANITY" if bad else "SAFE" for i, (_, _, bad) in enumerate(cases)}
    table = spark.createDataFrame([(w,) for w in words], "word string")
    forms = (c.classify(rows, list(words)), c.classify(rows, table), c.classify_by_join(rows, table, broadcast_rows=0))
    for tagged in forms:
        assert {r.message_id: r.profanity_type for r in tagged.collect()} == expected


def test_incoming_tag_is_ignored(spark):
    rows = messages(spark, [{"message_body": "hello", "profanity_type": "PROFANITY"}])
    assert c.classify(rows, ["gun"]).first().profanity_type == "SAFE"


def _brute(bodies, words):
    return [any(w in body.lower() for w in words) for body in bodies]


@pytest.mark.parametrize("seed", range(3))
def test_all_forms_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choices("ab é.", k=rng.randint(1, 9))).strip() for _ in range(120)} - {""}
    words = {w for w in words if len(w) > 4}
    words |= {"ab" * 20 + "é" * n for n in range(9)}
    bodies = ["".join(rng.choices("abAB é.", k=rng.randint(0, 60))) for _ in range(300)]
    expected = _brute(bodies, words)
    assert len(words) > c.CHAIN_MAX_WORDS and 0 < sum(expected) < len(bodies)
    rows = messages(
        spark, [{"message_id": str(i), "message_body": b} for i, b in enumerate(bodies)]
    )
    table = words_table(spark, words)
    for found in (c.classify(rows, words), c.classify(rows, table), c.classify_by_join(rows, table, 0)):
        tagged = {r.message_id: r.profanity_type for r in found.collect()}
        assert [tagged[str(i)] == "PROFANITY" for i in range(len(bodies))] == expected


def test_special_characters_in_a_long_list(spark):
    special = ["a[b]", "^caret", "x&&y", "a-z", "back\\slash", "{1}", "p|q", "q?", "🚀go", "$5", "#tag", "\"'", "é~"]
    words = special + [f"{c}filler" for c in "bcdefghijklmnoqrstuvwyz0123456789"]
    assert len(words) > c.CHAIN_MAX_WORDS
    near = ["a[b", "caret", "x&y", "amz", "backslash", "1", "p", "🚀", "tag", "e~"]
    rows = messages(
        spark,
        [{"message_id": w, "message_body": f"…{w.upper()}…"} for w in words]
        + [{"message_id": "no", "message_body": w} for w in near],
    )
    tagged = c.classify(rows, words)
    assert tagged.where("profanity_type = 'PROFANITY'").count() == len(words)
    assert tagged.where("message_id = 'no' AND profanity_type = 'SAFE'").count() == len(near)


def test_join_form_checks_the_end_of_long_words(spark):
    long_word = "x" * 60 + "tail" * 10
    rows = messages(
        spark,
        [
            {"message_id": "whole", "message_body": "… " + long_word.upper()},
            {"message_id": "start", "message_body": long_word[:-1]},
            {"message_id": "short", "message_body": "a gun"},
        ],
    )
    tagged = c.classify_by_join(rows, words_table(spark, [long_word, "gun"]))
    assert {r.message_id: r.profanity_type for r in tagged.collect()} == {
        "whole": "PROFANITY",
        "start": "SAFE",
        "short": "PROFANITY",
    }


def test_join_form_finds_words_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(c, "PIECE_CHARS", 10)
    word = "0123456789abcdefghijklm"
    rows = messages(spark, [{"message_id": str(i), "message_body": "." * i + word + "." * 30} for i in range(40)])
    near = messages(spark, [{"message_id": "n", "message_body": word[:-1] + "." * 60}])
    tagged = c.classify_by_join(rows.union(near), words_table(spark, [word, "zzz"]))
    assert tagged.where("profanity_type = 'PROFANITY'").count() == 40


def test_join_form_counts_characters_not_code_units(spark):
    rows = messages(spark, [{"message_id": "hit", "message_body": "🚀🚀 x🚀 a longword🚀 here"}, {"message_id": "no", "message_body": "🚀🚀🚀 longwor🚀d"}])
    for rows_sent in (0, 10):
        tagged = c.classify_by_join(rows, words_table(spark, ["a longword🚀", "zz top"]), broadcast_rows=rows_sent)
        assert {r.message_id: r.profanity_type for r in tagged.collect()} == {"hit": "PROFANITY", "no": "SAFE"}


def test_join_form_with_more_short_words_than_a_chain(spark):
    words = [chr(0x4E00 + i) for i in range(40)] + [f"{chr(0x5000 + i)}x" for i in range(40)] + ["abcd", "0123456789" * 30]
    bodies = ["… " + words[7], "… " + words[45], "ABCD", "abc", "0123456789" * 30, "0123456789" * 29 + "012345678", chr(0x5001), ""]
    rows = messages(spark, [{"message_id": str(i), "message_body": b} for i, b in enumerate(bodies)])
    found = c.classify_by_join(rows, words_table(spark, words)).where("profanity_type = 'PROFANITY'")
    assert sorted(r.message_id for r in found.collect()) == ["0", "1", "2", "4"]


def test_words_are_found_by_their_rarest_part(spark):
    texts = spark.createDataFrame([(i, f"common part {i % 7} here") for i in range(50)] + [(99, "common xylophone")], "key int, text string")
    words = words_table(spark, ["common xylophone", "common part", "common never"])
    parts = {r.word: (r.gram, r.offset) for r in c.rarest_parts(words, texts, [6]).collect()}
    # A word with a part that is nowhere is dropped before any text is searched for it.
    assert set(parts) == {"common xylophone", "common part"}
    assert parts["common xylophone"][1] >= 2 and parts["common part"][0] != "common"


def test_counts_of_parts_are_those_of_every_place(spark, monkeypatch):
    monkeypatch.setattr(c, "PIECE_CHARS", 7)
    rng = random.Random(4)
    bodies = ["".join(rng.choices("abé🚀", k=rng.randint(0, 40))) for _ in range(200)]
    texts = spark.createDataFrame(list(enumerate(bodies)), "key int, text string").repartition(3)
    for width in (2, 6):
        held = [{body[k : k + width] for k in range(len(body) - width + 1)} for body in bodies]
        grams = sorted(set().union(*held))[::2]
        known = c.bloom_filter(spark.createDataFrame([(g,) for g in grams], "gram string"))
        found = c._part_counts(texts, known, [width])
        counts = {r.gram: r.n for r in found.collect()}
        assert {g: counts.get(g) for g in grams} == {g: sum(g in h for h in held) for g in grams}
        places = c._part_places(texts, known, [width], width + 2).where(F.col("gram").isin(grams)).collect()
        expected = [
            (i, body[k : k + width], min(k, width + 1), body[max(0, k - width - 1) :][: 2 * width + 4])
            for i, body in enumerate(bodies) for k in range(len(body) - width + 1) if body[k : k + width] in set(grams)
        ]
        assert sorted(map(tuple, places)) == sorted(expected)


def test_places_of_texts_are_not_expanded_in_expressions(spark):
    texts = spark.createDataFrame([(1, "common part")], "key int, text string")
    plan = c.rarest_parts(words_table(spark, ["common part"]), texts, [6])._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract_all(text" not in plan


def test_bloom_filter_lets_its_members_and_few_others_through(spark):
    grams = spark.range(3000).selectExpr("concat('g', id) AS gram")
    holds = c.bloom_filter(grams)
    checked = grams.unionByName(spark.range(100_000).selectExpr("concat('x', id) AS gram")).select("gram", holds(F.col("gram")).alias("in"))
    assert checked.where("gram like 'g%' and in").count() == 3000
    assert checked.where("gram like 'x%' and in").count() < 5000
    assert spark.range(1).select(c.bloom_filter(grams.limit(0))(F.lit("a")).alias("in")).first()[0] is False


def test_join_form_leaves_messages_in_place_when_few_are_flagged(spark):
    rows = spark.range(1000).selectExpr("cast(id as string) AS message_id", "concat('text ', id) AS message_body")
    tagged = c.classify_by_join(rows, words_table(spark, ["text 77"]))
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_join_form_without_broadcast(spark):
    rows = messages(
        spark,
        [{"message_id": str(i), "message_body": "same begun text" if i % 2 else f"clean {i}"} for i in range(40)],
    )
    tagged = c.classify_by_join(rows, words_table(spark, ["gun", "other"]), broadcast_rows=0)
    assert tagged.where("profanity_type = 'PROFANITY'").count() == 20
    assert tagged.count() == 40


def test_join_form_splits_a_text_with_many_copies(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.range(0, 6000, 1, 8).selectExpr(
            "sha2(cast(id as string), 512) AS account_id",
            "cast(id as string) AS message_id",
            "if(id % 3 = 0, 'the same gun text', concat('clean ', sha2(cast(id as string), 512))) AS message_body",
        )
        tagged = c.classify_by_join(rows, words_table(spark, ["gun", "zebra"]), broadcast_rows=0)
        found = tagged.collect()
        assert sum(r.profanity_type == "PROFANITY" for r in found) == 2000
        assert len(found) == 6000
        assert "skew=true" in tagged._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_short_list_stays_in_codegen(spark):
    plan = c.classify(messages(spark, []), ["gun", "bad"])._jdf.queryExecution().executedPlan().toString()
    assert "Contains(lower(" in plan and "Exchange" not in plan


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.sets(st.text("abc.+", min_size=1, max_size=6), min_size=1, max_size=40),
    st.text("abc.+ ", max_size=30),
)
def test_alternation_finds_what_a_scan_finds(words, text):
    assert bool(re.search(c.alternation(words), text)) == any(w in text for w in words)


def test_profane_only(spark):
    rows = messages(spark, [{"message_body": "gun"}, {"message_body": "hi"}, {"message_body": None}])
    kept = c.profane_only(c.classify(rows, ["gun"]))
    assert [r.message_body for r in kept.collect()] == ["gun"]


def test_half_and_half(spark):
    rows = messages(
        spark,
        [{"message_id": str(i), "message_body": "a gun" if i % 2 else "fine"} for i in range(100)],
    ).repartition(2)
    counts = c.classify(rows, ["gun"]).groupBy("profanity_type").agg(F.count("*").alias("n"))
    assert {r.profanity_type: r.n for r in counts.collect()} == {"PROFANITY": 50, "SAFE": 50}


def test_order_is_kept_in_one_partition(spark):
    rows = messages(spark, [{"message_id": f"{i:03}", "message_body": "x"} for i in range(50)]).coalesce(1)
    ids = [r.message_id for r in c.classify(rows, ["gun"]).collect()]
    assert ids == sorted(ids)
