import os

import pytest

from siftline.operators import lexicon


def _words(df):
    return sorted(r.word for r in df.collect())


def test_lines_are_trimmed_lowered_and_distinct(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("  Gun \n\ngun\n\tbad\t\n   \nhate speech\r\nüBEL\n", encoding="utf-8")
    assert _words(lexicon.read_words(spark, str(path))) == ["bad", "gun", "hate speech", "übel"]


def test_default_list(spark):
    assert lexicon.load_words(spark) == sorted(lexicon.DEFAULT_WORDS)


def test_missing_file_falls_back(spark, tmp_path):
    with pytest.warns(UserWarning, match="cannot be read"):
        assert lexicon.load_words(spark, str(tmp_path / "none.txt")) == ["gun"]


def test_empty_file_stays_empty(spark, tmp_path):
    path = tmp_path / "empty.txt"
    path.write_text("")
    assert lexicon.load_words(spark, str(path)) == []


def test_unreadable_file_falls_back(spark, tmp_path):
    path = tmp_path / "words.txt.gz"
    path.write_bytes(b"this is not gzip data")
    with pytest.warns(UserWarning, match="cannot be read"):
        assert lexicon.load_words(spark, str(path)) == ["gun"]


def test_large_list_stays_a_table(spark):
    words = lexicon.words_table(spark, [f"word{i}" for i in range(200)])
    assert lexicon.inline_words(words, max_chars=100) is None
    assert lexicon.inline_words(words, max_word=5) is None
    assert len(lexicon.inline_words(words)) == 200


def test_path_may_be_a_folder_of_lists(spark, tmp_path):
    os.makedirs(tmp_path / "lists")
    (tmp_path / "lists" / "a.txt").write_text("one\n")
    (tmp_path / "lists" / "b.txt").write_text("two\none\n")
    assert lexicon.load_words(spark, str(tmp_path / "lists")) == ["one", "two"]
