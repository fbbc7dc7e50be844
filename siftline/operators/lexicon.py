"""Word lists: reading, cleaning, and fetching one that is small enough to inline."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The shipped word list, and the list used when a file is missing.
DEFAULT_WORDS = ("gun", "bad", "word", "violence", "hate")
FALLBACK_WORDS = ("gun",)

# Line trimming strips every character up to and including the space.
TRIMMED = "".join(map(chr, range(0x21)))

# A list within these bounds is fetched to the driver and becomes part of the
# expression; a larger one stays a table and is joined (see ``classify``).
INLINE_MAX_CHARS = 1_000_000
INLINE_MAX_WORD = 256


def clean_words(lines: DataFrame) -> DataFrame:
    """One lower-case ``word`` per row: trimmed, non-empty, distinct."""
    word = F.lower(F.btrim(F.col(lines.columns[0]), F.lit(TRIMMED)))
    return lines.select(word.alias("word")).where(F.col("word") != "").distinct()


def words_table(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    """A cleaned word table from Python strings; an empty list gives no rows."""
    return clean_words(spark.createDataFrame([(w,) for w in words], "value string"))


def read_words(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The word list stored one per line at ``path``.

    No path means the shipped list and a path that does not exist means the
    fallback list, with a warning. An existing but empty file stays empty: nothing is profane.
    """
    if path is None:
        return words_table(spark, DEFAULT_WORDS)
    try:
        return clean_words(spark.read.text(path))
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        _warn(path, failure)
        return words_table(spark, FALLBACK_WORDS)


def _warn(path: str, failure: Exception) -> None:
    reason = str(failure).strip().splitlines()[0]
    warnings.warn(f"word list {path} cannot be read, using {FALLBACK_WORDS}: {reason}", stacklevel=3)


def inline_words(
    words: DataFrame, max_chars: int = INLINE_MAX_CHARS, max_word: int = INLINE_MAX_WORD
) -> list[str] | None:
    """The cleaned words as a sorted list, or None when they exceed the bounds."""
    size = words.agg(
        F.coalesce(F.sum(F.length("word")), F.lit(0)).alias("chars"),
        F.coalesce(F.max(F.length("word")), F.lit(0)).alias("longest"),
    ).first()
    if size.chars > max_chars or size.longest > max_word:
        return None
    return sorted(row.word for row in words.collect())


def load_words(spark: SparkSession, path: str | None = None) -> list[str] | DataFrame:
    """The lexicon in the form ``classify`` takes: a list if small, else a table.

    A file that exists but cannot be read also falls back, with a warning.
    """
    words = read_words(spark, path)
    try:
        listed = inline_words(words)
    except (PySparkException, Py4JJavaError) as failure:
        # A task's failure comes as either class; both carry the condition in their text.
        if path is None or "[FAILED_READ_FILE" not in str(failure):
            raise
        _warn(path, failure)
        return list(FALLBACK_WORDS)
    return words if listed is None else listed
