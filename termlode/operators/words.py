"""Per-document word statistics. None of these shuffles.

One input row is one document, so its length and its term counts are functions of
that row. The corpus is never regrouped by document: at scale that would move
every (document, word) pair over the network once more than needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.functions.text import run_count, run_word, word_array, word_runs


def tokens(
    docs: DataFrame, normalizer: str = "word_hyphen", drop_empty: bool = False
) -> DataFrame:
    """One row per occurrence: ``(collection, file, word)``."""
    words = word_array(F.col("text"), normalizer, drop_empty)
    return docs.select("collection", "file", F.explode(words).alias("word"))


def doc_lengths(
    docs: DataFrame, normalizer: str = "word_hyphen", drop_empty: bool = False
) -> DataFrame:
    """Number of words of each document, empty words included unless dropped."""
    words = word_array(F.col("text"), normalizer, drop_empty)
    return docs.select("collection", "file", F.size(words).cast("long").alias("word_count"))


def term_counts(
    docs: DataFrame,
    normalizer: str = "word_hyphen",
    drop_empty: bool = False,
    words: Sequence[str] | None = None,
    markers: bool = False,
) -> DataFrame:
    """``(collection, file, word, count, word_count)``, one row per distinct word.

    ``words`` keeps the given words only; ``word_count`` stays the full length.
    ``markers`` adds a row with a null word and count 0 for every document.
    """
    split = docs.select(
        "collection", "file", word_array(F.col("text"), normalizer, drop_empty).alias("words")
    )
    counted = F.col("words")
    if words is not None:
        counted = F.filter(counted, lambda word: word.isin(list(words)))
    runs = word_runs(counted)
    if markers:
        none = F.array().cast("array<string>")
        runs = F.array_prepend(F.coalesce(runs, none), F.lit(None).cast("string"))
    found = split.select(
        "collection",
        "file",
        F.size("words").cast("long").alias("word_count"),
        F.explode(runs).alias("run"),
    )
    run = F.col("run")
    return found.select(
        "collection",
        "file",
        run_word(run).alias("word"),
        F.coalesce(run_count(run), F.lit(0).cast("long")).alias("count"),
        "word_count",
    )
