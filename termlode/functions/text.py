"""Text normalisation and tokenising as column expressions.

Everything here is a ``Column`` in, ``Column`` out built from Spark's own
functions, so cleaning and splitting happen inside the scan stage.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip`` treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What is deleted by the two word-hyphen normalisers. The class
# spells out Python's Unicode ``\w`` and ``\s``, which Java's do not match.
NOT_WORD_SPACE_HYPHEN = r"[^\p{L}\p{N}_\p{Z}\s\x0B\x1C-\x1F\x85-]"

# ASCII punctuation, without the backslash, which stays in the text.
PUNCTUATION = string.punctuation.replace("\\", "")

NORMALIZERS = ("word_hyphen", "punct_lines", "word_hyphen_strip_last")


def strip(text: Column) -> Column:
    """Cut every kind of leading and trailing white space, not blanks only."""
    return F.btrim(text, F.lit(WHITESPACE))


def join_lines(text: Column) -> Column:
    """Turn each run of newlines into one blank."""
    return F.regexp_replace(text, "\n+", " ")


def clean_lines(text: Column) -> Column:
    """Array of lines, each lower-cased, stripped and freed of punctuation."""
    return F.transform(
        F.split(F.lower(text), "\n"),
        lambda line: F.translate(strip(line), PUNCTUATION, ""),
    )


def clean(text: Column, normalizer: str = "word_hyphen") -> Column:
    """Cleaned text under one of :data:`NORMALIZERS`."""
    if normalizer == "word_hyphen":
        return F.regexp_replace(strip(F.lower(join_lines(text))), NOT_WORD_SPACE_HYPHEN, "")
    if normalizer == "word_hyphen_strip_last":
        return strip(F.lower(join_lines(F.regexp_replace(text, NOT_WORD_SPACE_HYPHEN, ""))))
    if normalizer == "punct_lines":
        return F.array_join(clean_lines(text), "\n")
    raise ValueError(f"unknown normalizer {normalizer!r}, expected one of {NORMALIZERS}")


def word_array(
    text: Column, normalizer: str = "word_hyphen", drop_empty: bool = False
) -> Column:
    """All words of a text in order.

    A single blank separates words, so two blanks in a row hold an empty word;
    under ``punct_lines`` a line end separates too and an empty line is an empty
    word. ``drop_empty`` leaves the empty words out.
    """
    if normalizer == "punct_lines":
        cleaned = F.array_join(clean_lines(text), " ")
    else:
        cleaned = clean(text, normalizer)
    words = F.split(cleaned, " ")
    return F.array_remove(words, "") if drop_empty else words


# A word and its repeats in a sorted text of words that single blanks separate.
_RUN = r"([^ ]++)(?: \1(?![^ ]))*+"


def word_runs(words: Column) -> Column:
    """Array of runs, one per distinct word of an array: the word as often as it occurs,
    separated by blanks.

    Equal words sit together once sorted, and one regular expression cuts the sorted text
    into runs, without a call per word. A run of n empty words is n - 1 blanks.
    """
    full = F.array_remove(words, "")
    empty = F.size(words) - F.size(full)
    runs = F.regexp_extract_all(F.array_join(F.sort_array(full), " "), F.lit(_RUN), F.lit(0))
    return F.when(empty > 0, F.array_prepend(runs, F.repeat(F.lit(" "), empty - 1))).otherwise(runs)


def run_word(run: Column) -> Column:
    """The word of a run."""
    return F.substring_index(run, " ", 1)


def run_count(run: Column) -> Column:
    """How often the word of a run occurs."""
    word = F.octet_length(run_word(run)) + 1
    return F.floor((F.octet_length(run) + 1) / word).cast("long")


def word_counts(words: Column) -> Column:
    """Array of ``(word, count)`` structs, one per distinct word of an array."""
    counted = F.transform(
        word_runs(words),
        lambda run: F.struct(run_word(run).alias("word"), run_count(run).alias("count")),
    )
    return F.when(F.size(words) > 0, counted)


def strip_prefix(path: Column, prefix: str) -> Column:
    """Remove a literal storage prefix from a path."""
    return F.replace(path, F.lit(prefix), F.lit(""))


def doc_name(collection: Column, filename: Column) -> Column:
    """``collection-stem``; the stem ends at the first dot of the file name."""
    return F.concat_ws("-", collection, F.substring_index(filename, ".", 1))
