from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import termlode as tl
from helpers import make_docs
from termlode.functions import clean, doc_name, strip_prefix, word_array, word_counts
from termlode.functions.text import WHITESPACE

N1 = {
    "c1/001.txt": ["red", "fox", "red", "dog", "fox-hunt", "", "dog"],
    "c1/002.txt": ["blue", "dog"],
    "c1/003.txt": ["red_foxs", "dog", "-", "cat", "cat", "x", ""],
    "c1/004.txt": ["blue", "dog"],
    "c2/001.txt": ["red", "5", "café"],
}
N2 = {
    "c1/001.txt": ["red", "fox", "red", "dog", "", "foxhunt", "", "dog", ""],
    "c1/002.txt": ["blue", "dog", ""],
    "c1/003.txt": ["redfoxs", "dog", "", "cat", "cat", "x", ""],
    "c1/004.txt": ["blue", "dog", ""],
    "c2/001.txt": ["red", "£5", "café"],
}
N3 = {**N1, "c1/003.txt": N1["c1/003.txt"][:-1]}


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column).first()[0]


@pytest.mark.parametrize(
    ("normalizer", "expected"),
    [("word_hyphen", N1), ("punct_lines", N2), ("word_hyphen_strip_last", N3)],
)
def test_words_of_each_normalizer(docs, normalizer, expected):
    words = docs.select("file", word_array(F.col("text"), normalizer))
    assert {file: list(found) for file, found in words.collect()} == expected


def test_unknown_normalizer_is_refused():
    with pytest.raises(ValueError, match="unknown normalizer"):
        clean(F.lit("x"), "other")


def test_backslash_survives_punctuation_removal(spark):
    assert one(spark, "a\\b'c-d_e[f]^g`h", clean(F.col("text"), "punct_lines")) == "a\\bcdefgh"


def test_strip_cuts_every_white_space_character(spark):
    assert all(c.isspace() for c in WHITESPACE)
    assert one(spark, WHITESPACE + "A" + WHITESPACE, clean(F.col("text"))) == "a"


def test_kept_characters_are_those_of_unicode_words_and_spaces(spark):
    """Every Latin character and the general punctuation block, one by one."""
    characters = [chr(c) for c in [*range(1, 0x250), *range(0x2000, 0x2070)]]
    frame = spark.createDataFrame([(f"a{c}a",) for c in characters], "text string")
    cleaned = [r[0] for r in frame.select(clean(F.col("text"), "word_hyphen")).collect()]
    for character, found in zip(characters, cleaned, strict=True):
        lowered = " " if character == "\n" else character.lower()
        kept = "".join(c for c in lowered if c.isalnum() or c.isspace() or c in "_-")
        assert found == f"a{kept}a", hex(ord(character))


def test_inner_tabs_do_not_split(spark):
    assert one(spark, "a\tb c", word_array(F.col("text"))) == ["a\tb", "c"]


def test_empty_text_is_one_empty_word(spark):
    assert one(spark, "", word_array(F.col("text"))) == [""]


def test_drop_empty(docs):
    words = docs.select("file", word_array(F.col("text"), "punct_lines", drop_empty=True))
    assert {f: list(w) for f, w in words.collect()} == {
        file: [w for w in found if w] for file, found in N2.items()
    }


def test_tokens_have_one_row_per_occurrence(docs):
    found = tl.tokens(docs).groupBy("file").agg(F.sort_array(F.collect_list("word"))).collect()
    assert {f: list(w) for f, w in found} == {f: sorted(w) for f, w in N1.items()}


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "", "é", "zz"])), min_size=1, max_size=8))
def test_word_counts_equal_a_counter(spark, arrays):
    frame = spark.createDataFrame(list(enumerate(arrays)), "id int, words array<string>")
    counted = frame.select("id", F.inline(word_counts(F.col("words")))).collect()
    expected = [(i, w, n) for i, words in enumerate(arrays) for w, n in Counter(words).items()]
    assert sorted(map(tuple, counted)) == sorted(expected)


def test_long_document_is_counted_whole(spark):
    text = " ".join(["common"] * 30_000 + [f"w{i}" for i in range(30_000)])
    counts = tl.term_counts(make_docs(spark, [("f", "c", text)]))
    assert counts.count() == 30_001
    top = counts.where("word = 'common'").first()
    assert (top["count"], top["word_count"]) == (30_000, 60_000)


def test_document_keys(spark):
    assert one(spark, "s3://b/x/s3://b/", strip_prefix(F.col("text"), "s3://b/")) == "x/"
    assert one(spark, "003.old.txt", doc_name(F.lit("news"), F.col("text"))) == "news-003"
