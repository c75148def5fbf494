import math

import pytest
from pyspark.sql import functions as F

import termlode as tl
from helpers import make_docs, rows
from termlode.operators.skew import join_by_frequency

EXPECTED = sorted(
    [
        ("001", "", 1, 7, 2, 0.142857, 0.693147, 0.099021),
        ("001", "dog", 2, 7, 4, 0.285714, 0.0, 0.0),
        ("001", "fox", 1, 7, 1, 0.142857, 1.386294, 0.198042),
        ("001", "fox-hunt", 1, 7, 1, 0.142857, 1.386294, 0.198042),
        ("001", "red", 2, 7, 1, 0.285714, 1.386294, 0.396084),
        ("002", "blue", 1, 2, 2, 0.5, 0.693147, 0.346574),
        ("002", "dog", 1, 2, 4, 0.5, 0.0, 0.0),
        ("004", "blue", 1, 2, 2, 0.5, 0.693147, 0.346574),
        ("004", "dog", 1, 2, 4, 0.5, 0.0, 0.0),
        ("003", "", 1, 7, 2, 0.142857, 0.693147, 0.099021),
        ("003", "-", 1, 7, 1, 0.142857, 1.386294, 0.198042),
        ("003", "cat", 2, 7, 1, 0.285714, 1.386294, 0.396084),
        ("003", "dog", 1, 7, 4, 0.142857, 0.0, 0.0),
        ("003", "red_foxs", 1, 7, 1, 0.142857, 1.386294, 0.198042),
        ("003", "x", 1, 7, 1, 0.142857, 1.386294, 0.198042),
    ],
    key=repr,
)


def test_every_number_of_the_small_corpus(docs):
    weighted = tl.weighted_counts(docs).where("collection = 'c1'")
    tf = F.col("count") / F.col("word_count")
    shown = weighted.select(
        F.substring("file", 4, 3), "word", "count", "word_count", "df", tf, "idf", tf * F.col("idf")
    )
    assert rows(shown) == EXPECTED


def test_index_columns(index):
    assert index.dtypes == [
        ("collection", "string"),
        ("word", "string"),
        ("file", "string"),
        ("idf", "double"),
        ("tf_idf", "double"),
    ]


def test_one_document_collection_has_idf_zero(index):
    assert rows(index.where("collection = 'c2'"), "idf", "tf_idf") == [(0.0, 0.0)] * 3


def test_collection_sizes_count_empty_documents(spark):
    docs = make_docs(spark, [("a", "c", "x"), ("b", "c", "")])
    assert rows(tl.collection_sizes(docs)) == [("c", 2)]
    assert rows(tl.build_index(docs), "word", "idf") == [
        ("", round(math.log(2), 6)),
        ("x", round(math.log(2), 6)),
    ]


def test_raw_tf_and_flipped_idf(docs):
    raw = tl.build_index(docs, tf="raw").where("file = 'c1/001.txt' and word = 'red'")
    assert rows(raw, "tf_idf") == [(2.772589,)]
    flipped = tl.build_index(docs, flipped_idf=True).where("file = 'c1/001.txt' and word = 'red'")
    assert rows(flipped, "idf", "tf_idf") == [(-1.386294, -0.396084)]
    with pytest.raises(ValueError, match="unknown tf"):
        tl.build_index(docs, tf="other")


def test_drop_empty_shortens_documents(docs):
    index = tl.weighted_counts(docs, "punct_lines", drop_empty=True)
    assert index.where("word = ''").count() == 0
    assert rows(index.where("file = 'c1/002.txt'"), "word", "word_count") == [
        ("blue", 2),
        ("dog", 2),
    ]


@pytest.mark.parametrize("normalizer", ["word_hyphen", "punct_lines", "word_hyphen_strip_last"])
def test_restricting_to_words_changes_no_entry(real_docs, normalizer):
    words = ["the", "of", "de", "", "nosuchword"]
    full = tl.build_index(real_docs, normalizer).where(F.col("word").isin(words))
    assert rows(tl.build_index(real_docs, normalizer, words=words)) == rows(full)


def test_no_words_give_an_empty_index(docs):
    assert tl.build_index(docs, words=[]).count() == 0


@pytest.mark.parametrize("hint", [None, "merge"])
@pytest.mark.parametrize("slice_rows", [1, 3, 20])
def test_hot_words_in_slices_change_no_entry(real_docs, slice_rows, hint):
    counts = tl.term_counts(real_docs)
    vocab = tl.store_vocabulary(real_docs)
    assert vocab.largest > 20
    plain = counts.join(vocab.frame, ["collection", "word"])
    sliced = join_by_frequency(
        counts,
        vocab.frame,
        ["collection", "word"],
        "file",
        "df",
        vocab.total_rows,
        vocab.largest,
        hint,
        slice_rows,
    ).select(plain.columns)
    assert sliced.count() == counts.count() == vocab.total_rows
    assert sliced.exceptAll(plain).count() == 0


def test_properties_on_real_documents(real_docs, real_index):
    counts = tl.term_counts(real_docs)
    sums = counts.groupBy("collection", "file").agg(
        F.sum(F.col("count") / F.col("word_count")).alias("s"), F.sum("count").alias("n")
    )
    lengths = tl.doc_lengths(real_docs)
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    assert sums.join(lengths, ["collection", "file"]).where("n <> word_count").count() == 0
    vocab = tl.vocabulary(real_docs)
    assert vocab.where("df < 1 or df > n_docs or idf < 0").count() == 0
    pairs = tl.tokens(real_docs).distinct().count()
    assert real_index.count() == pairs
    assert real_index.select("collection", "file", "word").distinct().count() == pairs


def test_doc_freq_is_the_distinct_count(real_docs):
    distinct = (
        tl.tokens(real_docs).groupBy("collection", "word").agg(F.count_distinct("file").alias("df"))
    )
    assert rows(tl.doc_freq(real_docs)) == rows(distinct)


def test_one_collection_holding_nearly_everything(spark):
    docs = make_docs(
        spark,
        [(f"f{i}", "big", f"common w{i}") for i in range(300)] + [("g", "small", "common other")],
    )
    index = tl.build_index(docs)
    assert index.count() == 602
    common = index.where("collection = 'big' and word = 'common'")
    assert rows(common.select("idf").distinct()) == [(0.0,)]
