import pytest
from pyspark.sql import functions as F

import termlode as tl
from helpers import rows


def short(frame):
    return {
        r["file"][3:6]: None if r["score"] is None else round(r["score"], 6)
        for r in frame.collect()
    }


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("Red fox cat cat nope", [0.489898, 0.0, 1.212957, 0.0]),
        ("dog", [None] * 4),
        ("Blue dog", [0.0, 1.0, 0.0, 1.0]),
        ("nope", [None] * 4),
    ],
)
def test_cosine_of_every_document(index, query, expected):
    expected = dict(zip(["001", "002", "003", "004"], expected, strict=True))
    assert short(tl.cosine(index, query, lower_query=True, collection="c1")) == expected
    norms = tl.doc_norms(index)
    assert short(tl.cosine(index, query, True, "c1", norms=norms)) == expected


def test_case_is_kept_unless_lowered(index):
    assert set(short(tl.cosine(index, "Blue", collection="c1")).values()) == {None}


def test_norms(index):
    assert rows(tl.doc_norms(index).where("collection = 'c1'"), "norm") == [
        (0.346574,),
        (0.346574,),
        (0.495105,),
        (0.533245,),
    ]


def test_query_vector(index):
    vector = tl.query_vector(index, "cat cat nope red").where("collection = 'c1'")
    assert rows(vector, "word", "tf", "weight") == [
        ("cat", 0.5, 0.693147),
        ("red", 0.25, 0.346574),
    ]


def test_flipped_idf_leaves_cosine_unchanged(docs, index):
    flipped = tl.build_index(docs, flipped_idf=True)
    assert short(tl.cosine(flipped, "red fox cat", collection="c1")) == short(
        tl.cosine(index, "red fox cat", collection="c1")
    )


def test_cosine_over_collections_with_vocabulary_and_norms(real_docs, real_index):
    query = "the de hean the"
    plain = tl.cosine(real_index, query)
    assert plain.count() == real_docs.count()
    vocab = tl.vocabulary(real_docs)
    stored = tl.cosine(real_index, query, norms=tl.doc_norms(real_index), vocab=vocab)
    assert rows(plain) == rows(stored)


def test_inverted_index_keeps_repeats(docs):
    lists = tl.inverted_index(tl.weighted_counts(docs)).where("collection = 'c1'")
    found = {r["word"]: [f[3:6] for f in r["files"]] for r in lists.collect()}
    assert found["dog"] == ["001", "001", "002", "003", "004"]
    assert found["cat"] == ["003", "003"]
    assert found[""] == ["001", "003"]


@pytest.mark.parametrize("part_rows", [1, 7, 100_000])
def test_parts_of_a_posting_list_make_it_whole(real_docs, part_rows):
    weighted = tl.weighted_counts(real_docs)
    parts = tl.inverted_index(weighted, part_rows)
    whole = tl.tokens(real_docs).groupBy("collection", "word").count()
    joined = parts.groupBy("collection", "word").agg(F.sum(F.size("files")).alias("count"))
    assert joined.exceptAll(whole).count() == 0
    assert joined.count() == whole.count()
    assert (parts.where("part > 0").count() > 0) == (part_rows < 100)
    assert parts.agg(F.max(F.size("files"))).first()[0] <= part_rows


def test_term_map_and_document_vectors_hold_the_index(docs, index):
    weighted = tl.weighted_counts(docs).withColumn(
        "tf_idf", F.col("count") / F.col("word_count") * F.col("idf")
    )
    by_word = tl.term_map(weighted, part_rows=2).select(
        "collection", "word", F.explode("scores").alias("file", "tf_idf")
    )
    by_file = tl.doc_vectors(index).select(
        "collection", "file", F.explode("vector").alias("word", "tf_idf")
    )
    columns = ("collection", "word", "file", "tf_idf")
    assert rows(by_word, *columns) == rows(index, *columns) == rows(by_file, *columns)
