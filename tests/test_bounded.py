"""The bounded search equals the plain one, and reads less."""

import random

import pytest

import termlode as tl
from helpers import SF_DIR, make_docs, plan
from termlode.plans import bounded


def ranked(frame):
    return [(r["collection"], r["file"], round(r["score"], 9)) for r in frame.collect()]


@pytest.fixture(scope="module")
def words_corpus(spark):
    """Documents of few words, common ones in most of them, many of them equal."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    texts = [
        " ".join(draw.choices(words, weights=[1 / (i + 1) for i in range(30)], k=draw.choice((1, 3, 8, 40))))
        for _ in range(600)
    ] + ["every one"] * 40
    texts = ["every " + text for text in texts]
    docs = make_docs(spark, [(f"{i:04}", f"c{i % 3}", text) for i, text in enumerate(texts)])
    return tl.build_index(docs).cache()


@pytest.fixture(scope="module")
def words_impacts(spark, words_corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("impacts") / "store")
    tl.write_impacts(words_corpus, path, common_rows=50)
    return tl.load_impacts(spark, path)


@pytest.mark.parametrize("query", ["w0 w1", "w0", "every w3 w0 w0", "w29 w0 nosuch", "every", "one w0", "nosuch", ""])
def test_same_rows_as_the_plain_search(words_corpus, words_impacts, query, monkeypatch):
    monkeypatch.setattr(bounded, "FIRST_ENTRIES", 1)
    for n in (1, 7, 2000):
        for collection in (None, "c1"):
            got = tl.search_top(words_corpus, words_impacts, query, n, collection)
            assert ranked(got) == ranked(tl.search(words_corpus, query, n, collection))


def test_joined_instead_of_literals(words_corpus, words_impacts, monkeypatch):
    monkeypatch.setattr(bounded, "LITERALS", 0)
    got = tl.search_top(words_corpus, words_impacts, "w0 w2", 5)
    assert ranked(got) == ranked(tl.search(words_corpus, "w0 w2", 5))


def test_classes_hold_each_entry_once_and_their_largest_weight(words_corpus, words_impacts):
    common = [r["word"] for r in words_impacts.bounds.select("word").distinct().collect()]
    assert "every" in common and "w0" in common
    kept = ("collection", "word", "file", "idf", "tf_idf")
    entries = {tuple(r[c] for c in kept) for r in words_impacts.entries.collect()}
    assert entries == {tuple(r[c] for c in kept) for r in words_corpus.collect() if r["word"] in common}
    largest = {}
    for row in words_impacts.entries.collect():
        key = (row["collection"], row["word"], row["class"])
        largest[key] = max(largest.get(key, 0.0), row["tf_idf"])
    assert {(r["collection"], r["word"], r["class"]): r["largest"] for r in words_impacts.bounds.collect()} == largest


def test_a_part_of_a_common_word_is_read(spark, tmp_path):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    index = tl.build_index(tl.corpus_from_table(table, "source", "doc_id", "text")).cache()
    path = str(tmp_path / "impacts")
    tl.write_impacts(index, path, common_rows=40)
    impacts = tl.load_impacts(spark, path, file_type="bigint")
    query = "the ention of onthe and"
    depths = bounded.first_depths(impacts, query, 1, None)
    seen = bounded._seen(index, impacts, query, depths, None).agg({"lower": "max"}).first()[0]
    depths.deepen(seen)
    assert depths.classes and 0 < depths.share() < 0.7
    got = tl.search_top(index, impacts, query, 1)
    assert ranked(got) == ranked(tl.search(index, query, 1))
    common = max(depths.classes)
    text = plan(impacts.entries.where(f"word = '{common}' AND class <= 2"))
    assert "PushedFilters" in text and "LessThanOrEqual(class,2)" in text


def test_flipped_idf_is_refused(spark, docs, tmp_path):
    with pytest.raises(ValueError, match="negative"):
        tl.write_impacts(tl.build_index(docs, flipped_idf=True), str(tmp_path / "x"), common_rows=1)
