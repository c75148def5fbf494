"""Stored posting lists hold what the inverted index holds."""

import time

import pytest

import termlode as tl
from helpers import plan, rows
from termlode.plans import lists


def test_lists_of_a_corpus(spark, real_docs, tmp_path):
    path = str(tmp_path / "lists")
    tl.write_postings(real_docs, path, block_documents=16)
    counts = tl.weighted_counts(real_docs)
    columns = ("collection", "word", "file", "count", "df", "cf")
    assert rows(tl.load_postings(spark, path, file_type="bigint"), *columns) == rows(counts, *columns)
    some = tl.load_postings(spark, path, "en", ["the", "of"], "bigint")
    assert rows(some, *columns) == rows(counts.where("collection = 'en' AND word IN ('the', 'of')"), *columns)
    lists = tl.load_lists(spark, path, words=["the"])
    assert "In(word" in plan(tl.load_lists(spark, path, words=["the", "of"]))
    found = lists.collect()
    assert len(found) > 5
    for row in found:
        assert row["distances"] == sorted(set(row["distances"])) and row["distances"][0] == 0
        assert len(row["distances"]) == len(row["counts"])
    shares = counts.selectExpr("word", "count / word_count AS share").where("word = 'the'")
    assert max(r["largest"] for r in found) == shares.agg({"share": "max"}).first()[0]
    with pytest.raises(ValueError, match="already"):
        tl.write_postings(real_docs, path)


def test_lists_of_small_and_empty_corpora(spark, docs, tmp_path):
    tl.write_postings(docs, str(tmp_path / "a"))
    inverted = tl.inverted_index(tl.load_postings(spark, str(tmp_path / "a")))
    assert rows(inverted) == rows(tl.inverted_index(tl.weighted_counts(docs)))
    tl.write_postings(docs.limit(0), str(tmp_path / "b"))
    assert tl.load_postings(spark, str(tmp_path / "b")).count() == 0


COLUMNS = ("collection", "word", "file", "count", "df", "cf")


def test_names_are_found_without_shuffling_entries_by_number(spark, real_docs, tmp_path):
    tl.write_postings(real_docs, str(tmp_path / "a"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = plan(tl.inverted_index(tl.load_postings(spark, str(tmp_path / "a"), file_type="bigint")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" not in found and "ShuffledHashJoin" not in found
    # Entries are gathered before they are shuffled.
    assert found.count("collect_list(file") >= 2


def test_shuffles_of_the_writing_are_gone_when_it_is_done(spark, real_docs, tmp_path):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {name.split("_")[1] for name in names if name.startswith("shuffle_")}

    before = shuffled()
    tl.write_postings(real_docs, str(tmp_path / "a"))
    # What the last job wrote may still be held by the driver.
    for _ in range(50):
        if len(shuffled() - before) <= 1:
            return
        time.sleep(0.1)
    raise AssertionError(f"shuffles left: {shuffled() - before}")


def test_lists_of_several_chunks_and_of_many_names(spark, real_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(lists, "CHUNK_DOCUMENTS", 37)
    monkeypatch.setattr(lists, "NAMES", 7)
    tl.write_postings(real_docs, str(tmp_path / "a"), block_documents=16)
    expected = rows(tl.weighted_counts(real_docs), *COLUMNS)
    assert rows(tl.load_postings(spark, str(tmp_path / "a"), file_type="bigint"), *COLUMNS) == expected
    monkeypatch.setattr(lists, "NAME_BYTES", 0)
    assert rows(tl.load_postings(spark, str(tmp_path / "a"), file_type="bigint"), *COLUMNS) == expected
    blocks = rows(tl.load_lists(spark, str(tmp_path / "a"), words=["the"]), "collection", "block")
    assert len(set(blocks)) == len(blocks)


def test_long_buckets_are_cut_and_counts_repeat(spark):
    entries = [("c", "w", f, n, 40) for f, n in ((1, 9), (2, 1), (3, 30))] + [("c", "v", 5, 2, 2)]
    weighted = spark.createDataFrame(entries, "collection string, word string, file long, count long, cf long")
    found = tl.inverted_index(weighted, 4).collect()
    assert all(0 < len(r["files"]) <= 4 and r["files"] == sorted(r["files"]) for r in found)
    assert sorted(f for r in found if r["word"] == "w" for f in r["files"]) == [1] * 9 + [2] + [3] * 30
    assert [r["files"] for r in found if r["word"] == "v"] == [[5, 5]]
