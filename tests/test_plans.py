"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as entry
import termlode as tl
from helpers import SF_DIR, plan


@pytest.fixture(scope="module")
def scan(spark):
    # Not the directory of the cached fixtures, whose cache would show in the plans.
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return tl.corpus_from_table(table, "lang", "doc_id", "text")


def test_nothing_runs_python_rows(spark):
    for name, query in entry.text_search_queries().items():
        text = plan(query(spark, SF_DIR))
        assert "Python" not in text and "MapInPandas" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_document_statistics_do_not_shuffle(scan):
    for frame in (tl.tokens(scan), tl.doc_lengths(scan), tl.term_counts(scan)):
        assert "Exchange" not in plan(frame)


def test_doc_freq_shuffles_once_after_combining(scan):
    text = plan(tl.doc_freq(scan))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text


def test_scans_read_only_what_they_need(scan):
    sizes = plan(tl.collection_sizes(scan))
    assert "text" not in sizes.split("ReadSchema: ")[1]
    one = plan(tl.term_counts(tl.in_collection(scan, "en")))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in one
    assert "EqualTo(lang,en)" in one


def test_stored_index_build_shuffles_the_counts_once(scan):
    vocab = tl.store_vocabulary(scan)
    clustered = plan(tl.build_index(scan, vocab=vocab, cluster=True))
    assert "SortMergeJoin" in clustered
    assert clustered.count("Exchange hashpartitioning") == 2
    assert "Exchange hashpartitioning" not in plan(tl.build_index(scan, vocab=vocab))


def test_large_vocabulary_is_not_broadcast(spark, scan):
    vocab = tl.store_vocabulary(scan)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        text = plan(tl.build_index(scan, vocab=vocab))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and "SortMergeJoin" in text


@pytest.fixture(scope="module")
def cold_index(spark, scan, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "index")
    tl.index_corpus(scan, path)
    return tl.load_index(spark, path, file_type="bigint")


def mixed_amounts(spark):
    amount = F.when(F.col("query_id") % 2 == 0, 5).otherwise(100_000)
    return entry._query_set(spark, SF_DIR).withColumn("amount", amount)


def test_batch_ranks_each_text_in_slices_before_the_last_exchange(spark, cold_index):
    text = plan(tl.search_batch(cold_index, mixed_amounts(spark), broadcast_bytes=0))
    lines = text.splitlines()
    windows = [i for i, line in enumerate(lines) if "Window [" in line]
    assert len(windows) == 2
    upper, lower = windows
    assert "_slice" in lines[lower] and "_slice" not in lines[upper]
    between = "\n".join(lines[upper:lower])
    assert between.count("Exchange hashpartitioning(text_id") == 1
    assert "rank" in between and "most" in between
    below = "\n".join(lines[lower:])
    # Scores and first ranks share the exchange on (text, slice).
    assert below.index("HashAggregate") < below.index("Exchange hashpartitioning(text_id")
    assert below.count("Exchange hashpartitioning(text_id") == 1


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_batch_filters_the_index_before_it_moves(spark, cold_index, options):
    text = plan(tl.search_batch(cold_index, mixed_amounts(spark), **options))
    lines = text.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan orc" in line]
    assert scans
    for at in scans:
        above = [line for line in lines[:at] if "Exchange" in line or "LeftSemi" in line]
        assert "LeftSemi" in above[-1] or "BroadcastHashJoin" in above[-1]


def test_batch_broadcasts_only_queries_counted_small(spark, cold_index):
    queries = entry._query_set(spark, SF_DIR)
    large = plan(tl.search_batch(cold_index, queries, broadcast_bytes=0))
    assert "SortMergeJoin" in large
    assert "SortMergeJoin" not in plan(tl.search_batch(cold_index, queries)).split("Window [")[-1]


def test_unmatched_words_shuffle_only_what_was_asked(spark, scan):
    terms = tl.query_terms(entry._query_set(spark, SF_DIR)).select("query_id", "word")
    text = plan(tl.unmatched_terms(terms, tl.distinct_words(scan)))
    lines = text.splitlines()
    documents = next(i for i, line in enumerate(lines) if "lang" in line and "FileScan" in line)
    above = [line for line in lines[:documents] if "Exchange" in line or "LeftSemi" in line]
    assert "LeftSemi" in above[-1]


def test_folders_are_read_twice_to_build_and_once_to_search(spark, tmp_path, monkeypatch):
    for i in range(3):
        (tmp_path / "corpus" / "c").mkdir(parents=True, exist_ok=True)
        (tmp_path / "corpus" / "c" / f"{i}.txt").write_text(f"red dog {i}")
    scans = []
    written = DataFrameWriter.parquet

    def counting(self, path, *rest, **options):
        scans.append(plan(self._df).count("FileScan text"))
        return written(self, path, *rest, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", counting)
    docs = tl.read_corpus(spark, str(tmp_path / "corpus"))
    index = tl.build_index(docs)
    assert sum(scans) + plan(index).count("FileScan text") == 2
    scans.clear()
    found = tl.search_documents(docs, "red dog", 2)
    assert sum(scans) + plan(found).count("FileScan text") == 1


def test_single_query_terms_are_the_broadcast_side(spark, index, tmp_path):
    path = str(tmp_path / "index")
    tl.write_index(index, path)
    text = plan(tl.query_matches(tl.load_index(spark, path), "red dog"))
    assert "BroadcastHashJoin" in text
    below = text.split("BroadcastExchange")[1]
    assert "Range" in below and "orc" not in below


def test_hot_word_slices_broadcast_hashes_only(scan):
    vocab = tl.store_vocabulary(scan)
    frame = tl.weighted_counts(scan, vocab=vocab, cluster=True, slice_rows=5)
    for below in plan(frame).split("BroadcastExchange")[1:]:
        assert "_slices" in below.splitlines()[1] and "word" not in below.splitlines()[1]




def test_words_are_counted_without_a_call_per_word(scan):
    assert "lambda" not in plan(tl.term_counts(scan))


def test_large_vocabulary_meets_unsorted_counts(scan, monkeypatch):
    before = tl.build_index(scan)
    monkeypatch.setattr("termlode.plans.index.PLANNED_WORDS", 0)
    index = tl.build_index(scan)
    text = plan(index)
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text and "Sort " not in text
    assert index.exceptAll(before).isEmpty() and before.count() == index.count()


def test_batch_builds_its_index_once(spark, scan):
    queries = spark.createDataFrame([(1, "the of nosuchword", 3)], "query_id long, text string, amount long")
    for compat in (False, True):
        found = tl.search_batch(tl.build_index(scan), queries, compat=compat, store_entries=True)
        assert "sf0.01/documents.parquet" not in plan(found)
        assert found.count() == 3


def test_vocabulary_without_collection_frequency(scan):
    columns = ["collection", "word", "df", "n_docs", "idf"]
    short, whole = tl.vocabulary(scan, cf=False), tl.vocabulary(scan)
    assert short.select(columns).exceptAll(whole.select(columns)).isEmpty()
    assert short.count() == whole.count() and short.where("cf IS NOT NULL").isEmpty()
    total = tl.tokens(scan).count()
    assert whole.selectExpr("sum(cf)").first()[0] == total
