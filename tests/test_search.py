import pytest
from pyspark.sql import functions as F

import termlode as tl
from helpers import plan, rows
from termlode.plans.search import hits


def found(frame):
    """Results in order, with short file names."""
    return [
        (r["file"] and r["file"][3:6], None if r["score"] is None else round(r["score"], 6))
        for r in frame.collect()
    ]


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("Red fox cat cat nope", [("001", 0.23765), ("003", 0.079217), (None, None)]),
        ("dog", [("001", 0.0), ("002", 0.0), ("003", 0.0), ("004", 0.0)]),
        ("Blue dog", [("002", 0.346574), ("004", 0.346574), ("001", 0.0), ("003", 0.0)]),
        ("nope", [(None, None)]),
    ],
)
def test_scores_and_order(index, query, expected):
    known = [e for e in expected if e[0]]
    assert found(tl.search(index, query, collection="c1")) == known
    assert found(tl.search(index, query, collection="c1", compat=True)) == expected


def test_empty_query_matches_empty_words(index):
    assert found(tl.search(index, "", collection="c1")) == [("001", 0.099021), ("003", 0.099021)]


def test_query_keeps_its_punctuation_unless_normalized(index):
    assert tl.search(index, "cat,").count() == 0
    assert found(tl.search(index, "Cat,", normalize_query=True)) == [("003", 0.396084)]


def test_repeats_enlarge_the_divisor_only(index):
    once = found(tl.search(index, "red fox", collection="c1"))
    twice = found(tl.search(index, "red fox fox", collection="c1"))
    assert twice[0][1] == pytest.approx(once[0][1] * 2 / 3, abs=1e-6)


def test_collection_is_searched_alone(index):
    assert rows(tl.search(index, "red", collection="c2"), "collection", "file") == [
        ("c2", "c2/001.txt")
    ]
    assert rows(tl.search(index, "red"), "file") == [("c1/001.txt",), ("c2/001.txt",)]


def test_top_n_is_a_prefix_and_word_order_is_free(real_index):
    query = "the of and hean then"
    full = tl.search(real_index, query).collect()
    assert len(full) > 10
    for n in (1, 3, 5):
        assert tl.search(real_index, query, n).collect() == full[:n]
    assert rows(tl.search(real_index, "then and hean of the")) == rows(
        tl.search(real_index, query)
    )


def test_matches_carry_the_query_count(index):
    matches = tl.query_matches(index, "cat cat red", collection="c1")
    assert rows(matches, "file", "word", "tf") == [
        ("c1/001.txt", "red", 1),
        ("c1/003.txt", "cat", 2),
    ]
    assert matches.count() == hits(index, "cat cat red", "c1").count()


def test_query_terms_of_a_table(spark):
    queries = spark.createDataFrame([(1, "Ice ice day"), (2, "")], "query_id long, text string")
    assert rows(tl.query_terms(queries)) == [(1, "day", 1, 3), (1, "ice", 2, 3), (2, "", 1, 1)]


def test_unmatched_terms(spark, index):
    terms = tl.query_terms(tl.query_table(spark, "red nope cat"))
    assert rows(tl.unmatched_terms(terms, index), "word") == [("nope",)]


def test_search_over_text_equals_search_over_index(real_docs, real_index):
    query = "the of hean"
    for options in ({}, {"n": 20}, {"collection": "en"}, {"compat": True}):
        from_text = tl.search_documents(real_docs, query + " nosuchword", **options)
        stored = tl.search(real_index, query + " nosuchword", **options)
        assert rows(from_text) == rows(stored)


def batch(spark):
    return spark.createDataFrame(
        [
            (1, "The of and", 3),
            (2, "de la que", 5),
            (3, "nosuchword", 2),
            (4, "the the hean", 1),
            (5, "", 4),
            (6, None, 4),
            (7, "the", None),
            (8, "the", 0),
            (9, "the", 100_000),
        ],
        "query_id long, text string, amount int",
    )


def test_batch_equals_a_loop_of_single_searches(spark, real_index):
    expected = []
    for query in batch(spark).collect():
        if query.text and query.amount:
            single = tl.search(real_index, query.text, query.amount).collect()
            expected += [
                (query.query_id, rank, r.collection, r.file, round(r.score, 6))
                for rank, r in enumerate(single, 1)
            ]
    assert rows(tl.search_batch(real_index, batch(spark))) == sorted(expected, key=repr)


def test_copies_of_a_query_are_answered_alike(spark, real_index):
    queries = spark.createDataFrame(
        [(i, "The of" if i % 3 else f"the w{i}", i % 5) for i in range(60)],
        "query_id long, text string, amount int",
    )
    plain = rows(tl.search_batch(real_index, queries))
    for options in ({"slice_rows": 7}, {"broadcast_bytes": 0}):
        assert rows(tl.search_batch(real_index, queries, **options)) == plain
    assert len(plain) == sum(i % 5 for i in range(60))


def test_batch_in_one_collection(spark, real_index):
    found = tl.search_batch(real_index, batch(spark), collection="en")
    assert {r.collection for r in found.collect()} == {"en"}


def test_rejected_queries_have_a_reason(spark):
    valid, rejected = tl.reject_invalid(batch(spark))
    assert rows(valid, "query_id") == [(1,), (2,), (3,), (4,), (8,), (9,)]
    assert rows(rejected, "query_id", "reason") == [
        (5, "query missing"),
        (6, "query missing"),
        (7, "amount missing"),
    ]


def test_batch_without_valid_queries_is_empty(spark, real_index):
    none = batch(spark).where("text is null")
    assert tl.search_batch(real_index, none).count() == 0


def test_known_item_is_ranked_high(spark, real_docs, real_index):
    document = real_docs.where("collection = 'en'").orderBy("file").first()
    counts = tl.term_counts(real_docs).where(
        (F.col("file") == document["file"]) & (F.col("collection") == "en")
    )
    rare = (
        counts.join(tl.vocabulary(real_docs), ["collection", "word"])
        .where("word <> ''")
        .orderBy("df", "word")
        .limit(5)
    )
    query = " ".join(r["word"] for r in rare.collect())
    assert tl.search(real_index, query, 1, collection="en").first()["file"] == document["file"]


def test_batch_queries_with_collections_read_these_only(spark, real_index, tmp_path):
    path = str(tmp_path / "index")
    tl.write_index(real_index, path)
    stored = tl.load_index(spark, path, file_type="bigint")
    rows_of = [(1, "the of and", 5, "en"), (2, "ention onthe", 3, "en")]
    scoped = spark.createDataFrame(rows_of, "query_id long, text string, amount int, collection string")
    found = tl.search_batch(stored, scoped)
    scan = plan(found).split("FileScan orc")[1]
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "collection" in filters and "en" in filters
    for query_id, text, amount, collection in rows_of:
        one = tl.search(real_index, text, amount, collection)
        assert rows(found.where(f"query_id = {query_id}"), "file", "score") == rows(one, "file", "score")
    mixed = scoped.unionByName(
        spark.createDataFrame([(3, "the of", 4, None), (4, "onthe", 2, "nowhere")], scoped.schema)
    )
    found = tl.search_batch(stored, mixed)
    assert {r["query_id"] for r in found.collect()} == {1, 2, 3}
    assert rows(found.where("query_id = 3"), "file", "score") == rows(
        tl.search(real_index, "the of", 4), "file", "score"
    )
