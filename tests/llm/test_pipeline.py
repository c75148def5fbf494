"""The pipeline against the brute-force forms of its stages."""

import brute
import corpus_pipeline
from brute import SF_DIR
from termlode.llm import language
from termlode.sources.store import scratch_path


def test_stages_are_those_registered():
    import __spark_entry__

    queries = __spark_entry__.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in queries if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5


def test_run_equals_brute_force(spark, documents, texts):
    left = {i: t for i, t in texts if any(c.isalpha() for c in t or "")}
    left = {i: t for t, i in sorted({t: i for i, t in sorted(left.items())}.items())}
    roots = brute.components(sorted(left.items()))
    left = {i: t for i, t in left.items() if roots[i][1] == i}
    items = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    stage = documents
    for name, step in corpus_pipeline.STAGES[:4]:
        stage = step(spark, stage, SF_DIR)
        assert stage.columns == documents.columns, name
    kept = {row["doc_id"] for row in stage.collect()}
    leaked = {doc for doc, _ in brute.leaks(sorted(left.items()), items)}
    assert kept == set(left) - leaked
    found = {row["doc_id"]: row for row in corpus_pipeline.run(spark, SF_DIR).collect()}
    expected = brute.encoded([(i, left[i]) for i in kept])
    assert {i: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for i, r in found.items()} == expected


def test_rejects_what_has_no_language(spark):
    docs = spark.createDataFrame(
        [(1, "the words of it", "en", "s", 1), (2, "12 34", "en", "s", 1), (3, None, None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    kept = corpus_pipeline.identify_language(spark, docs, SF_DIR)
    assert [row["doc_id"] for row in kept.collect()] == [1]
    assert language.UNDETERMINED == "und"


def test_stages_stand_odd_rows(spark):
    text = "the words of it and some more of them here"
    rows = [(1, text), (1, text), (None, text), (None, None), (2, ""), (3, "12 34"), (4, text + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "1 AS rid", "'b' AS block", "0 AS score"
    )
    path = scratch_path(spark, "odd")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    for given, left in ((docs, 1), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES[:4]:
            given = stage(spark, given, SF_DIR)
            assert given.columns == docs.columns, name
        assert given.count() == left
        assert corpus_pipeline.STAGES[4][1](spark, given, SF_DIR).count() == left
