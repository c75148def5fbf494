"""Null, empty, long, repeated and odd input, for every operator."""

import pytest
from pyspark.sql import functions as F

from termlode.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    html_text,
    language,
    licenses,
    line_templates,
    near_dedup,
    substrings,
    token_counts,
)
from termlode.sources.store import scratch_path

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "one two three four five six"),
    (1, "one two three four five six"),
    (2, None),
    (None, "one two three four five six"),
    (None, None),
    (3, ""),
    (4, " \n\t "),
    (5, LONG),
    (6, LONG),
    (7, "9 % !"),
    (7, "one"),
]
# Names that operators use inside.
CLASHING = ("rid", "block", "key", "size", "n", "score", "kept", "lang_pred", "file", "tied")


def benchmark(spark):
    return spark.createDataFrame(
        [(1, "three four five six"), (None, "one two three four five"), (2, None), (3, "")],
        "item_id long, text string",
    )


OPERATORS = {
    "licenses": licenses.scan,
    "near": near_dedup.near_duplicates,
    "language": language.language_predictions,
    "lines": line_templates.drop_recurring,
    "bpe": bpe.round_trip,
    "substrings": substrings.drop_repeats,
    "exact": exact_dedup.exact_duplicates,
}
FILTERS = {
    "licenses": licenses.drop_licenses,
    "near": near_dedup.drop_near_duplicates,
    "exact": exact_dedup.drop_exact_duplicates,
    "leaks": lambda docs: decontaminate.decontaminate(docs, benchmark(docs.sparkSession)),
    "language": language.identify,
}


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string")
    odd = rows.withColumn("lang", F.when(F.col("doc_id") > 1, "en"))
    for name in CLASHING:
        odd = odd.withColumn(name, F.lit(name))
    path = scratch_path(spark, "odd")
    odd.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(odd, name):
    found = [row["doc_id"] for row in OPERATORS[name](odd).collect()]
    assert sorted(found, key=repr) == sorted((i for i, _ in ROWS), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows_give_no_rows(odd, name):
    assert OPERATORS[name](odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_columns_and_stand_no_rows(odd, name):
    kept = FILTERS[name](odd)
    assert set(odd.columns) <= set(kept.columns)
    assert kept.count() > 0
    assert FILTERS[name](odd.limit(0)).count() == 0


def test_all_null_columns(spark):
    nothing = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string").withColumn(
        "lang", F.lit(None).cast("string")
    )
    for name, operator in OPERATORS.items():
        assert operator(nothing).count() == 3, name


def test_pages(spark):
    rows = [(1, "http://a/x", None), (1, "http://a/x", ""), (None, None, "<p>x</p>"), (2, "http://a", "<")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_text.main_text(pages.withColumn("text", F.lit("clash")).withColumn("host", F.lit(1)))
    assert sorted((row["page_id"] or 0, row["text"]) for row in found.collect()) == [
        (0, "x"),
        (1, ""),
        (1, ""),
        (2, "<"),
    ]
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_leaks_stand_nulls(spark, odd):
    found = decontaminate.contaminated(odd, benchmark(spark)).collect()
    assert sorted((row["doc_id"] or 0, row["item_id"] or 0) for row in found) == [
        (0, 0), (0, 1), (1, 0), (1, 0), (1, 1), (1, 1),
    ]
    assert decontaminate.contaminated(odd.limit(0), benchmark(spark)).count() == 0
    assert decontaminate.contaminated(odd, benchmark(spark).limit(0)).count() == 0


def test_token_counts_of_odd_rows(odd):
    found = token_counts.document_token_counts(odd).collect()
    assert len(found) == len(ROWS)
    assert all(row["n_tokens"] == 0 for row in found if row["doc_id"] in (2, 3))
    assert token_counts.document_token_counts(odd.limit(0)).count() == 0


def test_repeated_rows_leave_one(odd):
    kept = exact_dedup.exact_duplicates(odd).where("kept").collect()
    assert len(kept) == len({text or "" for _, text in ROWS})
    near = near_dedup.near_duplicates(odd).where("kept AND n_shingles > 0").collect()
    assert len(near) == 4
