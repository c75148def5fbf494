"""Ranked search over a TF-IDF index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.functions.text import clean, word_counts
from termlode.operators.skew import among, join_sliced
from termlode.plans.index import build_index
from termlode.sources.corpus import in_collection

# Scores are ordered on this many decimals: summation order differs between plans.
ORDER_DECIMALS = 9


def query_words(query: str) -> list[str]:
    """Words of a query: lower-cased and split on single blanks, nothing else."""
    return query.lower().split(" ")


def normalized_query(spark: SparkSession, query: str, normalizer: str = "word_hyphen") -> str:
    """A query text cleaned the way documents are."""
    return spark.range(1).select(clean(F.lit(query), normalizer)).first()[0]


def query_table(spark: SparkSession, query: str) -> DataFrame:
    """A single query as a one-row table of queries."""
    return spark.range(1).select(
        F.lit(0).cast("long").alias("query_id"), F.lit(query).alias("text")
    )


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, word, tf, total_words)`` of each query text.

    ``total_words`` counts repeated words; ``tf`` is how often the word occurs.
    """
    words = queries.select("query_id", F.split(F.lower("text"), " ").alias("words"))
    return words.select(
        "query_id",
        F.size("words").cast("long").alias("total_words"),
        F.inline(word_counts(F.col("words"))),
    ).select("query_id", "word", F.col("count").alias("tf"), "total_words")


def hits(index: DataFrame, query: str, collection: str | None = None) -> DataFrame:
    """Index entries of the query's words.

    The words are literals, so the store skips what cannot hold them and the
    collection prunes directories. Nothing is joined or broadcast.
    """
    return in_collection(index, collection).where(
        F.col("word").isin(sorted(set(query_words(query))))
    )


def query_matches(index: DataFrame, query: str, collection: str | None = None) -> DataFrame:
    """Index entries of the query's words with the count of the word in the query.

    The broadcast side is the one query's words, as large as its text.
    """
    terms = query_terms(query_table(index.sparkSession, query)).select("word", "tf")
    return hits(index, query, collection).join(F.broadcast(terms), "word").select(
        "collection", "file", "word", "tf", "idf", "tf_idf"
    )


def unmatched_words(terms: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct words of the query terms with no entry in the index.

    Only words that were asked for leave the rows of the index, so that is all
    that is shuffled; a common word is a single row per task.
    """
    asked = terms.select("word").distinct()
    present = among(index.select("word"), asked, "word").distinct()
    return asked.join(present, "word", "left_anti")


def unmatched_terms(terms: DataFrame, index: DataFrame) -> DataFrame:
    """Terms of a query table, ``(query_id, word, ...)``, with no entry in the index.

    ``index`` may be any frame of words; one row per document and word will do.
    """
    missing = unmatched_words(terms, index)
    return join_sliced(terms, missing, ["word"], spread_by="query_id", how="left_semi")


def coordinated_score(total_words: Column) -> Column:
    """Sum of weights, times the share of the query's words that were matched.

    Matched words count once each, the divisor counts repeats.
    """
    return F.sum("tf_idf") * (F.count(F.lit(1)) / total_words)


def rank_order(*ties: str) -> list[Column]:
    return [F.round("score", ORDER_DECIMALS).desc_nulls_last(), *map(F.col, ties)]


def search(
    index: DataFrame,
    query: str,
    n: int | None = None,
    collection: str | None = None,
    compat: bool = False,
    normalize_query: bool = False,
) -> DataFrame:
    """Documents ranked for one query: ``(collection, file, score)``, best first.

    An index entry is unique per word and file, so the number of entries of a
    file is its number of matched words and one aggregation gives the score.
    ``compat`` adds the row of nulls that stands for unknown query words.
    ``normalize_query`` cleans the query like a document first.
    """
    if normalize_query:
        query = normalized_query(index.sparkSession, query)
    found = hits(index, query, collection)
    total = F.lit(len(query_words(query)))
    scores = found.groupBy("collection", "file").agg(coordinated_score(total).alias("score"))
    if compat:
        terms = query_terms(query_table(index.sparkSession, query))
        null_row = unmatched_words(terms, found).limit(1).select(
            *(F.lit(None).cast(field.dataType).alias(field.name) for field in scores.schema)
        )
        scores = scores.unionByName(null_row)
    ranked = scores.orderBy(*rank_order("collection", "file"))
    return ranked if n is None else ranked.limit(n)


def search_documents(
    docs: DataFrame,
    query: str,
    n: int | None = None,
    collection: str | None = None,
    compat: bool = False,
    **options,
) -> DataFrame:
    """Search a corpus that has no stored index, reading its text once.

    Equal to :func:`search` over the full index of the corpus; only the query's
    words are indexed. ``options`` as in :func:`build_index`.
    """
    words = sorted(set(query_words(query)))
    index = build_index(in_collection(docs, collection), words=words, **options)
    return search(index, query, n, compat=compat)
