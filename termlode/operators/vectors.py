"""Cosine similarity in the vector space of TF-IDF weights."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlode.operators.skew import join_sliced
from termlode.sources.corpus import in_collection


def _words(query: str, lower_query: bool) -> list[str]:
    return (query.lower() if lower_query else query).split(" ")


def _per_word(numbers: dict[str, float]) -> Column:
    """Look a number up by word; a map literal with one entry per query word."""
    pairs = [F.lit(item) for word in sorted(numbers) for item in (word, float(numbers[word]))]
    return F.element_at(F.create_map(*pairs), F.col("word"))


def _of_query(index: DataFrame, counts: Counter) -> DataFrame:
    return index.where(F.col("word").isin(sorted(counts)))


def doc_norms(index: DataFrame) -> DataFrame:
    """Euclidean norm of every document's weights."""
    return index.groupBy("collection", "file").agg(
        F.sqrt(F.sum(F.col("tf_idf") * F.col("tf_idf"))).alias("norm")
    )


def query_vector(index: DataFrame, query: str, lower_query: bool = False) -> DataFrame:
    """``(collection, word, tf, idf, weight)`` for the query words the index knows.

    ``index`` may be any table with the idf of each word, such as a vocabulary.
    Unknown words have no weight but still count in the divisor of tf. Each word
    comes down to one row per task before the shuffle.
    """
    words = _words(query, lower_query)
    counts = Counter(words)
    tf = _per_word({word: count / len(words) for word, count in counts.items()})
    known = _of_query(index, counts).groupBy("collection", "word").agg(F.max("idf").alias("idf"))
    return known.select(
        "collection", "word", tf.alias("tf"), "idf", (tf * F.col("idf")).alias("weight")
    )


def cosine(
    index: DataFrame,
    query: str,
    lower_query: bool = False,
    collection: str | None = None,
    norms: DataFrame | None = None,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """Cosine score of every document: ``(collection, file, score)``, unordered.

    A word that occurs k times in the query is added k times, so a score may pass
    1. A zero norm on either side gives NULL. Without ``norms`` one aggregation
    over the index yields dot product and norm together; with stored
    :func:`doc_norms` only the entries of the query's words are read. The query's
    own norm is taken from ``vocab``, if given, instead of the index.
    """
    index = in_collection(index, collection)
    idfs = index if vocab is None else in_collection(vocab, collection)
    words = _words(query, lower_query)
    counts = Counter(words)
    # Query weight, times the repeats of the word, as a factor of idf * tf_idf.
    factor = _per_word({word: count * count / len(words) for word, count in counts.items()})
    product = factor * F.col("idf") * F.col("tf_idf")
    if norms is None:
        docs = index.groupBy("collection", "file").agg(
            F.sum(F.when(F.col("word").isin(sorted(counts)), product).otherwise(0.0)).alias("dot"),
            F.sqrt(F.sum(F.col("tf_idf") * F.col("tf_idf"))).alias("norm"),
        )
    else:
        dots = (
            _of_query(index, counts).groupBy("collection", "file").agg(F.sum(product).alias("dot"))
        )
        docs = in_collection(norms, collection).join(dots, ["collection", "file"], "left")
    query_norm = query_vector(idfs, query, lower_query).groupBy("collection").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("query_norm")
    )
    return join_sliced(docs, query_norm, ["collection"], spread_by="file", how="left").select(
        "collection",
        "file",
        F.try_divide(F.coalesce("dot", F.lit(0.0)), F.col("query_norm") * F.col("norm")).alias(
            "score"
        ),
    )
