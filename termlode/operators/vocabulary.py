"""Corpus statistics per collection: document count, df, cf and idf of each word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.functions.text import word_array
from termlode.functions.weights import idf
from termlode.operators.skew import join_sliced
from termlode.sources.store import stored


def collection_sizes(docs: DataFrame) -> DataFrame:
    """Documents per collection; an empty document counts.

    Reads one column of a table, but all of a folder, whose files are opened to be
    counted; :func:`vocabulary` takes the number from its own pass.
    """
    return docs.groupBy("collection").agg(F.count(F.lit(1)).alias("n_docs"))


def doc_freq(
    docs: DataFrame, normalizer: str = "word_hyphen", drop_empty: bool = False
) -> DataFrame:
    """Number of documents that hold each word.

    A document hands in each of its words once, so a plain count is the distinct
    count, and it is combined within each task before the shuffle: a word found
    in every document costs one row per task.
    """
    held = distinct_words(docs, normalizer, drop_empty)
    return held.groupBy("collection", "word").agg(F.count(F.lit(1)).alias("df"))


def distinct_words(
    docs: DataFrame, normalizer: str = "word_hyphen", drop_empty: bool = False
) -> DataFrame:
    """``(collection, word)`` once per document that holds the word; no shuffle."""
    held = F.array_distinct(word_array(F.col("text"), normalizer, drop_empty))
    return docs.select("collection", F.explode(held).alias("word"))


def frequencies(counts: DataFrame) -> DataFrame:
    """Document and collection frequency from rows unique per document and word."""
    return counts.groupBy("collection", "word").agg(
        F.count(F.lit(1)).alias("df"), F.sum("count").alias("cf")
    )


def _corpus_frequencies(
    docs: DataFrame, normalizer: str, drop_empty: bool, cf: bool = True
) -> DataFrame:
    """:func:`frequencies` of all words, with one null word per document, without its counts.

    A document hands in each distinct word and a null, and for ``cf`` all its words after
    them; what stands up to the null counts for df, the rest for cf.
    """
    words = F.coalesce(
        word_array(F.col("text"), normalizer, drop_empty), F.array().cast("array<string>")
    )
    split = docs.select("collection", words.alias("words"))
    once = F.array_append(F.array_distinct("words"), F.lit(None).cast("string"))
    if not cf:
        held = split.select("collection", F.explode(once).alias("word"))
        counted = held.groupBy("collection", "word").agg(F.count(F.lit(1)).alias("df"))
        return counted.withColumn("cf", F.lit(None).cast("long"))
    sized = split.select("collection", "words", F.size(F.array_distinct("words")).alias("last"))
    rows = sized.select("collection", "last", F.posexplode(F.concat(once, "words")))
    first = F.col("pos") <= F.col("last")
    return rows.groupBy("collection", F.col("col").alias("word")).agg(
        F.count_if(first).alias("df"), F.count_if(~first).alias("cf")
    )


def with_idf(freqs: DataFrame, flipped: bool = False) -> DataFrame:
    """Add document count and idf to frequencies that hold one null word per document.

    The frequency of the null word is the number of documents, and it is left out.
    """
    sizes = freqs.where("word IS NULL").select("collection", F.col("df").alias("n_docs"))
    words = freqs.where("word IS NOT NULL")
    return join_sliced(words, sizes, ["collection"], spread_by="word").select(
        "collection", "word", "df", "cf", "n_docs", idf(flipped).alias("idf")
    )


def vocabulary(
    docs: DataFrame,
    normalizer: str = "word_hyphen",
    drop_empty: bool = False,
    flipped_idf: bool = False,
    cf: bool = True,
) -> DataFrame:
    """``(collection, word, df, cf, n_docs, idf)`` for every word of the corpus.

    One pass over the text; its frequencies are stored, as N is taken from them too.
    Without ``cf``, which not every use needs, that column is null and fewer rows are counted.
    """
    freqs = _corpus_frequencies(docs, normalizer, drop_empty, cf)
    return with_idf(stored(freqs, "frequencies"), flipped_idf)
