"""Collections that grow: documents are added without building anything anew.

What is stored adds up. An addition has its own entries with their term frequency, its documents,
and its statistics: documents per collection, and how many hold each word. N and df are sums
over additions and idf is formed when it is asked for, so a collection of several additions weighs
its words as one build of all its documents would.

Norms move whenever N or a df does. With idf = ln N - ln df, the squared norm of a document is
A ln^2 N - 2 B ln N + C with A = sum tf^2, B = sum tf^2 ln df and C = sum tf^2 ln^2 df. N is one
number, and only documents that hold a word of the addition get new B and C.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.functions.weights import idf as idf_column
from termlode.functions.weights import tf as tf_column
from termlode.operators.skew import BROADCAST_KEYS, join_by_frequency, join_sliced
from termlode.operators.vocabulary import frequencies
from termlode.operators.words import term_counts
from termlode.sources.corpus import in_collection
from termlode.sources.store import path_exists, stored

WORD_KEY = ["collection", "word"]
FILE_KEY = ["collection", "file"]

_STATISTICS = "word string, df long, cf long, addition string, collection string"


def _entries_schema(file_type: str) -> str:
    return f"word string, file {file_type}, tf double, addition string, collection string"


def _documents_schema(file_type: str) -> str:
    return f"file {file_type}, addition string, collection string"


def additions(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished additions of a store, in the order they were made.

    Statistics are written last, so an addition that broke off has none and is not read.
    """
    if not path_exists(spark, f"{path}/statistics"):
        return []
    found = spark.read.schema(_STATISTICS).parquet(f"{path}/statistics").select("addition")
    return sorted(row[0] for row in found.distinct().collect())


def _finished(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    table = spark.read.schema(schema).format("orc" if part == "entries" else "parquet")
    return table.load(f"{path}/{part}").where(F.col("addition").isin(additions(spark, path)))


def documents_added(spark: SparkSession, path: str, file_type: str = "string") -> DataFrame:
    """``(collection, file, addition)`` of all documents of a store."""
    return _finished(spark, path, "documents", _documents_schema(file_type)).select(
        *FILE_KEY, "addition"
    )


def _refuse_repeated(new: DataFrame, path: str, file_type: str) -> None:
    spark = new.sparkSession
    if not new.where("collection IS NULL OR collection = ''").isEmpty():
        raise ValueError("a collection without a name cannot be stored")
    twice = new.groupBy(*FILE_KEY).count().where("count > 1")
    if additions(spark, path):
        known = documents_added(spark, path, file_type).select(*FILE_KEY)
        twice = twice.select(*FILE_KEY).unionByName(new.join(known, FILE_KEY, "left_semi"))
    first = twice.select(*FILE_KEY).first()
    if first is not None:
        raise ValueError(f"already in {path}, or given twice: {first['collection']}, {first['file']}")


def add_documents(
    docs: DataFrame,
    path: str,
    normalizer: str = "word_hyphen",
    tf: str = "ratio",
    drop_empty: bool = False,
) -> str:
    """Add documents ``(collection, file, text)`` to a store; returns the addition's name.

    Nothing that is stored is read but the names of its documents, and nothing is written
    anew: a document that is there, or is given twice, is refused. Collections may be new.
    All additions of a store need the same options.
    """
    spark = docs.sparkSession
    file_type = docs.schema["file"].dataType.simpleString()
    new = docs.select(*FILE_KEY)
    _refuse_repeated(new, path, file_type)
    name = f"{len(additions(spark, path)):06}-{uuid.uuid4().hex[:8]}"
    # Kept, as ranges of words are cut after a look at them: else the texts are split thrice.
    marked = stored(term_counts(docs, normalizer, drop_empty, markers=True), "counts")
    counts = marked.where("word IS NOT NULL")
    (
        counts.select(*WORD_KEY, "file", tf_column(tf).alias("tf"))
        .repartitionByRange("collection", "word", F.xxhash64("file"))
        .sortWithinPartitions("collection", "word", "file")
        .withColumn("addition", F.lit(name))
        .write.mode("append")
        .option("orc.bloom.filter.columns", "word")
        .partitionBy("collection", "addition")
        .orc(f"{path}/entries")
    )
    _append(new, name, f"{path}/documents")
    _append(
        frequencies(marked).repartitionByRange(*WORD_KEY).sortWithinPartitions(*WORD_KEY),
        name,
        f"{path}/statistics",
    )
    return name


def _append(frame: DataFrame, addition: str, path: str) -> None:
    named = frame.withColumn("addition", F.lit(addition))
    named.write.mode("append").partitionBy("collection", "addition").parquet(path)


def growing_vocabulary(
    spark: SparkSession,
    path: str,
    collection: str | None = None,
    words: Sequence[str] | None = None,
    flipped_idf: bool = False,
    upto: Sequence[str] | None = None,
) -> DataFrame:
    """``(collection, word, df, cf, n_docs, idf)``, the additions' statistics summed.

    ``words`` reads those only; ``upto`` counts the named additions alone.
    """
    table = in_collection(_finished(spark, path, "statistics", _STATISTICS), collection)
    if upto is not None:
        table = table.where(F.col("addition").isin(list(upto)))
    # The row of the null word counts the documents.
    asked = F.col("word").isNotNull() if words is None else F.col("word").isin(list(words))
    sizes = table.where("word IS NULL").groupBy("collection").agg(F.sum("df").alias("n_docs"))
    sums = table.where(asked).groupBy(*WORD_KEY).agg(
        F.sum("df").alias("df"), F.sum("cf").alias("cf")
    )
    return join_sliced(sums, sizes, ["collection"], spread_by="word").select(
        *WORD_KEY, "df", "cf", "n_docs", idf_column(flipped_idf).alias("idf")
    )


def _weighted(entries: DataFrame, vocabulary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Entries with columns of their word; common words are dealt over many tasks."""
    known = stored(vocabulary, "vocabulary")
    total, largest = known.agg(F.sum("df"), F.max("df")).first()
    facts = known.select(*WORD_KEY, *dict.fromkeys(["df", *columns]))
    return join_by_frequency(
        entries, facts, WORD_KEY, "file", "df", total_rows=total or 0, largest=largest or 0
    )


def load_growing(
    spark: SparkSession,
    path: str,
    collection: str | None = None,
    words: Sequence[str] | None = None,
    file_type: str = "string",
    flipped_idf: bool = False,
) -> DataFrame:
    """The index ``(collection, word, file, idf, tf_idf)`` of all that was added so far.

    With ``words``, such as ``query_words(query)``, their entries alone are read, from the
    files and row groups that can hold them.
    """
    schema = _entries_schema(file_type)
    entries = in_collection(_finished(spark, path, "entries", schema), collection)
    if words is not None:
        words = sorted(set(words))
        entries = entries.where(F.col("word").isin(words))
    vocabulary = growing_vocabulary(spark, path, collection, words, flipped_idf)
    weighted = _weighted(entries.select(*WORD_KEY, "file", "tf"), vocabulary, ["idf"])
    return weighted.select(*WORD_KEY, "file", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf"))


def _norm_parts(entries: DataFrame, vocabulary: DataFrame) -> DataFrame:
    square, log = F.col("tf") * F.col("tf"), F.log("df")
    weighted = _weighted(entries.select(*WORD_KEY, "file", "tf"), vocabulary, [])
    return weighted.groupBy(*FILE_KEY).agg(
        F.sum(square).alias("a"),
        F.sum(square * log).alias("b"),
        F.sum(square * log * log).alias("c"),
    )


def update_norm_parts(
    spark: SparkSession, path: str, file_type: str = "string"
) -> tuple[DataFrame, int]:
    """Bring the stored parts of the norms up to all additions; returns them and how many
    documents of earlier additions had to be summed anew.

    Those are the documents that hold a word whose df has changed: they are found in the
    entries of these words. All others keep their parts, whatever N has become.
    """
    done_at = f"{path}/norms"
    every = additions(spark, path)
    done = _norm_versions(spark, done_at)
    covered = done[-1].split("_")[-1] if done else None
    old = [name for name in every if covered is not None and name <= covered]
    new = [name for name in every if name not in old]
    if not new:
        return _read_parts(spark, done_at, done[-1], file_type), 0
    entries = _finished(spark, path, "entries", _entries_schema(file_type))
    vocabulary = growing_vocabulary(spark, path)
    documents = documents_added(spark, path, file_type)
    fresh = documents.where(F.col("addition").isin(new)).select(*FILE_KEY)
    kept, moved = None, 0
    if old:
        statistics = _finished(spark, path, "statistics", _STATISTICS)
        changed = (
            statistics.where(F.col("addition").isin(new) & F.col("word").isNotNull())
            .select(*WORD_KEY)
            .distinct()
        )
        before = entries.where(F.col("addition").isin(old))
        few = changed.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
        touched = stored(
            before.join(F.broadcast(changed) if few else changed, WORD_KEY, "left_semi")
            .select(*FILE_KEY)
            .distinct(),
            "touched",
        )
        moved = touched.count()
        parts = _read_parts(spark, done_at, done[-1], file_type)
        kept = parts.join(touched, FILE_KEY, "left_anti")
        fresh = fresh.unionByName(touched)
    parts = _norm_parts(entries.join(fresh, FILE_KEY, "left_semi"), vocabulary)
    summed = fresh.join(parts, FILE_KEY, "left").fillna(0.0, ["a", "b", "c"])
    version = f"{len(done):06}_{every[-1]}"
    whole = summed if kept is None else summed.unionByName(kept)
    whole.withColumn("version", F.lit(version)).write.mode("append").partitionBy(
        "version", "collection"
    ).parquet(done_at)
    return _read_parts(spark, done_at, version, file_type), moved


def _norm_versions(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    found = spark.read.schema("version string").parquet(path).select("version").distinct()
    return sorted(row[0] for row in found.collect())


def _read_parts(spark: SparkSession, path: str, version: str, file_type: str) -> DataFrame:
    schema = f"file {file_type}, a double, b double, c double, version string, collection string"
    found = spark.read.schema(schema).parquet(path).where(F.col("version") == version)
    return found.select(*FILE_KEY, "a", "b", "c")


def growing_norms(
    spark: SparkSession, path: str, file_type: str = "string", collection: str | None = None
) -> DataFrame:
    """``(collection, file, norm)`` of every document added, for :func:`cosine`."""
    parts, _ = update_norm_parts(spark, path, file_type)
    table = _finished(spark, path, "statistics", _STATISTICS).where("word IS NULL")
    sizes = table.groupBy("collection").agg(F.sum("df").alias("n_docs"))
    log = F.log("n_docs")
    # Rounding may leave a zero norm a little below zero.
    square = F.col("a") * log * log - 2 * F.col("b") * log + F.col("c")
    square = F.when(square <= F.col("a") * log * log * 1e-13, 0.0).otherwise(square)
    return join_sliced(
        in_collection(parts, collection), sizes, ["collection"], spread_by="file"
    ).select(*FILE_KEY, F.sqrt(square).alias("norm"))
