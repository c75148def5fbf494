"""Index and document stores."""

from __future__ import annotations

import functools
import gc
import tempfile
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.sources.corpus import in_collection

# Files of the words of a query are looked up for so many ranges of them at most.
MOST_RANGES = 10_000

INDEX_COLUMNS = ("collection", "word", "file", "idf", "tf_idf")

_made: list[str] = []


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="termlode-")


def _scratch_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if context.master.split("[")[0] == "local":
        return _own_folder()
    raise ValueError(
        "executors need a shared folder for intermediate tables: set spark.checkpoint.dir, "
        "call setCheckpointDir, or pass scratch="
    )


def scratch_path(spark: SparkSession, name: str, scratch: str | None = None) -> str:
    """A new path for an intermediate table, in a folder that all executors share.

    That is ``scratch`` if given, else ``spark.checkpoint.dir``, else the context's
    checkpoint directory. Only a local master gets a temporary folder of its own.
    """
    folder = scratch or _scratch_folder(spark)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def delete_scratch(spark: SparkSession) -> int:
    """Delete all paths this process got from :func:`scratch_path`; returns how many were there.

    Frames that still read them fail afterwards.
    """
    deleted = 0
    while _made:
        deleted += _hadoop(spark, _made.pop(), lambda system, path: system.delete(path, True))
    return deleted


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to a scratch path and read it back."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of frames that nobody holds any longer.

    Its cleaner does so once the driver's collector has found them, which with a large heap may
    be long after the result was stored.
    """
    for _ in range(2):
        # A job hands over what the one before still holds.
        gc.collect()
        spark.range(1).count()
        spark.sparkContext._jvm.System.gc()


def _hadoop(spark: SparkSession, path: str, action):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return action(where.getFileSystem(context._jsc.hadoopConfiguration()), where)


def path_exists(spark: SparkSession, path: str) -> bool:
    return _hadoop(spark, path, lambda system, where: system.exists(where))


def stored_collections(spark: SparkSession, path: str) -> set[str]:
    """Names of the collections of a store; none where there is no store yet."""
    if not path_exists(spark, path):
        return set()
    names = spark.read.schema("word string, collection string").orc(path).select("collection")
    return {row[0] for row in names.distinct().collect()}


def write_index(
    index: DataFrame,
    path: str,
    mode: str = "errorifexists",
    collections: DataFrame | None = None,
) -> None:
    """Write the index as ORC, one directory per collection, sorted by word and file.

    Other collections of the store are left alone. ``errorifexists`` refuses a
    collection that is there, ``overwrite`` replaces it; there is no appending to one.
    ``collections`` may name those of the index in a column of that name, else they
    are taken from the index itself. A collection needs a name: null and ``''`` are
    refused. Sorted files let the row-group statistics skip all but the asked-for
    words; the Bloom filter spares the read where a word only falls inside a range.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r} is neither 'errorifexists' nor 'overwrite'")
    spark = index.sparkSession
    names = (index if collections is None else collections).select("collection").distinct()
    new = {row[0] for row in names.collect()}
    if not all(new):
        raise ValueError("a collection without a name cannot be stored")
    clash = new & stored_collections(spark, path) if mode == "errorifexists" else set()
    if clash:
        raise ValueError(f"already in {path}: {', '.join(sorted(clash))}")
    (
        index.select(*INDEX_COLUMNS)
        .sortWithinPartitions("collection", "word", "file")
        .write.mode("append" if mode == "errorifexists" else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("orc.bloom.filter.columns", "word")
        .partitionBy("collection")
        .orc(path)
    )


def load_index(
    spark: SparkSession,
    path: str,
    collection: str | None = None,
    file_type: str = "string",
    cache: bool = False,
) -> DataFrame:
    """Read a stored index back, pruned to one collection if one is named.

    ``cache`` marks it for lazy persistence: the first query, or :func:`warm`,
    fills the cache and later queries of the session use it.
    """
    schema = f"word string, file {file_type}, idf double, tf_idf double, collection string"
    index = in_collection(spark.read.schema(schema).orc(path), collection).select(*INDEX_COLUMNS)
    return index.persist(StorageLevel.MEMORY_AND_DISK) if cache else index


def word_files(
    spark: SparkSession, vocab_path: str, words: Sequence[str], collection: str | None = None
) -> list[int] | None:
    """Numbers of the files that hold the words, from the vocabulary of the store.

    They are ranges, one per word and collection, and come to the driver as such; None if
    there are more than ``MOST_RANGES``, where looking files up is no saving.
    """
    schema = "word string, first_file int, last_file int, collection string"
    known = in_collection(spark.read.schema(schema).parquet(vocab_path), collection)
    ranges = (
        known.where(F.col("word").isin(sorted(set(words))))
        .select("first_file", "last_file")
        .distinct()
        .limit(MOST_RANGES + 1)
        .collect()
    )
    if len(ranges) > MOST_RANGES or sum(b - a for a, b in ranges) > MOST_RANGES:
        return None
    return sorted({number for first, last in ranges for number in range(first, last + 1)})


def load_words(
    spark: SparkSession,
    path: str,
    vocab_path: str,
    words: Sequence[str],
    collection: str | None = None,
    file_type: str = "string",
) -> DataFrame:
    """The entries of some words, reading the files that hold them and no footer of another.

    ``path`` and ``vocab_path`` are those of one :func:`index_corpus`. The number of a file
    is in its name, and a condition on names is applied to the listing, before any file is
    opened. The words are pushed to the reader as well.
    """
    index = load_index(spark, path, collection, file_type)
    numbers = word_files(spark, vocab_path, words, collection)
    if numbers is not None:
        names = [f"part-{number:05d}" for number in numbers]
        named = F.substring_index(F.col("_metadata.file_name"), "-", 2).isin(names)
        schema = f"word string, file {file_type}, idf double, tf_idf double, collection string"
        index = in_collection(spark.read.schema(schema).orc(path), collection)
        index = index.where(named if names else F.lit(False)).select(*INDEX_COLUMNS)
    return index.where(F.col("word").isin(sorted(set(words))))


def warm(index: DataFrame) -> int:
    """Fill the cache of a loaded index and return its number of entries."""
    return index.count()


def write_beside(facts: DataFrame, path: str) -> None:
    """Write norms or a vocabulary as Parquet by collection; the collections written are replaced."""
    (
        facts.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("collection")
        .parquet(path)
    )


def load_norms(spark: SparkSession, path: str, file_type: str = "string") -> DataFrame:
    """``(collection, file, norm)`` of every document of a store."""
    schema = f"file {file_type}, norm double, collection string"
    return spark.read.schema(schema).parquet(path).select("collection", "file", "norm")


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``(collection, word, df, n_docs, idf)`` of a store."""
    schema = "word string, df long, n_docs long, idf double, collection string"
    found = spark.read.schema(schema).parquet(path)
    return found.select("collection", "word", "df", "n_docs", "idf")


def write_clean(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write cleaned ``(filename, content)`` documents as Parquet."""
    documents.select("filename", "content").write.mode(mode).parquet(path)


def load_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("filename string, content string").parquet(path)
