"""Posting lists that are stored: blocks of document numbers instead of names.

Documents are numbered in the order of their names. A word's list is cut into blocks of so many
entries, and a block is one row: its first number, the rising distances of all its documents from
it, their counts, and its largest share of a document. Distances are small rising integers, which
ORC keeps as packed differences.

Texts get their numbers before they are split, and a task gathers the entries of a word before it
hands them out, so entries are shuffled as lists, twice, and their words hardly at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termlode.operators.words import term_counts
from termlode.sources.corpus import in_collection
from termlode.sources.store import path_exists, release_shuffles, stored

# Documents of a block.
BLOCK_DOCUMENTS = 1024

# Names of documents of no more bytes than this are handed to every task, in rows of so many.
NAME_BYTES = 64 << 20
NAMES = 1 << 16

# Neighbouring documents whose entries of a word meet in one row before they are cut into blocks.
CHUNK_DOCUMENTS = 1 << 20

_LISTS = (
    "word string, block long, df long, cf long, first long, distances array<int>, "
    "counts array<int>, largest double, collection string"
)


def _write_numbers(docs: DataFrame, path: str) -> DataFrame:
    """Store ``(collection, file, number)`` of all documents; returns it with ``lead``.

    ``lead`` is true for one number of each name, so a document that has several counts once.
    """
    ordered = (
        docs.select("collection", "file")
        .repartitionByRange("collection", "file")
        .sortWithinPartitions("collection", "file")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    ordered.write.parquet(f"{path}/order")
    spark = docs.sparkSession
    kept = spark.read.schema(ordered.schema).parquet(f"{path}/order")
    task = F.shiftright("_at", 33).cast("int")
    sizes = {row[0]: row[1] for row in kept.groupBy(task).count().collect()}
    before, total = [], 0
    for number in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(number, 0)
    place = F.col("_at").bitwiseAND((1 << 33) - 1) + F.get(F.lit(before or [0]), task)
    kept.select("collection", "file", place.alias("number")).write.parquet(f"{path}/documents")
    numbers = load_numbers(spark, path, docs.schema["file"].dataType.simpleString())
    same = Window.partitionBy("collection", "file").orderBy("number")
    return numbers.withColumn("lead", F.row_number().over(same) == 1)


def load_numbers(spark: SparkSession, path: str, file_type: str = "string") -> DataFrame:
    """``(collection, file, number)`` of the documents of stored lists."""
    schema = f"collection string, file {file_type}, number long"
    return spark.read.schema(schema).parquet(f"{path}/documents")


def write_postings(
    docs: DataFrame,
    path: str,
    normalizer: str = "word_hyphen",
    drop_empty: bool = False,
    block_documents: int = BLOCK_DOCUMENTS,
) -> None:
    """Store the posting lists of a corpus below ``path``, which must be new.

    No list is gathered whole: a word in many documents is as many rows as its frequency
    calls for, and on the way there one for each ``CHUNK_DOCUMENTS`` documents.
    (collection, file) must be unique.
    """
    if path_exists(docs.sparkSession, path):
        raise ValueError(f"{path} is there already")
    _write_lists(docs, path, normalizer, drop_empty, block_documents)
    release_shuffles(docs.sparkSession)


def _write_lists(
    docs: DataFrame, path: str, normalizer: str, drop_empty: bool, block_documents: int
) -> None:
    texts = docs.join(_write_numbers(docs, path), ["collection", "file"]).select(
        "collection", F.struct("number", "lead").alias("file"), "text"
    )
    # A second number of a document that has several is told by its sign; see _write_numbers.
    place = F.col("file.number") - F.col("chunk") * CHUNK_DOCUMENTS
    signed = F.when(F.col("file.lead"), place).otherwise(-1 - place)
    # Lists of numbers of four bytes; none is null, so the lists of a row go in step.
    gathered = (
        term_counts(texts, normalizer, drop_empty)
        .withColumn("chunk", F.floor(F.col("file.number") / F.lit(CHUNK_DOCUMENTS)))
        .groupBy("collection", "word", "chunk")
        .agg(
            F.collect_list(signed.cast("int")).alias("place"),
            F.collect_list(F.col("count").cast("int")).alias("count"),
            F.collect_list(F.col("word_count").cast("int")).alias("word_count"),
        )
    )
    chunks = stored(gathered, "chunks")
    release_shuffles(docs.sparkSession)
    # Dealt before it is worked on, since the rows to be dealt by range are also read for a sample.
    chunks = chunks.repartitionByRange("collection", "word")
    entries = F.arrays_zip(
        F.transform("place", lambda p: F.when(p < 0, -1 - p).otherwise(p)).alias("place"),
        F.col("count"),
        F.col("word_count"),
    )
    own = F.filter(F.arrays_zip("place", "count"), lambda e: e["place"] >= 0)
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("entries") - 1) / F.lit(block_documents)).cast("int")),
        lambda piece: F.slice("entries", piece * block_documents + 1, F.lit(block_documents)),
    )
    # What is known of a chunk goes with its first block.
    leads = F.when(F.col("at") == 0, F.col("own"))
    first = F.col("piece")[0]["place"]
    shares = F.transform("piece", lambda e: e["count"] / e["word_count"])
    lists = (
        chunks.select(
            "collection", "word", "chunk", own.alias("own"), F.sort_array(entries).alias("entries")
        )
        .select("collection", "word", "chunk", "own", F.posexplode(pieces).alias("at", "piece"))
        .select(
            "collection",
            "word",
            F.coalesce(F.size(leads), F.lit(0)).cast("long").alias("df"),
            F.aggregate(leads, F.lit(0).cast("long"), lambda n, e: n + e["count"]).alias("cf"),
            (F.col("chunk") * CHUNK_DOCUMENTS + first).alias("first"),
            F.transform("piece", lambda e: e["place"] - first).alias("distances"),
            F.transform("piece", lambda e: e["count"]).alias("counts"),
            F.array_max(shares).alias("largest"),
        )
    )
    of_word = Window.partitionBy("collection", "word").orderBy("first")
    every = of_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    (
        lists.select(
            "collection",
            "word",
            (F.row_number().over(of_word) - 1).cast("long").alias("block"),
            F.sum("df").over(every).alias("df"),
            F.sum("cf").over(every).alias("cf"),
            "first",
            "distances",
            "counts",
            "largest",
        )
        .write.partitionBy("collection")
        .option("compression", "zstd")
        .orc(f"{path}/lists")
    )


def load_lists(
    spark: SparkSession,
    path: str,
    collection: str | None = None,
    words: Sequence[str] | None = None,
) -> DataFrame:
    """The stored blocks, of some words if any are given; these are pushed to the reader."""
    lists = in_collection(spark.read.schema(_LISTS).orc(f"{path}/lists"), collection)
    return lists if words is None else lists.where(F.col("word").isin(sorted(set(words))))


def load_postings(
    spark: SparkSession,
    path: str,
    collection: str | None = None,
    words: Sequence[str] | None = None,
    file_type: str = "string",
) -> DataFrame:
    """``(collection, word, file, count, df, cf)``, the stored lists with names of documents."""
    lists = load_lists(spark, path, collection, words)
    entries = lists.select(
        "collection",
        "word",
        "df",
        "cf",
        F.inline(
            F.zip_with(
                "distances",
                "counts",
                lambda d, n: F.struct((F.col("first") + d).alias("number"), n.cast("long").alias("count")),
            )
        ),
    )
    numbers = load_numbers(spark, path, file_type)
    size = numbers.agg(F.sum(8 + F.coalesce(F.octet_length(F.col("file").cast("string")), F.lit(0))))
    if (size.first()[0] or 0) > NAME_BYTES:
        named = entries.join(in_collection(numbers, collection).drop("collection"), "number")
    else:
        # The entries of a word stay together; names are found by their places.
        rows = F.floor(F.col("number") / F.lit(NAMES)).alias("row")
        listed = F.sort_array(F.collect_list(F.struct("number", "file")))
        names = numbers.groupBy(rows).agg(F.transform(listed, lambda e: e["file"]).alias("names"))
        named = entries.withColumn("row", rows).join(F.broadcast(names), "row").withColumn(
            "file", F.get("names", (F.col("number") - F.col("row") * NAMES).cast("int"))
        )
    return named.select("collection", "word", "file", "count", "df", "cf")
