"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.sources.store import scratch_path

# Facts counted to have no more bytes than this are broadcast.
BROADCAST_BYTES = 8_000_000


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back; cuts the lineage."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def documents_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of any table that has these columns; others are left out."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    )


KEY = "__rid"


def with_key(docs: DataFrame) -> DataFrame:
    """All columns and ``__rid``, a row key that is unique and never null.

    The key follows the order of (doc_id, text), null first. Where doc_id already
    is unique and not null it is the key itself and nothing is sorted. Otherwise
    the table is sorted and numbered once, and stored, so that later reads see the
    same numbers; the last sort key only spreads equal rows over tasks.
    """
    number = F.col("doc_id").cast("long")
    repeated = docs.groupBy(number.alias("id")).agg(F.count(F.lit(1)).alias("n"))
    if repeated.where("n > 1 OR id IS NULL").isEmpty():
        return docs.withColumn(KEY, number)
    ordered = docs.orderBy(
        number.asc_nulls_first(), F.col("text").asc_nulls_first(), F.rand(1)
    )
    return stored(ordered.withColumn(KEY, F.monotonically_increasing_id()), "keyed")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``(rid, doc_id, text)`` of a table that has been through :func:`with_key`."""
    return docs.select(
        F.col(KEY).alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def keyed(docs: DataFrame) -> DataFrame:
    """``(rid, doc_id, text)``, the rows under the key of :func:`with_key`."""
    return keyed_rows(with_key(documents_of(docs)))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of a keyed table whose key is not among ``dropped`` (rid), key removed."""
    gone = dropped.select(F.col("rid").alias(KEY))
    return small_join(docs, gone, KEY, "left_anti").drop(KEY)


def small_join(
    frame: DataFrame, facts: DataFrame, key: str, how: str = "inner", row_bytes=8
) -> DataFrame:
    """Join with facts that are broadcast only if their bytes are counted to be few.

    ``row_bytes``, a number or a column, says how many a row has. More facts are shuffled
    with the frame, where adaptive execution splits what is skewed.
    """
    size = facts.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0]
    few = (size or 0) <= BROADCAST_BYTES
    return frame.join(F.broadcast(facts) if few else facts, key, how)


def row_blocks(docs: DataFrame, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` of text the rows are dealt into.

    Never fewer than the shuffle partitions, so that every task gets some.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = docs.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // block_bytes))
