"""Nested forms of the index: posting lists, term maps, document vectors.

The flat index is the main table. A word's list is cut into parts of bounded size,
because the list of a common word is as long as the corpus and must not end up in
one row of one task; the parts of a word together are the whole list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.operators.skew import file_digest, part_of

PART_ROWS = 100_000


def inverted_index(weighted: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``(collection, word, part, files)``: every file once per occurrence, sorted.

    No part has more than ``part_rows`` entries. A word that occurs more often is
    dealt into buckets by a digest of the file, about half full each, and a bucket is
    cut into pieces along its running count, within a file if need be.
    """
    buckets = F.when(F.col("cf") > part_rows, F.ceil(2 * F.col("cf") / F.lit(part_rows))).otherwise(
        F.lit(1).cast("long")
    )
    size = F.lit(part_rows).cast("long")
    # Entries of a bucket are gathered before they are shuffled, so its word goes with them once.
    bucketed = (
        weighted.select("collection", "word", "file", "count", buckets.alias("buckets"))
        .withColumn("bucket", F.pmod(file_digest(F.col("file")), F.col("buckets")))
        .groupBy("collection", "word", "bucket")
        .agg(
            F.max("buckets").alias("buckets"),
            F.sum("count").alias("total"),
            F.collect_list("file").alias("file"),
            F.collect_list(F.col("count").cast("int")).alias("count"),
        )
        .withColumn("entries", F.sort_array(F.arrays_zip("file", "count")))
    )
    # Only a bucket that is too long for one piece is taken apart again.
    whole = F.col("total") <= size
    singles = F.transform("entries", lambda e: F.array(e))
    running = (
        Window.partitionBy("collection", "word", "bucket")
        .orderBy("file")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pieces = (
        bucketed.withColumn("run", F.explode(F.when(whole, F.array("entries")).otherwise(singles)))
        .select(
            "collection",
            "word",
            "bucket",
            "buckets",
            "run",
            F.col("run")[0]["file"].alias("file"),
            F.when(whole, F.col("total")).otherwise(F.col("run")[0]["count"].cast("long")).alias("count"),
        )
        .withColumn("end", F.sum("count").over(running))
        .withColumn("begin", F.col("end") - F.col("count"))
        .withColumn(
            "piece",
            F.explode(
                F.sequence(F.floor(F.col("begin") / size), F.floor((F.col("end") - 1) / size))
            ),
        )
        .withColumn(
            "count",
            F.least(F.col("end"), (F.col("piece") + 1) * size)
            - F.greatest(F.col("begin"), F.col("piece") * size),
        )
    )
    repeated = F.when(
        F.size("run") > 1,
        F.flatten(F.transform("run", lambda e: F.array_repeat(e["file"], e["count"]))),
    ).otherwise(F.array_repeat("file", F.col("count").cast("int")))
    runs = F.sort_array(F.collect_list(F.struct("file", repeated.alias("files"))))
    return (
        pieces.groupBy("collection", "word", "bucket", "piece")
        .agg(
            F.max("buckets").alias("buckets"),
            F.flatten(F.transform(runs, lambda run: run["files"])).alias("files"),
        )
        .select(
            "collection",
            "word",
            (F.col("bucket") + F.col("buckets") * F.col("piece")).alias("part"),
            "files",
        )
    )


def term_map(weighted: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``(collection, word, idf, part, scores)`` with a map from file to weight."""
    return (
        weighted.withColumn("part", part_of(F.col("file"), F.col("df"), part_rows))
        .groupBy("collection", "word", "idf", "part")
        .agg(F.map_from_entries(F.collect_list(F.struct("file", "tf_idf"))).alias("scores"))
    )


def doc_vectors(index: DataFrame) -> DataFrame:
    """``(collection, file, vector)`` with a map from word to weight.

    A vector is no longer than its document, which already is a single row.
    """
    return index.groupBy("collection", "file").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "tf_idf"))).alias("vector")
    )
