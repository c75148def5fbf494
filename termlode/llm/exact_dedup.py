"""Exact duplicates by progressive refinement, in built-in functions only.

Rows are told apart by length, the survivors by a hash of their first bytes, and only
those still tied by the digest of the full content. One scan of the text writes the three
keys as columns, so each level reads just its own, and digests are compared, and shuffled,
for tied rows only. Each level counts its groups with a combine in every task: a group of
any size is one row per task there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import keyed, keyed_rows, small_join, stored, with_key, without
from termlode.operators.skew import join_by_frequency

PREFIX_BYTES = 64
KEYS = ["size", "prefix", "text_sha256"]


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, rid)``, one row per row of ``docs``.

    Texts are equal when identical; null counts as empty. Of equal texts the row with
    the largest doc_id stays. Where doc_id is null or repeated, rows are ordered by
    (doc_id, text), null first, and exactly one row of a group, the last, stays.
    Columns other than doc_id and text are ignored; an empty table gives an empty
    result.
    """
    return exact_duplicate_rows(keyed(docs))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_duplicates` keeps."""
    named = with_key(docs)
    return without(named, exact_duplicate_rows(keyed_rows(named)).where("NOT kept"))


def exact_duplicate_rows(keyed_docs: DataFrame) -> DataFrame:
    """:func:`exact_duplicates` of keyed rows ``(rid, doc_id, text)``."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        keyed_docs.select(
            "rid",
            "doc_id",
            F.octet_length(text).alias("size"),
            F.xxhash64(F.substring(F.encode(text, "utf-8"), 1, PREFIX_BYTES)).alias("prefix"),
            F.sha2(text, 256).alias("text_sha256"),
        ),
        "digests",
    )
    # Level 1: lengths that occur more than once. Level 2: among those, length and prefix.
    lengths = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = small_join(rows, lengths.select("size", F.lit(True).alias("sized")), "size", "left")
    prefixes = stored(
        sized.where("sized").groupBy("size", "prefix").agg(F.count(F.lit(1)).alias("alike")),
        "prefixes",
    )
    total, largest = prefixes.agg(F.sum("alike"), F.max("alike")).first()
    refined = join_by_frequency(
        sized.where("sized").drop("sized"),
        prefixes,
        ["size", "prefix"],
        spread_by="rid",
        frequency="alike",
        total_rows=total or 0,
        largest=largest or 0,
    )
    marked = stored(
        refined.unionByName(
            sized.where("sized IS NULL").drop("sized").withColumn("alike", F.lit(1).cast("long"))
        ),
        "marked",
    )
    # Level 3: digests, of what is still tied.
    survivors = marked.where("alike > 1").drop("alike")
    groups = stored(
        survivors.groupBy(*KEYS).agg(
            F.max("rid").alias("keep_rid"),
            F.max_by("doc_id", "rid").alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
        ),
        "groups",
    )
    total, largest = groups.agg(F.sum("group_size"), F.max("group_size")).first()
    grouped = join_by_frequency(
        survivors,
        groups,
        KEYS,
        spread_by="rid",
        frequency="group_size",
        total_rows=total or 0,
        largest=largest or 0,
    )
    alone = marked.where("alike = 1").select(
        *rows.columns,
        F.col("rid").alias("keep_rid"),
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
    )
    return (
        grouped.unionByName(alone)
        .withColumn("kept", F.col("rid") == F.col("keep_rid"))
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256", "rid")
    )
