"""Joins and groupings that stay even when one key holds most rows.

Some keys of a text index are hot by nature: a collection may hold a third of the
corpus, a common word occurs in nearly every document, a popular query is asked over
and over. The rows of such a key are cut into slices before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one collection, or of one of a few words, are met in this many slices.
FIXED_SLICES = 64

# Rows of one key beyond this number go to further slices.
SLICE_ROWS = 1_000_000

# Key sets counted to be no larger than this are handed to every task.
BROADCAST_KEYS = 200_000

# No more than this many keys can be hot, which bounds what is broadcast.
HOT_KEYS = 100_000


def slice_of(key: Column, slices: Column) -> Column:
    """Slice number of a row, spread by the hash of ``key``; never null."""
    return F.coalesce(F.pmod(F.xxhash64(key), slices.cast("long")), F.lit(0).cast("long"))


def all_slices(slices: Column) -> Column:
    """One row per slice number."""
    return F.explode(F.sequence(F.lit(0).cast("long"), slices.cast("long") - 1))


def join_sliced(
    frame: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    how: str = "inner",
    slices: int = FIXED_SLICES,
    hint: str | None = None,
) -> DataFrame:
    """Join rows with facts that are few, but whose keys may own most of the rows.

    The facts are repeated per slice and the rows carry a slice number, so one hot
    key is joined in many tasks. There is no broadcast hint: adaptive execution
    turns this into a broadcast after it has measured the facts.
    """
    sliced = frame.withColumn("_slice", slice_of(F.col(spread_by), F.lit(slices)))
    repeated = facts.withColumn("_slice", all_slices(F.lit(slices)))
    return _equi_join(sliced, repeated, [*keys, "_slice"], how, hint).drop("_slice")


def join_by_frequency(
    frame: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    frequency: str,
    total_rows: int,
    largest: int,
    hint: str | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Join rows with facts that are many and tell how often their key occurs.

    A key is hot above ``slice_rows`` rows, or above ``total_rows / HOT_KEYS`` if
    that is more, so at most ``HOT_KEYS`` keys are hot. Only a 64-bit hash and a
    slice count per hot key are broadcast (16 bytes each); a hash shared by two
    keys gives both the same count and changes nothing else. All other keys keep
    one slice. ``total_rows`` and ``largest`` are the sum and maximum of the column
    ``frequency`` of ``facts``.
    """
    keys = list(keys)
    limit = max(slice_rows, -(-total_rows // HOT_KEYS))
    if largest <= limit:
        return _equi_join(frame, facts, keys, "inner", hint)
    hot = (
        facts.where(F.col(frequency) > limit)
        .groupBy(F.xxhash64(*keys).alias("_key"))
        .agg(F.ceil(F.max(frequency) / F.lit(limit)).alias("_slices"))
    )

    def with_slices(side: DataFrame) -> DataFrame:
        known = side.withColumn("_key", F.xxhash64(*keys))
        return known.join(F.broadcast(hot), "_key", "left").withColumn(
            "_slices", F.coalesce("_slices", F.lit(1).cast("long"))
        )

    sliced = with_slices(frame).withColumn("_slice", slice_of(F.col(spread_by), F.col("_slices")))
    repeated = with_slices(facts).withColumn("_slice", all_slices(F.col("_slices")))
    return _equi_join(
        sliced.drop("_key", "_slices"),
        repeated.drop("_key", "_slices"),
        [*keys, "_slice"],
        "inner",
        hint,
    ).drop("_slice")


def among(
    frame: DataFrame, keys: DataFrame, on: str, limit: int = BROADCAST_KEYS
) -> DataFrame:
    """Rows whose key is one of the distinct ``keys``.

    If there are counted to be few, every task gets them and the rows stay where
    they are; else both sides are shuffled.
    """
    few = keys.limit(limit + 1).count() <= limit
    return frame.join(F.broadcast(keys) if few else keys, on, "left_semi")


def _equi_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, hint: str | None
) -> DataFrame:
    return left.join(right.hint(hint) if hint else right, keys, how)


def file_digest(file: Column) -> Column:
    """The first 32 bits of the file's MD5, which any engine can repeat."""
    return F.conv(F.left(F.md5(file.cast("string")), F.lit(8)), 16, 10).cast("long")


def part_of(file: Column, rows: Column, part_rows: int) -> Column:
    """Part number of a file within a word that has ``rows`` files.

    Words with up to ``part_rows`` files have the single part 0. Larger ones are
    split by the digest of the file.
    """
    parts = F.ceil(rows / F.lit(part_rows))
    return F.when(parts > 1, F.pmod(file_digest(file), parts)).otherwise(F.lit(0).cast("long"))
