"""Answering a whole table of queries in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.functions.text import clean
from termlode.operators.skew import (
    BROADCAST_KEYS,
    FIXED_SLICES,
    SLICE_ROWS,
    among,
    join_by_frequency,
)
from termlode.plans.search import coordinated_score, rank_order
from termlode.sources.corpus import in_collection
from termlode.sources.store import stored

# Up to so many collections named by queries are handed to the reader.
MOST_SCOPES = 1000

# Query terms of up to this many bytes of text in all are broadcast.
BROADCAST_BYTES = 2 << 20


def _reason():
    return (
        F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, "query missing")
        .when(F.col("amount").isNull(), "amount missing")
    )


def reject_invalid(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``(query_id, text, amount)`` into answerable and rejected rows.

    Rejected rows carry a ``reason``; a missing text is named before a missing amount.
    """
    judged = queries.withColumn("reason", _reason())
    return (
        judged.where(F.col("reason").isNull()).drop("reason"),
        judged.where(F.col("reason").isNotNull()),
    )


def _matches(
    searched: DataFrame, terms: DataFrame, counted: DataFrame, broadcast: bool, slice_rows: int
) -> DataFrame:
    """Index entries with the texts that ask for their word.

    Beyond a broadcast both sides are shuffled, a word in as many slices as its
    entries, which are counted, call for.
    """
    if broadcast:
        return searched.join(F.broadcast(terms), "word")
    total, largest = counted.agg(F.sum("entries"), F.max("entries")).first()
    return join_by_frequency(
        searched,
        terms.join(counted, "word"),
        ["word"],
        spread_by="file",
        frequency="entries",
        total_rows=total or 0,
        largest=largest or 0,
        hint="merge",
        slice_rows=slice_rows,
    ).drop("entries")


def _asked_for(index: DataFrame, terms: DataFrame, broadcast_keys: int) -> DataFrame:
    """Index entries of words that are asked for in their collection.

    If every text names its collection and these are few, no other is read. A word that is
    asked for in one collection is not taken from the others.
    """
    scopes = terms.select("scope").distinct().limit(MOST_SCOPES + 1).collect()
    names = sorted(row["scope"] for row in scopes)
    if names in ([], [""]):
        return among(index, terms.select("word").distinct(), "word", broadcast_keys)
    if "" not in names and len(names) <= MOST_SCOPES:
        index = index.where(F.col("collection").isin(names))
    asked = terms.select("scope", F.col("word").alias("asked")).distinct()
    few = asked.limit(broadcast_keys + 1).count() <= broadcast_keys
    return index.join(
        F.broadcast(asked) if few else asked,
        (F.col("word") == F.col("asked"))
        & ((F.col("scope") == "") | (F.col("scope") == F.col("collection"))),
        "left_semi",
    )


def search_batch(
    index: DataFrame,
    queries: DataFrame,
    collection: str | None = None,
    compat: bool = False,
    normalize_query: bool = False,
    slice_rows: int = SLICE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    broadcast_keys: int = BROADCAST_KEYS,
    store_entries: bool = False,
) -> DataFrame:
    """Top ``amount`` documents of every valid query; ``query_id`` must be unique.

    Returns ``(query_id, rank, collection, file, score)``. A column ``collection`` of
    the queries, where not null, restricts that query to it. ``compat`` ranks the row
    of nulls that stands for unknown words after all documents; ``normalize_query``
    cleans the texts like documents. ``store_entries`` keeps the index entries of the words
    asked for as a table: an index that is not loaded but built would be built for each of
    their uses.

    Equal texts are scored once, for the largest amount asked, and the result is handed
    to each of them. The index comes down to the words asked for before anything is
    shuffled. Scores are formed and ranked once per (text, slice of the documents) in
    one exchange, where each slice keeps the amount of its own text, and the survivors
    are ranked once more per text.
    """
    valid, _ = reject_invalid(queries)
    text = clean(F.col("text")) if normalize_query else F.lower("text")
    scope = F.col("collection") if "collection" in queries.columns else F.lit(None)
    asked = stored(
        valid.select(
            "query_id",
            F.col("amount").cast("long").alias("amount"),
            text.alias("text"),
            F.coalesce(scope.cast("string"), F.lit("")).alias("scope"),
        ),
        "asked",
    )
    texts = stored(
        asked.groupBy("text", "scope").agg(
            F.min("query_id").alias("text_id"),
            F.max("amount").alias("most"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "texts",
    )
    total_rows, largest, text_bytes = (
        number or 0
        for number in texts.agg(
            F.sum("copies"), F.max("copies"), F.sum(F.octet_length("text"))
        ).first()
    )
    words = texts.select("text_id", "most", "scope", F.split("text", " ").alias("words"))
    terms = words.select(
        "text_id",
        "most",
        "scope",
        F.size("words").alias("total_words"),
        F.explode(F.array_distinct("words")).alias("word"),
    )
    searched = _asked_for(in_collection(index, collection), terms, broadcast_keys)
    if store_entries:
        searched = stored(searched, "searched")
    counted = stored(searched.groupBy("word").agg(F.count(F.lit(1)).alias("entries")), "entries")
    matched = _matches(searched, terms, counted, text_bytes <= broadcast_bytes, slice_rows).where(
        "scope IN ('', collection)"
    )
    # A text of common words reaches about as many documents as its commonest word.
    reached = counted.agg(F.max("entries")).first()[0] or 0
    slices = max(FIXED_SLICES, -(-reached // slice_rows))
    scores = (
        matched.withColumn("_slice", F.pmod(F.xxhash64("collection", "file"), F.lit(slices)))
        .repartition("text_id", "_slice")
        .groupBy("text_id", "_slice", "most", "total_words", "collection", "file")
        .agg(coordinated_score(F.col("total_words")).alias("score"))
    )
    order = rank_order("collection", "file")
    in_slice = Window.partitionBy("text_id", "_slice").orderBy(*order)
    first = (
        scores.withColumn("rank", F.row_number().over(in_slice))
        .where("rank <= most")
        .select("text_id", "most", "collection", "file", "score")
    )
    if compat:
        known = matched.select("text_id", "word").distinct()
        unknown = terms.join(known, ["text_id", "word"], "left_anti")
        first = first.unionByName(
            unknown.select(
                "text_id",
                "most",
                *(
                    F.lit(None).cast(first.schema[name].dataType).alias(name)
                    for name in ("collection", "file", "score")
                ),
            ).distinct()
        )
    in_text = Window.partitionBy("text_id").orderBy(*order)
    ranked = (
        first.withColumn("rank", F.row_number().over(in_text).cast("long"))
        .where("rank <= most")
        .select("text_id", "rank", "collection", "file", "score")
    )
    answers = ranked.join(texts.select("text_id", "text", "scope", "copies"), "text_id")
    return (
        join_by_frequency(
            asked,
            answers,
            ["text", "scope"],
            spread_by="query_id",
            frequency="copies",
            total_rows=total_rows,
            largest=largest,
            slice_rows=slice_rows,
        )
        .where(F.col("rank") <= F.col("amount"))
        .select("query_id", "rank", "collection", "file", "score")
    )
