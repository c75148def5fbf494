"""The best documents without the long tails of common words.

Entries of common words are stored a second time in classes of falling weight, each with its
largest weight. The heaviest classes give documents whose scores can only grow, so the n-th best
of them is a threshold. Classes are read until a document that is in none of them cannot reach
it; a document that was seen may do so only if what it may still gain is enough. The few that are
left are scored from the index, so the result is that of :func:`search`, ties included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.operators.skew import join_by_frequency
from termlode.plans.search import (
    coordinated_score,
    hits,
    normalized_query,
    query_words,
    rank_order,
    search,
)
from termlode.sources.corpus import in_collection
from termlode.sources.store import stored

# Words with more entries than this are kept in classes.
COMMON_ROWS = 4096

# Classes while the weight halves, and how many there are at most.
CLASSES_PER_HALVING = 2
MOST_CLASSES = 32

# Entries of each common word read for the threshold, for each document asked for.
FIRST_ENTRIES = 16

# So many documents are looked up by their names; more are joined.
LITERALS = 256

# Scores are ordered on nine decimals, so what is this close may still be a tie.
MARGIN = 2e-9


@dataclass(frozen=True)
class Impacts:
    """``(collection, word, class, file, idf, tf_idf)`` of common words, and
    ``(collection, word, class, entries, largest)`` of their classes."""

    entries: DataFrame
    bounds: DataFrame


def weight_class(weight, top):
    """0 for the heaviest entries of a word, more the lighter they are."""
    lighter = F.floor(F.log2(top / weight) * CLASSES_PER_HALVING).cast("int")
    return F.when(top == 0, 0).when(weight == 0, MOST_CLASSES - 1).otherwise(
        F.least(lighter, F.lit(MOST_CLASSES - 1))
    )


def write_impacts(index: DataFrame, path: str, common_rows: int = COMMON_ROWS) -> None:
    """Store the classes of the common words of an index below ``path``, which must be new.

    A class is a range of weights relative to the word's largest, so no list is ranked and
    a word in every document is spread over many tasks.
    """
    tops = stored(
        index.groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.max("tf_idf").alias("top"),
            F.min("tf_idf").alias("lowest"),
        )
        .where(F.col("entries") > common_rows),
        "tops",
    )
    total, largest, lowest = tops.agg(F.sum("entries"), F.max("entries"), F.min("lowest")).first()
    if (lowest or 0) < 0:
        raise ValueError("negative weights have no upper bounds: flipped idf is not supported")
    common = join_by_frequency(
        index, tops, ["word"], "file", "entries", total_rows=total or 0, largest=largest or 0
    )
    classed = common.select(
        "collection",
        "word",
        weight_class(F.col("tf_idf"), F.col("top")).alias("class"),
        "file",
        "idf",
        "tf_idf",
    )
    order = ["collection", "word", "class", "file"]
    (
        classed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.partitionBy("collection")
        .orc(f"{path}/entries")
    )
    entries = classed.sparkSession.read.schema(_entries_schema(index)).orc(f"{path}/entries")
    (
        entries.groupBy("collection", "word", "class")
        .agg(F.count(F.lit(1)).alias("entries"), F.max("tf_idf").alias("largest"))
        .repartitionByRange("collection", "word")
        .sortWithinPartitions("collection", "word")
        .write.partitionBy("collection")
        .orc(f"{path}/bounds")
    )


def _entries_schema(index: DataFrame) -> str:
    kind = index.schema["file"].dataType.simpleString()
    return f"word string, class int, file {kind}, idf double, tf_idf double, collection string"


def load_impacts(spark: SparkSession, path: str, file_type: str = "string") -> Impacts:
    entries = f"word string, class int, file {file_type}, idf double, tf_idf double, collection string"
    bounds = "word string, class int, entries long, largest double, collection string"
    return Impacts(
        spark.read.schema(entries).orc(f"{path}/entries"),
        spark.read.schema(bounds).orc(f"{path}/bounds"),
    )


@dataclass
class Depths:
    """For each common word of a query its classes, heaviest first, and how many are read."""

    classes: dict[str, list[tuple[int, int, float]]]  # (class, entries, largest weight)
    read: dict[str, int]
    total_words: int

    def left(self) -> dict[str, float]:
        """The largest weight not read of each word that has any."""
        return {
            word: classes[self.read[word]][2]
            for word, classes in self.classes.items()
            if self.read[word] < len(classes)
        }

    def unseen(self) -> float:
        """What a document that is in no class read can score at most."""
        left = self.left()
        return sum(left.values()) * len(left) / self.total_words

    def deepen(self, threshold: float) -> None:
        """Read classes, the heaviest first, until no unseen document reaches the threshold."""
        while self.left() and self.unseen() >= threshold - MARGIN:
            left = self.left()
            self.read[max(left, key=lambda word: (left[word], word))] += 1

    def share(self) -> float:
        """The part of the common words' entries that is read."""
        read = sum(n for w, c in self.classes.items() for _, n, _ in c[: self.read[w]])
        every = sum(n for classes in self.classes.values() for _, n, _ in classes)
        return read / every if every else 0.0


def first_depths(impacts: Impacts, query: str, n: int, collection: str | None) -> Depths:
    """Classes of the query's words, of which there are few, read far enough for a threshold."""
    words = query_words(query)
    known = (
        in_collection(impacts.bounds, collection)
        .where(F.col("word").isin(sorted(set(words))))
        .groupBy("word", "class")
        .agg(F.sum("entries").alias("entries"), F.max("largest").alias("largest"))
        .collect()
    )
    classes: dict[str, list[tuple[int, int, float]]] = {}
    for row in sorted(known, key=lambda row: row["class"]):
        classes.setdefault(row["word"], []).append((row["class"], row["entries"], row["largest"]))
    read = {}
    for word, own in classes.items():
        so_far, read[word] = 0, 0
        while read[word] < len(own) and so_far < FIRST_ENTRIES * n:
            so_far += own[read[word]][1]
            read[word] += 1
    return Depths(classes, read, len(words))


def _seen(
    index: DataFrame, impacts: Impacts, query: str, depths: Depths, collection: str | None
) -> DataFrame:
    """``(collection, file, lower, upper)`` of all documents in the classes read."""
    rare = sorted(set(query_words(query)) - depths.classes.keys())
    found = in_collection(index, collection).where(F.col("word").isin(rare))
    wanted = F.lit(False)
    for word, number in depths.read.items():
        if number:
            last = depths.classes[word][number - 1][0]
            wanted = wanted | ((F.col("word") == word) & (F.col("class") <= last))
    columns = ["collection", "file", "word", "tf_idf"]
    found = found.select(columns).unionByName(
        in_collection(impacts.entries, collection).where(wanted).select(columns)
    )
    left = depths.left()
    missed = F.lit(0.0)
    for word, weight in left.items():
        missed = F.when(F.col("word") == word, weight).otherwise(missed)
    still = F.when(F.col("word").isin(list(left)), 1).otherwise(0) if left else F.lit(0)
    sums = found.groupBy("collection", "file").agg(
        F.sum("tf_idf").alias("sum"),
        F.count(F.lit(1)).alias("matched"),
        (F.lit(sum(left.values())) - F.sum(missed)).alias("gain"),
        (F.lit(len(left)) - F.sum(still)).alias("more"),
    )
    total = F.lit(depths.total_words)
    return sums.select(
        "collection",
        "file",
        (F.col("sum") * (F.col("matched") / total)).alias("lower"),
        ((F.col("sum") + F.col("gain")) * ((F.col("matched") + F.col("more")) / total)).alias("upper"),
    )


def _only(found: DataFrame, documents: DataFrame) -> DataFrame:
    """Entries of the given documents; few of them are handed to the reader as literals."""
    few = documents.select("collection", "file").limit(LITERALS + 1).collect()
    if len(few) <= LITERALS:
        found = found.where(F.col("file").isin(sorted({row["file"] for row in few})))
    return found.join(documents, ["collection", "file"], "left_semi")


def search_top(
    index: DataFrame,
    impacts: Impacts,
    query: str,
    n: int,
    collection: str | None = None,
    normalize_query: bool = False,
) -> DataFrame:
    """The ``n`` best documents: the rows of :func:`search` with ``n``, in the same order.

    ``impacts`` must be those of ``index``. Words that are not common there are read whole;
    of a common word, its heaviest classes and the entries of the documents that may be among
    the best. Three small jobs run before the result is asked for.
    """
    if normalize_query:
        query = normalized_query(index.sparkSession, query)
    depths = first_depths(impacts, query, n, collection)
    first = _seen(index, impacts, query, depths, collection).orderBy(F.desc("lower")).limit(n)
    reached, threshold = first.agg(F.count(F.lit(1)), F.min("lower")).first()
    if reached < n or not depths.left():
        return search(index, query, n, collection)
    depths.deepen(threshold)
    seen = _seen(index, impacts, query, depths, collection)
    documents = stored(
        seen.where(F.col("upper") >= threshold - MARGIN).select("collection", "file"), "candidates"
    )
    found = _only(hits(index, query, collection), documents)
    scores = found.groupBy("collection", "file").agg(
        coordinated_score(F.lit(depths.total_words)).alias("score")
    )
    return scores.orderBy(*rank_order("collection", "file")).limit(n)
