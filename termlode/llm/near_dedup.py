"""Near-duplicate documents by fast similarity sketches.

A document is the set of its distinct five-word shingles. The sketch is filled in rounds:
in each round every shingle is hashed to one bin with a value, the early rounds to a free
bin, the later ones (one per bin) to that bin, and a bin keeps the least value of the first
round that reached it. So every coordinate fills, and for sets larger than the sketch a few
rounds do. The share of equal coordinates of two sketches is concentrated around the
similarity of the sets. Bands of the sketch propose links, full sets confirm them.

No group is ever expanded into its pairs:

1. Documents with equal sets are one class, represented by its smallest key.
2. Within each bucket of a band every member is compared with the smallest member only.
   The best candidate of each document is confirmed first, then whatever candidates still
   lie in different components.
3. Buckets whose members still belong to different components are looked through for
   links across components, nothing within one. The members get a sketch of 4,096
   coordinates, one bit of each, and the join itself compares these and then the sets, as
   32-bit hashes, so what it puts out are links, each in one of its buckets only.

Links inside a component that already hangs together are never looked at, and no other is
left out: the result is that of all candidate pairs. A pair of similarity 0.75 shares none
of the 32 bands with a probability of 5e-6; the sketches judge six deviations below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.llm.blocks import give_back
from termlode.llm.common import keyed, keyed_rows, small_join, stored, with_key, without
from termlode.llm.fingerprints import LOWER, Words, mix, slices, split_words
from termlode.operators.skew import join_by_frequency

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
COORDINATES = 128
BAND_ROWS = 4
BANDS = COORDINATES // BAND_ROWS

# Candidates with fewer equal coordinates are dropped unconfirmed. 96 are expected at
# 0.75 with a deviation of 4.9, so this is six deviations below (1e-9).
LEAST_EQUAL = 66

# The bits of the long sketch. Of 4,096, 512 are expected to differ at 0.75 with a
# deviation of 21.2; again the bound is six deviations off.
BITS = 4096
MOST_DIFFERENT = 639

# Rows that a Python worker gets at a time, set while this operator runs.
BATCH_ROWS = 1000
_ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

SKETCHED = (
    "rid long, doc_id long, n_shingles long, signature binary, bands array<long>, sketch binary"
)
SETS = "rid long, shingles array<long>"
LONG_SKETCHED = "rid long, bits array<long>, hashes array<int>"
_UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(words: Words) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text of fewer words than a shingle is one shingle; one without words has none.
    """
    hashes = words.hashes()
    windows = words.windows(SHINGLE_WORDS, hashes=hashes)
    short = {
        size: words.windows(size, hashes=hashes) + np.uint64(size)
        for size in range(1, SHINGLE_WORDS)
        if size in words.counts
    }
    sets = []
    for first, last in zip(words.first[:-1], words.first[1:], strict=True):
        if last - first >= SHINGLE_WORDS:
            sets.append(np.unique(windows[first : last - SHINGLE_WORDS + 1]))
        elif last > first:
            sets.append(short[int(last - first)][first : first + 1])
        else:
            sets.append(windows[:0])
    return sets


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One row of ``coordinates`` numbers per set, a power of two; an empty set stays unfilled.

    The round stands in the top 13 bits, so the least number is the first round's.
    """
    table = np.full((len(sets), coordinates), _UNFILLED, np.uint64)
    bin_bits = np.uint64(65 - coordinates.bit_length())
    sizes = np.array([len(s) for s in sets])
    pending = np.flatnonzero(sizes)
    for turn in range(2 * coordinates):
        if not len(pending):
            break
        values = np.concatenate([sets[i] for i in pending])
        row = np.repeat(pending, sizes[pending])
        drawn = mix(values + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) & 0xFFFFFFFFFFFFFFFF))
        if turn < coordinates:
            place = (drawn >> bin_bits).astype(np.int64)
        else:
            place = np.full(len(drawn), turn - coordinates)
        kept = (drawn & np.uint64((1 << 51) - 1)) | np.uint64(turn << 51)
        np.minimum.at(table.reshape(-1), row * coordinates + place, kept)
        pending = pending[(table[pending] == _UNFILLED).any(axis=1)]
    return table


def band_keys(table: np.ndarray) -> np.ndarray:
    """A hash per band, different for equal rows in different bands."""
    rows = table.reshape(len(table), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for i in range(BAND_ROWS):
        key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + rows[:, :, i])
    return key


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    texts = batch.column("text")
    for low, high in slices(texts):
        yield low, high, shingle_sets(split_words(texts.slice(low, high - low), LOWER))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, sets in _sets_of(batch):
            table = sketches(sets)
            keys = band_keys(table).view(np.int64)
            coarse = mix(table).astype(np.uint8)
            filled = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid").slice(low, high - low),
                    batch.column("doc_id").slice(low, high - low),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [
                            hashlib.blake2b(s.tobytes(), digest_size=16).digest() if f else None
                            for s, f in zip(sets, filled, strict=True)
                        ],
                        pa.binary(),
                    ),
                    pa.array(
                        [keys[i] if f else None for i, f in enumerate(filled)],
                        pa.list_(pa.int64()),
                    ),
                    pa.array(
                        [coarse[i].tobytes() if f else None for i, f in enumerate(filled)],
                        pa.binary(),
                    ),
                ],
                ["rid", "doc_id", "n_shingles", "signature", "bands", "sketch"],
            )
    give_back()


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, sets in _sets_of(batch):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid").slice(low, high - low),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["rid", "shingles"],
            )
    give_back()


def _long_sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            sets = [s.values.to_numpy().view(np.uint64) for s in part.column("shingles")]
            odd = (mix(sketches(sets, BITS)) & np.uint64(1)).astype(np.uint8)
            bits = np.packbits(odd, axis=1).view(np.int64)
            hashes = [np.unique(s.astype(np.uint32)).view(np.int32) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("rid"),
                    pa.array(list(bits), pa.list_(pa.int64())),
                    pa.array(hashes, pa.list_(pa.int32())),
                ],
                ["rid", "bits", "hashes"],
            )


def _count_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("s_a", "s_b")
        ]
        equal = (sides[0] == sides[1]).reshape(-1, COORDINATES).sum(axis=1)
        picked = pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(equal, pa.int64())],
            ["a", "b", "n_equal"],
        )
        yield picked.filter(pa.array(equal >= LEAST_EQUAL))


def sketch_documents(rows: DataFrame) -> DataFrame:
    """``(rid, doc_id, n_shingles, signature, bands, sketch)``; the last three null when empty."""
    return rows.select("rid", "doc_id", "text").mapInArrow(_sketch_batches, SKETCHED)


def similar_enough(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that the set sizes allow and the sketches suggest."""
    side = lambda name: facts.select(
        F.col("rid").alias(name),
        F.col("n_shingles").alias(f"n_{name}"),
        F.col("sketch").alias(f"s_{name}"),
    )
    sized = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(100 * F.least("n_a", "n_b") >= SIMILARITY_PERCENT * F.greatest("n_a", "n_b"))
    )
    return sized.select("a", "b", "s_a", "s_b").mapInArrow(
        _count_equal, "a long, b long, n_equal long"
    )


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets are similar."""
    side = lambda name: sets.select(
        F.col("rid").alias(name), F.col("shingles").alias(f"set_{name}")
    )
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.where(100 * common >= SIMILARITY_PERCENT * union).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``(rid, component)`` of every node of the links: the smallest node it reaches.

    Alternates two steps until nothing changes: each node hands its larger neighbours
    to its least one, then its smaller ones. Every round is written to the shared
    folder, and the number of rounds grows with the logarithm of the nodes.
    """

    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m"))

    def digest(edges: DataFrame):
        return edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()

    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = digest(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = (
            both.join(least(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        smaller = (
            larger.join(least(larger), "u")
            .select(
                F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")
            )
            .where("u <> v")
            .distinct()
        )
        edges = stored(smaller, "edges")
        after = digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("rid"), F.col("v").alias("component"))


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    for end in ("a", "b"):
        own = labels.select(F.col("rid").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(
            f"of_{end}", F.coalesce(f"of_{end}", F.col(end))
        )
    return pairs.where("of_a <> of_b").drop("of_a", "of_b")


def _links_across(torn: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different components of ``(bucket, rid, component)`` rows.

    Only pairs whose long sketches differ in few enough bits and whose sets are similar by
    their 32-bit hashes leave the join, and only in the least bucket that they share. No
    link is lost by that: what two sets share is at most what their hashes share, and as
    many more as hashes of either set fall together.
    """
    concerned = torn.select("rid").distinct()
    facts = stored(
        small_join(sets, concerned, "rid", "left_semi")
        .mapInArrow(_long_sketch_batches, LONG_SKETCHED)
        .join(small_join(known, concerned, "rid", "left_semi"), "rid")
        .select("rid", "n_shingles", "bands", "bits", "hashes"),
        "long-sketches",
    )
    left, right = (
        torn.join(facts, "rid").select(
            *(
                F.col(c).alias(f"{c}_{end}")
                for c in ("bucket", "component", "rid", "n_shingles", "bands", "bits", "hashes")
            )
        )
        for end in ("a", "b")
    )
    different = sum(
        (
            F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i))))
            for i in range(1, BITS // 64)
        ),
        F.bit_count(F.get("bits_a", F.lit(0)).bitwiseXOR(F.get("bits_b", F.lit(0)))),
    )
    fallen = (F.col(f"n_shingles_{end}") - F.size(f"hashes_{end}") for end in ("a", "b"))
    common = F.size(F.array_intersect("hashes_a", "hashes_b")) + F.least(*fallen)
    union = F.col("n_shingles_a") + F.col("n_shingles_b") - common
    return left.join(
        right,
        (F.col("bucket_a") == F.col("bucket_b"))
        & (F.col("component_a") > F.col("component_b"))
        & (
            100 * F.least("n_shingles_a", "n_shingles_b")
            >= SIMILARITY_PERCENT * F.greatest("n_shingles_a", "n_shingles_b")
        )
        & (different <= MOST_DIFFERENT)
        & (F.array_min(F.array_intersect("bands_a", "bands_b")) == F.col("bucket_a"))
        & (100 * common >= SIMILARITY_PERCENT * union),
    ).select(F.col("rid_a").alias("a"), F.col("rid_b").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, rid)``, one row per row of ``docs``.

    Links hold between documents with 100 * intersection >= 75 * union of their shingle
    sets. ``component_id`` is the smallest doc_id that links reach; the row with that
    id is kept. Null, empty and blank texts have no shingles and are components of
    their own. Where doc_id is null or repeated, rows are ordered by (doc_id, text),
    the first row of a component is kept, and ``component_id`` is its doc_id. Columns
    other than doc_id and text are ignored; an empty table gives an empty result.
    """
    return near_duplicate_rows(keyed(docs))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`near_duplicates` keeps."""
    named = with_key(docs)
    return without(named, near_duplicate_rows(keyed_rows(named)).where("NOT kept"))


@contextmanager
def _small_batches(spark: SparkSession):
    before = spark.conf.get(_ROWS_PER_BATCH)
    spark.conf.set(_ROWS_PER_BATCH, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ROWS_PER_BATCH, before)


def near_duplicate_rows(rows: DataFrame) -> DataFrame:
    """:func:`near_duplicates` of keyed rows ``(rid, doc_id, text)``."""
    # All that passes through Python is stored in here.
    with _small_batches(rows.sparkSession):
        return _near_duplicate_rows(rows)


def _near_duplicate_rows(rows: DataFrame) -> DataFrame:
    known = stored(sketch_documents(rows), "sketches")
    full = known.where("signature IS NOT NULL")
    classes = stored(
        full.groupBy("signature").agg(
            F.min("rid").alias("representative"), F.count(F.lit(1)).alias("copies")
        ),
        "signatures",
    )
    total, largest = classes.agg(F.sum("copies"), F.max("copies")).first()
    members = stored(
        join_by_frequency(
            full.select("rid", "signature"),
            classes,
            ["signature"],
            spread_by="rid",
            frequency="copies",
            total_rows=total or 0,
            largest=largest or 0,
        ).select("rid", "representative"),
        "classes",
    )
    heads = members.where("rid = representative").select("rid")
    facts = known.select("rid", "n_shingles", "sketch")

    keys = known.join(heads, "rid", "left_semi").select("rid", F.explode("bands").alias("bucket"))
    shared = (
        keys.groupBy("bucket")
        .agg(F.min("rid").alias("least"), F.max("rid").alias("most"))
        .where("least < most")
    )
    buckets = stored(keys.join(shared.drop("most"), "bucket"), "buckets")
    stars = stored(
        similar_enough(
            buckets.where("rid > least")
            .select(F.col("rid").alias("a"), F.col("least").alias("b"))
            .distinct(),
            facts,
        ),
        "candidates",
    )
    in_buckets = buckets.select("rid").distinct()
    sets = stored(
        small_join(rows, in_buckets, "rid", "left_semi")
        .select("rid", "text")
        .mapInArrow(_set_batches, SETS),
        "sets",
    )

    best = stars.groupBy("a").agg(F.max(F.struct("n_equal", "b")).alias("top")).select("a", "top.b")
    links = stored(confirmed(best, sets), "links")
    labels = components(links)
    links = stored(
        labels.select(F.col("rid").alias("a"), F.col("component").alias("b")).unionByName(
            confirmed(_across(stars, labels), sets)
        ),
        "links",
    )
    labels = components(links)

    placed = buckets.join(labels, "rid", "left").select(
        "bucket", "rid", F.coalesce("component", "rid").alias("component")
    )
    mixed = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo < hi")
        .select("bucket")
    )
    torn = stored(placed.join(mixed, "bucket"), "torn")
    found = confirmed(_links_across(torn, sets, known), sets)
    links = labels.select(F.col("rid").alias("a"), F.col("component").alias("b")).unionByName(found)
    labels = components(stored(links, "links"))

    rooted = members.join(
        labels.withColumnRenamed("rid", "representative"), "representative", "left"
    ).select("rid", F.coalesce("component", "representative").alias("root"))
    result = known.select("rid", "doc_id", "n_shingles").join(rooted, "rid", "left")
    result = result.withColumn("root", F.coalesce("root", "rid"))
    heads_by_id = known.select(F.col("rid").alias("root"), F.col("doc_id").alias("component_id"))
    return result.join(heads_by_id, "root").select(
        "doc_id", "n_shingles", "component_id", (F.col("rid") == F.col("root")).alias("kept"), "rid"
    )
