"""Building the TF-IDF index."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlode.functions.weights import tf as tf_column
from termlode.operators.skew import SLICE_ROWS, join_by_frequency, join_sliced
from termlode.operators.vectors import doc_norms
from termlode.operators.vocabulary import frequencies, vocabulary, with_idf
from termlode.operators.words import term_counts
from termlode.sources.store import load_index, stored, write_beside, write_index

WORD_KEY = ("collection", "word")

# Entries of one file of a stored index.
FILE_ROWS = 2_000_000

# Vocabularies of more words than this are shuffled and hashed; of others the planner decides.
PLANNED_WORDS = 400_000

# Slices of each word when only a few words are asked for.
FEW_WORDS_SLICES = 256


@dataclass(frozen=True)
class StoredVocabulary:
    """A vocabulary written to the shared folder, with its size."""

    frame: DataFrame
    total_rows: int
    largest: int
    words: int = 0


def store_vocabulary(
    docs: DataFrame,
    normalizer: str = "word_hyphen",
    drop_empty: bool = False,
    flipped_idf: bool = False,
    cf: bool = True,
) -> StoredVocabulary:
    """Compute the vocabulary once and keep it as a table, see :func:`vocabulary`.

    Writing it cuts the lineage, so the join below neither repeats the first pass
    over the text nor depends on the executors that ran it, and the planner sees
    its real size: small ones are broadcast, large ones are not.
    """
    words = stored(vocabulary(docs, normalizer, drop_empty, flipped_idf, cf), "vocabulary")
    sums = words.agg(
        F.sum("df").alias("total"), F.max("df").alias("largest"), F.count(F.lit(1)).alias("words")
    ).first()
    return StoredVocabulary(words, sums["total"] or 0, sums["largest"] or 0, sums["words"])


def _with_vocabulary(
    docs: DataFrame,
    columns: Sequence[Column | str],
    normalizer: str,
    drop_empty: bool,
    words: Sequence[str] | None,
    flipped_idf: bool,
    vocab: StoredVocabulary | None,
    cluster: bool,
    slice_rows: int = SLICE_ROWS,
    cf: bool = True,
) -> DataFrame:
    """Join ``columns`` of the term counts with the vocabulary.

    The text is read twice (vocabulary, then counts) and never regrouped by
    document; the counts are shuffled at most once, on (collection, word), and
    carry ``columns`` only. ``cluster`` asks for that shuffle even where the
    vocabulary would fit a broadcast, which puts the entries of a word together for
    storing. With ``words`` all others are dropped inside each document, and what
    is left is stored, so the text is read once.
    """
    hint = "merge" if cluster else None
    kept = [*WORD_KEY, "file", *columns]
    if words is not None:
        found = stored(term_counts(docs, normalizer, drop_empty, words, markers=True), "counts")
        few = with_idf(frequencies(found), flipped_idf)
        counts = found.where("word IS NOT NULL").select(kept)
        return join_sliced(counts, few, WORD_KEY, "file", slices=FEW_WORDS_SLICES, hint=hint)
    counts = term_counts(docs, normalizer, drop_empty).select(kept)
    if vocab is None:
        vocab = store_vocabulary(docs, normalizer, drop_empty, flipped_idf, cf)
    if hint is None and vocab.words > PLANNED_WORDS:
        # The words of a partition are few beside its entries, which need no sorting.
        hint = "shuffle_hash"
    return join_by_frequency(
        counts,
        vocab.frame,
        WORD_KEY,
        spread_by="file",
        frequency="df",
        total_rows=vocab.total_rows,
        largest=vocab.largest,
        hint=hint,
        slice_rows=slice_rows,
    )


def weighted_counts(
    docs: DataFrame,
    normalizer: str = "word_hyphen",
    drop_empty: bool = False,
    words: Sequence[str] | None = None,
    flipped_idf: bool = False,
    vocab: StoredVocabulary | None = None,
    cluster: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Term counts with df, cf, document count and idf of the word on every row."""
    return _with_vocabulary(
        docs,
        ["count", "word_count"],
        normalizer,
        drop_empty,
        words,
        flipped_idf,
        vocab,
        cluster,
        slice_rows,
    )


def build_index(
    docs: DataFrame,
    normalizer: str = "word_hyphen",
    tf: str = "ratio",
    drop_empty: bool = False,
    words: Sequence[str] | None = None,
    flipped_idf: bool = False,
    vocab: StoredVocabulary | None = None,
    cluster: bool = False,
) -> DataFrame:
    """TF-IDF index ``(collection, word, file, idf, tf_idf)`` of a corpus.

    ``tf`` is ``"ratio"`` (count / document length) or ``"raw"`` (count). With
    ``words`` the result is the full index restricted to those words. A ``vocab``
    stored before must come from the same documents and options.
    """
    weighted = _with_vocabulary(
        docs,
        [tf_column(tf).alias("tf")],
        normalizer,
        drop_empty,
        words,
        flipped_idf,
        vocab,
        cluster,
        cf=False,
    )
    return weighted.select(
        "collection", "word", "file", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf")
    )


def place_words(words: DataFrame) -> StoredVocabulary:
    """Add ``begin``, the number of index entries of all words before, in (collection, word) order.

    df says how many entries a word has, so the place of every entry in the ordered
    index is known before it exists and no sample of it is taken. The vocabulary is
    written once, in ranges of words. The entries of whole ranges, as many as shuffle
    partitions, are summed by the driver; those before a word in its own range are summed
    when the table is read, which keeps its known size for the planner.
    """
    ordered = stored(
        words.repartitionByRange("collection", "word").withColumn("_range", F.spark_partition_id()),
        "vocabulary",
    )
    ranges = (
        ordered.groupBy("_range")
        .agg(
            F.sum("df").alias("entries"),
            F.max("df").alias("largest"),
            F.count(F.lit(1)).alias("words"),
        )
        .orderBy("_range")
        .collect()
    )
    offsets = {row["_range"]: 0 for row in ranges}
    total = 0
    for row in ranges:
        offsets[row["_range"]], total = total, total + row["entries"]
    above = F.lit([offsets.get(number, 0) for number in range(max(offsets, default=0) + 1)])
    before = (
        Window.partitionBy("_range")
        .orderBy("collection", "word")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("df").over(before), F.lit(0))
    placed = ordered.withColumn("begin", inside + F.get(above, F.col("_range"))).drop("_range")
    return StoredVocabulary(
        placed,
        total,
        max((row["largest"] for row in ranges), default=0),
        sum(row["words"] for row in ranges),
    )


def index_corpus(
    docs: DataFrame,
    path: str,
    mode: str = "errorifexists",
    norms_path: str | None = None,
    vocab_path: str | None = None,
    file_rows: int = FILE_ROWS,
    normalizer: str = "word_hyphen",
    tf: str = "ratio",
    drop_empty: bool = False,
    flipped_idf: bool = False,
) -> None:
    """Build the index of a corpus and store it in files that each hold a range of words.

    Every file has about ``file_rows`` entries of neighbouring words; the entries of a
    commoner word are dealt over several files by ``file``. Collections may be added to
    a store one after the other; see :func:`write_index` for ``mode``. ``norms_path``
    also stores the norm of every document, 0 for one without entries, and
    ``vocab_path`` the vocabulary with the files of each word, from which :func:`cosine`
    scores without reading more of the index than the query's words, and
    :func:`load_words` opens no other files. Other options as in :func:`build_index`.
    """
    vocab = place_words(vocabulary(docs, normalizer, drop_empty, flipped_idf, cf=False))
    counts = _with_vocabulary(
        docs, [tf_column(tf).alias("tf")], normalizer, drop_empty, None, flipped_idf, vocab, False
    )
    place = F.col("begin") + F.pmod(F.xxhash64("file"), F.col("df"))
    entries = counts.select(
        *WORD_KEY,
        "file",
        "idf",
        (F.col("tf") * F.col("idf")).alias("tf_idf"),
        F.floor(place / F.lit(file_rows)).cast("int").alias("_file"),
    )
    files = max(1, -(-vocab.total_rows // file_rows))
    write_index(entries.repartitionById(files, "_file"), path, mode, collections=vocab.frame)
    if vocab_path is not None:
        file_of = [
            F.floor((F.col("begin") + end) / F.lit(file_rows)).cast("int").alias(name)
            for name, end in (("first_file", F.lit(0)), ("last_file", F.col("df") - 1))
        ]
        write_beside(
            vocab.frame.select(*WORD_KEY, "df", "n_docs", "idf", *file_of).sortWithinPartitions(
                *WORD_KEY
            ),
            vocab_path,
        )
    if norms_path is not None:
        names = [row[0] for row in vocab.frame.select("collection").distinct().collect()]
        kind = docs.schema["file"].dataType.simpleString()
        index = load_index(docs.sparkSession, path, file_type=kind)
        norms = doc_norms(index.where(F.col("collection").isin(names)))
        every = docs.select("collection", "file").join(norms, ["collection", "file"], "left")
        write_beside(every.withColumn("norm", F.coalesce("norm", F.lit(0.0))), norms_path)
