"""Repeated passages across documents, by difference-cover anchors.

A word belongs to a repeat if some window of 20 consecutive words around it also starts
earlier in the corpus. Looking at every window is dear, so hashes of 8 words are taken at
the positions of a difference cover modulo 13 only: {0, 1, 3, 9} has every difference, so
any two equal windows of 20 words have equal anchors at the same offset, wherever they
start. Windows around an anchor that occurs once need no look. The others are extended to
the full 20 words and compared by a 96-bit hash.

Documents are dealt into blocks. A block hands out each anchor and each window once, its
first occurrence with it, and judges its own repeats itself, so the rows of the commonest
passage are at most as many as there are blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.llm.common import keyed, row_blocks
from termlode.llm.fingerprints import Words, slices, split_words

WINDOW_WORDS = 20
PERIOD = 13
# A perfect difference set modulo PERIOD.
COVER = (0, 1, 3, 9)
ANCHOR_WORDS = WINDOW_WORDS - PERIOD + 1

BLOCK_BYTES = 8 << 20
CLEANED = "rid long, doc_id long, n_words long, n_removed long, kept_text string"

_COVERED = np.zeros(PERIOD, bool)
_COVERED[list(COVER)] = True


def _slices_of(texts: pa.Array) -> Iterator[tuple[int, Words]]:
    for low, high in slices(texts):
        yield low, split_words(texts.slice(low, high - low))


def _texts(table: pa.Table) -> tuple[pa.Table, pa.Array]:
    """The rows of a block in the order of their keys, and their texts."""
    table = table.sort_by("rid")
    texts = table.column("text").combine_chunks()
    return table, texts


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word indices and hashes of the anchors of texts that have a full window."""
    long_enough = np.repeat(words.counts >= WINDOW_WORDS, words.counts)
    at = words.whole_windows(ANCHOR_WORDS)
    at = at[_COVERED[words.position[at] % PERIOD] & long_enough[at]]
    return at, words.windows(ANCHOR_WORDS)[at]


def _block_anchors(table: pa.Table) -> pa.Table:
    texts = table.column("text").combine_chunks()
    found = [anchors(words)[1] for _, words in _slices_of(texts)]
    distinct, counts = np.unique(np.concatenate(found), return_counts=True)
    block = table.column("block")[0].as_py()
    return pa.table(
        {
            "anchor": pa.array(distinct.view(np.int64)),
            "block": pa.array(np.full(len(distinct), block)),
            "again": pa.array(counts > 1),
        }
    )


def _first_of_equal(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first of each group of equal pairs, and of all later ones."""
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
    return order[new], order[~new]


def _block_windows(table: pa.Table, repeated: pa.Table) -> pa.Table:
    """Windows around repeated anchors: hash, and the first place in the block.

    A place is the number of a word in the block, whose texts lie in the order of keys.
    """
    table, texts = _texts(table)
    rids = table.column("rid").to_numpy()
    wanted = np.unique(repeated.column("anchor").to_numpy().view(np.uint64))
    parts = []
    total = 0
    for low, words in _slices_of(texts):
        at, hashes = anchors(words)
        marked = np.zeros(len(words) + 1, np.int64)
        marked[at + 1] = np.isin(hashes, wanted)
        sums = np.cumsum(marked)
        begin = words.whole_windows(WINDOW_WORDS)
        begin = begin[sums[begin + PERIOD] > sums[begin]]
        one, two = _window_hashes(words, begin)
        parts.append((one, two, rids[low + words.row[begin]], begin + total))
        total += len(words)
    one, two, rid, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    first, _ = _first_of_equal(one, two)
    return pa.table(
        {
            "one": pa.array(one[first].view(np.int64)),
            "two": pa.array(two[first].view(np.int32)),
            "rid": pa.array(rid[first]),
            "place": pa.array(place[first].astype(np.int32)),
        }
    )


def _window_hashes(words: Words, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows at ``begin``, 64 bits and another 32."""
    two = words.windows(WINDOW_WORDS, 1)[begin]
    return words.windows(WINDOW_WORDS, 0)[begin], two.astype(np.uint32)


def _block_cleaned(table: pa.Table, earlier: pa.Table) -> pa.Table:
    """Texts of a block without the words that a repeated window covers."""
    table, texts = _texts(table)
    ones, twos, starts, counts = [], [], [], []
    total = 0
    for _, words in _slices_of(texts):
        begin = words.whole_windows(WINDOW_WORDS)
        one, two = _window_hashes(words, begin)
        ones.append(one)
        twos.append(two)
        starts.append(begin + total)
        counts.append(words.counts)
        total += len(words)
    begin, counts = np.concatenate(starts), np.concatenate(counts)
    first_word = np.cumsum(counts) - counts
    _, later = _first_of_equal(np.concatenate(ones), np.concatenate(twos))
    edges = np.zeros(total + WINDOW_WORDS + 1, np.int64)
    for at in (begin[later], earlier.column("place").to_numpy()):
        np.add.at(edges, at, 1)
        np.add.at(edges, at + WINDOW_WORDS, -1)
    keep = np.cumsum(edges)[:total] == 0
    removed, kept_texts = [], []
    for text, at, count in zip(texts.cast(pa.binary()), first_word, counts, strict=True):
        own = keep[at : at + count]
        pieces = (text.as_py() or b"").split()
        if not own.all():
            pieces = [piece for piece, kept in zip(pieces, own.tolist(), strict=True) if kept]
        removed.append(count - len(pieces))
        kept_texts.append(b" ".join(pieces))
    return pa.table(
        {
            "rid": table.column("rid"),
            "doc_id": table.column("doc_id"),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(kept_texts, pa.binary()).cast(pa.string()),
        }
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``(rid, doc_id, n_words, n_removed, kept_text)``, one row per row of ``docs``.

    Words are runs other than space and 09-0D. Every word is removed that a window of
    20 words covers whose sequence also starts earlier: in a smaller doc_id, or before
    in the same text. All windows are judged on the input. ``kept_text`` joins what is
    left by single spaces. Null or empty texts have no words; a text of fewer than 20
    is kept whole. Where doc_id is null or repeated, "earlier" follows (doc_id, text),
    null first, so of two equal rows one is kept. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = keyed(docs)
    blocks = row_blocks(rows, BLOCK_BYTES)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("rid"), F.lit(blocks)).alias("block")
    dealt = rows.select("*", block).repartition(tasks, "block")
    found = dealt.groupBy("block").applyInArrow(
        _block_anchors, "anchor long, block long, again boolean"
    )
    same = Window.partitionBy("anchor").orderBy("block")
    repeated = (
        found.withColumn("other", F.coalesce(F.lag("block").over(same), F.lead("block").over(same)))
        .where("again OR other IS NOT NULL")
        .select("block", "anchor")
    )
    windows = (
        dealt.groupBy("block")
        .cogroup(repeated.groupBy("block"))
        .applyInArrow(_block_windows, "one long, two int, rid long, place int")
    )
    order = Window.partitionBy("one", "two").orderBy("rid", "place")
    earlier = (
        windows.withColumn("n", F.row_number().over(order)).where("n > 1").select(block, "place")
    )
    return (
        dealt.groupBy("block")
        .cogroup(earlier.groupBy("block"))
        .applyInArrow(_block_cleaned, CLEANED)
    )
