"""Documents that hold items of a test set: BM25 over the items with block-max WAND.

The test items are the indexed side, in order of length and in blocks; every passage of
every document is a query. Weights are divided by the score an item must reach, so all
items share the threshold 1, and a term carries its largest weight over all items and per
block. A passage whose bounds do not add up to 1 is left at once, then the same is asked
per block, and only what is left is scored item by item. Everything above the threshold
is retrieved and then verified on word shingles of the question and words of the answer.

The threshold of an item is its own score without its heaviest words, as many as may be
missing from a verified copy. Retrieval therefore loses nothing that could be verified.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.blocks import give_back
from termlode.llm.common import KEY, stored, with_key, without
from termlode.llm.fingerprints import LOWER, Words, slices, split_words

SHINGLE_WORDS = 5
OVERLAP_PERCENT = 75
K1, B = 1.2, 0.75

# Items of one index; a larger test set is several indexes, applied one after the other.
INDEX_ITEMS = 2000
BLOCK_ITEMS = 16

# Word bytes: ASCII letters and digits, and everything beyond ASCII.
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False

_SENTENCE_END = re.compile(r"[.!?](?=\s+\w)|\n(?=\s*\w)")


def words_of(texts: pa.Array) -> Words:
    """Lower-cased words without punctuation."""
    return split_words(texts, LOWER, _SEPARATOR)


def question_and_answer(text: str) -> tuple[str, str]:
    """All sentences but the last, and the last; a single sentence is all question."""
    first = re.search(r"\w", text)
    ends = [m.end() for m in _SENTENCE_END.finditer(text) if first and m.start() > first.start()]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


def _expand(first: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key its run of entries: index of the key, index of the entry."""
    sizes = first[keys + 1] - first[keys]
    owner = np.repeat(np.arange(len(keys)), sizes)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return owner, first[keys][owner] + within


def _hashes(text: str) -> np.ndarray:
    return words_of(pa.array([text])).hashes()


def _windows(text: str) -> tuple[int, np.ndarray]:
    """Window size, at most a shingle, and the distinct window hashes of a text."""
    words = words_of(pa.array([text]))
    size = max(1, min(SHINGLE_WORDS, len(words)))
    return size, np.unique(words.windows(size)[words.whole_windows(size)])


@dataclass
class ItemIndex:
    """An inverted index of some test items, in memory."""

    ids: list
    terms: np.ndarray  # sorted word hashes
    longest: int
    sizes: list  # words of each item
    item_first: np.ndarray  # postings of a term: items and weights
    item_of: np.ndarray
    item_weight: np.ndarray
    block_first: np.ndarray  # the same by block, with the largest weight
    block_of: np.ndarray
    block_weight: np.ndarray
    term_weight: np.ndarray  # largest weight of a term
    questions: list = field(default_factory=list)
    answers: list = field(default_factory=list)


def build_item_index(items: list[tuple[object, str | None]]) -> ItemIndex | None:
    """Index ``(id, text)`` items; those without a word match nothing and are left out."""
    worded = [(i, text, _hashes(text)) for i, text in items if text and len(_hashes(text))]
    if not worded:
        return None
    worded.sort(key=lambda item: (len(item[2]), str(item[0])))
    lengths = np.array([len(h) for _, _, h in worded])
    terms = np.unique(np.concatenate([h for _, _, h in worded]))
    rows, columns, weights = [], [], []
    questions, answers = [], []
    counted = [np.unique(h, return_counts=True) for _, _, h in worded]
    frequency = np.bincount(
        np.searchsorted(terms, np.concatenate([t for t, _ in counted])), minlength=len(terms)
    )
    idf = np.log1p((len(worded) - frequency + 0.5) / (frequency + 0.5))
    for item, ((_, text, _), (own, tf)) in enumerate(zip(worded, counted, strict=True)):
        term = np.searchsorted(terms, own)
        norm = K1 * (1 - B + B * lengths[item] / lengths.mean())
        weight = idf[term] * tf * (K1 + 1) / (tf + norm)
        question, answer = question_and_answer(text)
        if not len(_hashes(question)):
            question, answer = answer, ""
        questions.append(_windows(question))
        answers.append(np.unique(_hashes(answer)))
        spare = 100 - OVERLAP_PERCENT
        missing = len(questions[-1][1]) * spare // 100 + len(answers[-1]) * spare // 100
        needed = np.sort(weight)[: max(1, len(weight) - missing)].sum()
        rows.append(term)
        columns.append(np.full(len(term), item))
        weights.append(weight / needed)
    row, column, weight = map(np.concatenate, (rows, columns, weights))
    order = np.lexsort((column, row))
    row, column, weight = row[order], column[order], weight[order]
    edges = np.arange(len(terms) + 1)
    block = column // BLOCK_ITEMS
    new = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(block) != 0)]))
    return ItemIndex(
        ids=[i for i, _, _ in worded],
        terms=terms,
        longest=int(lengths.max()),
        sizes=lengths.tolist(),
        item_first=np.searchsorted(row, edges),
        item_of=column,
        item_weight=weight,
        block_first=np.searchsorted(row[new], edges),
        block_of=block[new],
        block_weight=np.maximum.reduceat(weight, new),
        term_weight=np.maximum.reduceat(weight, np.searchsorted(row, edges[:-1])),
        questions=questions,
        answers=answers,
    )


# Rounding of the sums must not lose a score of exactly 1.
_REACHED = 1 - 1e-9


def retrieve(words: Words, index: ItemIndex) -> list[tuple[int, int, int, float]]:
    """``(text, first word, item, score)`` of all passages and items that reach 1.

    Passages are twice as long as the longest item, at steps of its length, so each
    stretch of an item's length lies whole in one.
    """
    step = index.longest
    hashes = words.hashes()
    term = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[term] == hashes)
    passages = np.maximum(1, -(-words.counts // step) - 1)
    first_passage = np.concatenate([[0], np.cumsum(passages)])
    row, place = words.row[known], words.position[known] // step
    pairs = []
    for back in (0, 1):
        at = place - back
        inside = (at >= 0) & (at < passages[row])
        pairs.append((first_passage[row[inside]] + at[inside]) * len(index.terms) + term[known][inside])
    distinct = np.unique(np.concatenate(pairs))
    passage, term = np.divmod(distinct, len(index.terms))

    bound = np.bincount(passage, index.term_weight[term], minlength=first_passage[-1])
    left = bound[passage] >= _REACHED
    passage, term = passage[left], term[left]

    n_blocks = int(index.block_of.max()) + 1
    owner, entry = _expand(index.block_first, term)
    by_block, slot = np.unique(passage[owner] * n_blocks + index.block_of[entry], return_inverse=True)
    bound = np.bincount(slot, index.block_weight[entry], minlength=len(by_block))
    by_block = by_block[bound >= _REACHED]
    if not len(by_block):
        return []

    owner, entry = _expand(index.item_first, term)
    in_block = passage[owner] * n_blocks + index.item_of[entry] // BLOCK_ITEMS
    at = np.minimum(np.searchsorted(by_block, in_block), len(by_block) - 1)
    left = by_block[at] == in_block
    owner, entry = owner[left], entry[left]
    by_item, slot = np.unique(
        passage[owner] * len(index.ids) + index.item_of[entry], return_inverse=True
    )
    score = np.bincount(slot, index.item_weight[entry], minlength=len(by_item))
    found = np.flatnonzero(score >= _REACHED)
    passage, item = np.divmod(by_item[found], len(index.ids))
    text = np.searchsorted(first_passage, passage, "right") - 1
    begin = words.first[text] + (passage - first_passage[text]) * step
    return list(zip(text.tolist(), begin.tolist(), item.tolist(), score[found].tolist(), strict=True))


def best_window(
    runs: np.ndarray, hashes: np.ndarray, size: int, question: np.ndarray, answer: np.ndarray, words: int
) -> tuple[float, float]:
    """Question and answer overlap of the best stretch of ``words`` words.

    ``runs`` are the hashes of the runs of ``size`` words that begin at each word. Best is
    the stretch with the largest smaller overlap, then the largest sum, then the first.
    Only stretches that end with a wanted word or run are counted; no other has more.
    """
    whole = max(0, len(hashes) - size + 1)
    begins = np.flatnonzero(np.isin(runs[:whole], question))
    says = np.flatnonzero(np.isin(hashes, answer))
    places = np.unique(np.concatenate([begins + size - 1, says]))
    if not len(places) or not len(begins):
        return 0.0, 0.0
    best = (-1.0, 0.0, 0.0, 0.0)
    last_run = np.full(len(question), -1)
    last_word = np.full(len(answer), -1)
    run_no = dict(zip(question.tolist(), range(len(question)), strict=True))
    word_no = dict(zip(answer.tolist(), range(len(answer)), strict=True))
    for end in places.tolist():
        first = end - words + 1
        at = end - size + 1
        if at >= 0 and (k := run_no.get(int(runs[at]))) is not None:
            last_run[k] = at
        if (k := word_no.get(int(hashes[end]))) is not None:
            last_word[k] = end
        asked = float((last_run >= max(first, 0)).mean())
        answered = float((last_word >= max(first, 0)).mean()) if len(answer) else 1.0
        best = max(best, (min(asked, answered), asked + answered, asked, answered))
    return best[2], best[3]


def verified(words: Words, index: ItemIndex) -> dict[tuple[int, int], tuple[float, float, float]]:
    """``(text, item)`` to score, question and answer overlap, for what is verified.

    Question and answer must lie within as many words as the item has, anywhere in the text.
    """
    hashes = words.hashes()
    windows: dict[int, np.ndarray] = {}
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for text, begin, item, score in retrieve(words, index):
        end = min(begin + 2 * index.longest, int(words.first[text + 1]))
        size, question = index.questions[item]
        if size not in windows:
            windows[size] = words.windows(size, hashes=hashes)
        answer = index.answers[item]
        # What the whole passage does not hold, none of its stretches does.
        asked = np.isin(question, windows[size][begin : max(begin, end - size + 1)]).mean()
        answered = np.isin(answer, hashes[begin:end]).mean() if len(answer) else 1.0
        if min(asked, answered) * 100 < OVERLAP_PERCENT - 1e-9:
            continue
        asked, answered = best_window(
            windows[size][begin:end], hashes[begin:end], size, question, answer, index.sizes[item]
        )
        if min(asked, answered) * 100 >= OVERLAP_PERCENT - 1e-9:
            found = (score, asked, answered)
            best[text, item] = max(best.get((text, item), found), found)
    return best


def item_indexes(benchmark: DataFrame) -> Iterator[ItemIndex]:
    """Indexes that together hold every item, each of about ``INDEX_ITEMS``."""
    items = benchmark.select("item_id", "text")
    parts = max(1, -(-items.count() // INDEX_ITEMS))
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        index = build_item_index([(row["item_id"], row["text"]) for row in own.collect()])
        if index is not None:
            yield index


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)`` of all leaks.

    A document holds an item if one of its passages has at least 75 % of the five-word
    shingles of the item's question and 75 % of the words of its answer. ``score`` is
    BM25 over the item's threshold, of the best passage. One row per row of ``docs``
    and item: repeated rows, null ids and repeated items are reported as often as they
    occur. Null or empty texts and items match nothing; other columns are ignored.
    """
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
        f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, "
        "score double, question_overlap double, answer_overlap double"
    )
    empty = docs.sparkSession.createDataFrame([], schema)
    kinds = empty.schema
    item_type = benchmark.select("item_id").limit(0).toArrow().schema.field(0).type
    found = empty
    for index in item_indexes(benchmark):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low, high in slices(batch.column("text")):
                    hits = verified(words_of(batch.column("text").slice(low, high - low)), index)
                    ids = batch.column("doc_id").take(pa.array([low + t for t, _ in hits], pa.int64()))
                    numbers = [pa.array([h[i] for h in hits.values()], pa.float64()) for i in range(3)]
                    items = pa.array([index.ids[item] for _, item in hits], item_type)
                    yield pa.RecordBatch.from_arrays([ids, items, *numbers], kinds.names)
            give_back()

        found = found.unionByName(docs.select("doc_id", "text").mapInArrow(run, kinds))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; see :func:`contaminated`."""
    named = with_key(docs)
    texts = named.select(F.col(KEY).alias("doc_id"), F.col("text").cast("string").alias("text"))
    leaks = contaminated(texts, benchmark).select(F.col("doc_id").alias("rid")).distinct()
    return without(named, stored(leaks, "leaks"))
