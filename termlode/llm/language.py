"""Language of a text by cross-parsing entropy.

A suffix automaton of labelled text per language gives the longest match of what comes
next in a document. Cutting the document greedily into such matches is its cross-parsing;
the more alike the languages, the longer and fewer the phrases. With c phrases over n
bytes and a training text of m bytes the estimate is c * log2(m) / n bits a byte; the
language that needs the fewest, so normalised, wins.

The model is a bounded sample of training text; all documents are read whole.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.llm.blocks import give_back
from termlode.llm.common import KEY, documents_of, stored, with_key, without

# The training sample: so many rows a language, so many bytes of each and in all.
SAMPLE_ROWS = 48
ROW_BYTES = 4096
LANGUAGE_BYTES = 32_000

# A phrase of a smaller sample costs as many bits as one of this size. Else a sample of a
# few bytes would be the cheapest for any text, as its phrases cost next to nothing.
LEAST_BYTES = 4096

# So many languages share a transition table. More are several tables, each built anew for
# every so many bytes of text, as only one is in memory at a time.
MOST_LANGUAGES = 64
GROUP_BYTES = 32_000_000

# A document is parsed in stretches of this many bytes; a phrase ends with its stretch.
# That bounds the steps of a batch, which all stretches and languages take together.
STRETCH = 1024
LANES = 4096

UNDETERMINED = "und"
PREDICTED = "rid long, lang_pred string, score double"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
# To a regular expression a numeral such as ½ or Ⅷ is a word character.
_NUMERALS = {
    ord(c): " " for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha()
}
_RARE = frozenset(map(chr, _NUMERALS))


def letters_only(text: str | None) -> bytes:
    """Lower-cased letters, each run of anything else being one blank."""
    text = text or ""
    if not text.isascii() and not _RARE.isdisjoint(text):
        text = text.translate(_NUMERALS)
    return _NOT_LETTERS.sub(" ", text).lower().strip().encode("utf-8", "ignore")


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts all substrings of ``text``; 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in text:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in follow[state]:
            follow[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = follow[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(follow)
                follow.append(dict(follow[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and follow[state].get(symbol) == target:
                    follow[state][symbol] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return follow


@lru_cache(maxsize=1)
def _tables(samples: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One transition table for all languages, the symbol of each byte, the start states.

    State 0 is the dead end; symbol 0 stands for bytes that no sample has.
    """
    seen = sorted(set(b"".join(samples)))
    symbols = np.zeros(256, np.int32)
    symbols[seen] = np.arange(1, len(seen) + 1)
    automata = [suffix_automaton(sample) for sample in samples]
    starts = 1 + np.cumsum([0, *map(len, automata)])[:-1]
    table = np.zeros((1 + sum(map(len, automata)), len(seen) + 1), np.int32)
    for start, automaton in zip(starts, automata, strict=True):
        row = [start + state for state, out in enumerate(automaton) for _ in out]
        column = [symbols[byte] for out in automaton for byte in out]
        table[row, column] = [start + to for out in automaton for to in out.values()]
    return table.reshape(-1), symbols, starts.astype(np.int32)


def count_phrases(texts: list[bytes], samples: tuple[bytes, ...]) -> np.ndarray:
    """Phrases of each text under each language, all stretches advanced in lockstep."""
    table, symbols, starts = _tables(samples)
    width = symbols.max() + 1
    phrases = np.zeros((len(texts), len(samples)), np.int64)
    pieces = [
        (i, text[at : at + STRETCH])
        for i, text in enumerate(texts)
        for at in range(0, len(text), STRETCH)
    ]
    pieces.sort(key=lambda piece: -len(piece[1]))
    for low in range(0, len(pieces), LANES):
        part = pieces[low : low + LANES]
        sizes = np.array([len(piece) for _, piece in part])
        block = np.zeros((len(part), sizes[0]), np.int32)
        filled = np.arange(sizes[0]) < sizes[:, None]
        block[filled] = symbols[np.frombuffer(b"".join(p for _, p in part), np.uint8)]
        columns = np.ascontiguousarray(block.T)
        state = np.zeros((len(samples), len(part)), np.int32)
        count = np.zeros(state.shape, np.int32)
        alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")
        fresh = starts[:, None] * width
        for step in range(sizes[0]):
            n = alive[step]
            symbol = columns[step, :n]
            to = table[state[:, :n] * width + symbol]
            dead = to == 0
            # The phrase ends before this symbol and the next begins with it. A symbol
            # that the language's sample lacks is a phrase of its own.
            count[:, :n] += dead
            state[:, :n] = np.where(dead, table[fresh + symbol], to)
        np.add.at(phrases, [i for i, _ in part], count.T)
    return phrases


def training_sample(docs: DataFrame) -> dict[str, bytes]:
    """Language to training text, from the labelled rows that are not held out.

    Rows come in the order of a hash of their id; at most ``SAMPLE_ROWS`` rows a
    language leave the cluster, ``ROW_BYTES`` characters of each. They come one partition
    at a time, and no more than ``LANGUAGE_BYTES`` of a language are kept.
    """
    # A row counts from its first letter on.
    text = F.regexp_replace("text", r"^\P{L}+", "")
    labelled = docs.where(
        (F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
        & F.col("lang").isNotNull()
        & F.col("text").rlike(r"\p{L}")
    ).select("lang", F.left(text, F.lit(ROW_BYTES)).alias("text"), F.xxhash64("doc_id").alias("o"))
    first = Window.partitionBy("lang").orderBy("o", "text")
    rows = (
        labelled.withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= SAMPLE_ROWS)
        .orderBy("lang", "n")
    )
    samples: dict[str, bytes] = {}
    for row in rows.toLocalIterator():
        known, more = samples.get(row["lang"], b""), letters_only(row["text"])
        samples[row["lang"]] = (known + b" " + more if known else more)[:LANGUAGE_BYTES]
    return {lang: sample for lang, sample in samples.items() if sample}


def predict(text_list: list[str | None], model: dict[str, bytes]) -> list[tuple[str, float]]:
    """Language and score of each text.

    The score is 1 - best / second of the normalised phrase counts, 1 with a single
    language, 0 where there is nothing to judge. Ties go to the first name.
    """
    texts = [letters_only(text) for text in text_list]
    names = sorted(model)
    if not names:
        return [(UNDETERMINED, 0.0)] * len(texts)
    phrases = np.hstack(
        [
            count_phrases(texts, tuple(model[name] for name in names[low : low + MOST_LANGUAGES]))
            for low in range(0, len(names), MOST_LANGUAGES)
        ]
    )
    sizes = [max(len(model[name]), LEAST_BYTES) for name in names]
    bits = phrases * np.array([math.log2(size + 1) for size in sizes])
    best = bits.argmin(axis=1)
    ordered = np.sort(bits, axis=1)
    found = []
    for i, text in enumerate(texts):
        if not text:
            found.append((UNDETERMINED, 0.0))
        elif len(names) == 1:
            found.append((names[0], 1.0))
        else:
            found.append((names[best[i]], float(1 - ordered[i, 0] / ordered[i, 1])))
    return found


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 1000):
            yield batch.slice(low, 1000)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Slices put together up to about ``GROUP_BYTES`` each."""
    held: list[pa.RecordBatch] = []
    for part in _slices(batches):
        held.append(part)
        if sum(x.nbytes for x in held) >= GROUP_BYTES:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def identify(docs: DataFrame, model: dict[str, bytes] | None = None) -> DataFrame:
    """All columns of ``docs`` with ``held_out``, ``lang_pred`` and ``score`` added.

    The prediction sees nothing but the text; the model is learned from text and lang
    of rows with crc32(doc_id as text) mod 5 not 0 unless one is given. A null text or
    one without letters is ``und`` with score 0, and so is every text where nothing
    could be learned. ``held_out`` of a null doc_id is false and the row is not
    learned from. Columns of these names in the input are replaced.
    """
    if model is None:
        model = training_sample(docs)
    known = docs.drop("held_out", "lang_pred", "score")
    schema = known.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    many = len(model) > MOST_LANGUAGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches) if many else _slices(batches):
            found = predict(part.column("text").to_pylist(), model)
            whole = pa.table(
                [
                    *part.columns,
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                schema.names,
            )
            yield from whole.to_batches(max_chunksize=1000)
        # The worker lives on; the automata are of no use to what it does next.
        _tables.cache_clear()
        give_back()

    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return known.mapInArrow(run, schema).withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def drop_undetermined(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose language could be told; see :func:`identify`.

    Only key and text pass through Python, and only the keys of the others come back.
    """
    named = with_key(docs)
    texts = named.select(
        F.col(KEY).alias("rid"), F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    told = identify(texts, training_sample(docs))
    return without(named, stored(told.where(F.col("lang_pred") == UNDETERMINED).select("rid"), "undetermined"))


def language_predictions(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``docs``."""
    picked = documents_of(docs).withColumn("lang", F.lit(None).cast("string"))
    picked = identify(picked.drop("lang"), training_sample(docs))
    return picked.select("doc_id", "held_out", "lang_pred", "score")
