"""Scores of texts by a smoothed n-gram model kept in Elias-Fano tries.

Words are counted over the training documents and numbered; pairs and triples of neighbouring
words are counted in shards by the first word, each of which becomes one trie: contexts,
pointers, words and quantised probabilities, and a level of the words after each pair with
their quantised counts. A block of documents sends each of its distinct pairs, with the
distinct words after it, to the shard of the pair once and gets the codes back in the same
order, so what is shuffled is distinct pairs and triples of blocks and nothing of the model
ever gathers in one place.

With c(v) occurrences of a context, the probability of a word after it is
p(w | v) = (c(v, w) + STRENGTH * p(w)) / (c(v) + STRENGTH), a Dirichlet prior around the add-one
probability p(w) of the word alone. The trie keeps c(v, w) / (c(v) + STRENGTH). After two words
it is (c(u, v, w) + TRIPLE_STRENGTH * p(w | v)) / (c(u, v) + TRIPLE_STRENGTH).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.blocks import expand, give_back, numbers, pack, squeeze, text_blocks, unpack
from termlode.llm.common import row_blocks, stored
from termlode.llm.elias_fano import Trie, join_tries, split_tries
from termlode.llm.fingerprints import mix
from termlode.operators.skew import SLICE_ROWS

BLOCK_BYTES = 8 << 20

# Text of the corpus to a shard of pairs and to a part of the words, which bounds both.
SHARD_BYTES = 16 << 20

# How many occurrences of a context the word alone weighs.
STRENGTH = 256.0

# How many occurrences of a pair the pair of its last word and the next weighs.
TRIPLE_STRENGTH = 4.0

# Codes are steps of the decimal logarithm; the last one says that the pair is unknown.
STEPS = 4096
ABSENT = 65535

# The end of a text is a word without letters; the context at its begin has this number.
END = ""
BEGIN = 1

_TOKENISED = "block long, part long, data binary"
_NAMED = "block long, part long, data binary, words long, tokens long, documents long"
_PAIRS = "block long, shard long, data binary"
_WORDS = "part long, words long, tokens long, documents long, data binary"
_TRIES = "shard long, pairs long, triples long, trie binary"
SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double, triple_score double"


def _strings(words: pa.Array) -> bytes:
    return pack(words=words)


def _part(words: pa.Array, parts: int) -> np.ndarray:
    """The part of each word, by a hash of its bytes."""
    return np.array([zlib.crc32(word) % parts for word in words.cast(pa.binary()).to_pylist()], np.int64)


def _two(first: bytes, second: bytes) -> bytes:
    return len(first).to_bytes(8, "little") + first + second


def _apart(data: bytes) -> tuple[bytes, bytes]:
    cut = 8 + int.from_bytes(data[:8], "little")
    return data[8:cut], data[cut:]


def _tokeniser(block_bytes: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in text_blocks(batches, block_bytes):
            texts = pc.fill_null(rows.column("text").combine_chunks(), "")
            words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
            of_row = numbers(pc.list_parent_indices(words))
            flat = words.flatten()
            some = pc.greater(pc.binary_length(flat), 0)
            flat, of_row = flat.filter(some), of_row[numbers(some)]
            coded = flat.dictionary_encode()
            del texts, words, flat, some
            place, distinct = numbers(coded.indices), coded.dictionary
            learn = numbers(rows.column("learn").combine_chunks())
            counts = np.bincount(of_row, minlength=rows.num_rows)
            # Commoner words get smaller places, which pack better; the end comes last.
            order = np.argsort(-np.bincount(place, minlength=len(distinct)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            place = rank[place]
            learned = np.append(
                np.bincount(place[learn[of_row]], minlength=len(order)), learn.sum()
            )
            distinct = pa.concat_arrays([distinct.take(pa.array(order)), pa.array([END])])
            part = _part(distinct, parts)
            by_part = np.lexsort((np.arange(len(part)), part))
            cuts = np.flatnonzero(np.diff(part[by_part], prepend=-1, append=-1))
            documents = pack(
                doc_id=rows.column("doc_id").combine_chunks(), learn=learn, counts=counts
            )
            data = [_two(documents, squeeze(place, np.array([len(distinct)])))]
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = by_part[low:high]
                data.append(_two(_strings(distinct.take(pa.array(own))), squeeze(own, learned[own])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(data), pa.int64()),
                    pa.array([None, *part[by_part[cuts[:-1]]].tolist()], pa.int64()),
                    pa.array(data, pa.binary()),
                ],
                ["block", "part", "data"],
            )
        give_back()

    return run


def tokenised(docs: DataFrame, block_bytes: int, parts: int) -> DataFrame:
    """Blocks of ``(doc_id, text, learn)``, stored.

    Packed rows of the distinct words of each block, by part of the vocabulary, with their
    places in the block and occurrences in documents to learn from; and one row without a
    part that holds the documents as places.
    """
    return stored(docs.mapInArrow(_tokeniser(block_bytes, parts), _TOKENISED), "tokenised")


@dataclass(frozen=True)
class Vocabulary:
    """All words learned, in packed parts, with their number and occurrences."""

    frame: DataFrame
    parts: int
    words: int
    tokens: int
    documents: int


def _count_words(rows: pa.Table) -> pa.Table:
    words, counts = [], []
    for data in rows.column("data").to_pylist():
        strings, numbers_of = _apart(data)
        words.append(unpack(strings).column("words"))
        counts.append(expand(numbers_of)[1])
    coded = pa.concat_arrays(words).dictionary_encode()
    total = np.bincount(
        numbers(coded.indices), weights=np.concatenate(counts), minlength=len(coded.dictionary)
    ).astype(np.int64)
    # Commoner words get smaller numbers; words of equal counts follow each other as they are.
    ordered = numbers(pc.sort_indices(coded.dictionary))
    order = ordered[np.argsort(-total[ordered], kind="stable")]
    order = order[total[order] > 0]
    distinct = coded.dictionary.take(pa.array(order))
    end = numbers(pc.equal(distinct, END))
    return pa.table(
        {
            "part": rows.column("part").slice(0, 1),
            "words": pa.array([len(order)], pa.int64()),
            "tokens": pa.array([int(total[order].sum())], pa.int64()),
            "documents": pa.array([int(total[order][end].sum())], pa.int64()),
            "data": pa.array([_two(_strings(distinct), squeeze(total[order]))], pa.binary()),
        }
    )


def _totals(frame: DataFrame) -> tuple[int, int, int]:
    return tuple(n or 0 for n in frame.agg(F.sum("words"), F.sum("tokens"), F.sum("documents")).first())


def vocabulary_of(blocks: DataFrame, parts: int) -> Vocabulary:
    """Words that occur in documents to learn from, each counted in its part."""
    rows = blocks.where("part IS NOT NULL").select("part", "data")
    frame = stored(rows.groupBy("part").applyInArrow(_count_words, _WORDS), "vocabulary")
    return Vocabulary(frame, parts, *_totals(frame))


def _name_words(parts: int):
    """Places, numbers and counts of the words of each block; number 0 is an unknown word."""

    def run(asked: pa.Table, known: pa.Table) -> pa.Table:
        part = asked.column("part")[0].as_py() if asked.num_rows else 0  # nobody asks this part
        if known.num_rows:
            strings, counts = _apart(known.column("data")[0].as_py())
            words, count = unpack(strings).column("words"), np.append(expand(counts)[0], 0)
        else:
            words, count = pa.array([], pa.string()), np.zeros(1, np.int64)
        replies = []
        for data in asked.column("data").to_pylist():
            strings, numbers_of = _apart(data)
            at = pc.fill_null(pc.index_in(unpack(strings).column("words"), words), -1)
            at = numbers(at).astype(np.int64)
            # Numbers of all parts interleave; those from 2 on are words.
            number = np.where(at >= 0, at * parts + part + 2, 0)
            replies.append(squeeze(expand(numbers_of)[0], number, count[at]))
        return pa.table(
            {
                "block": asked.column("block"),
                "part": asked.column("part"),
                "data": pa.array(replies, pa.binary()),
            }
        )

    return run


def named_words(blocks: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Places, numbers and counts of the words of each block, by part."""
    words = vocabulary.frame.select(F.col("part").alias("of_part"), "data")
    return (
        blocks.where("part IS NOT NULL")
        .groupBy("part")
        .cogroup(words.groupBy("of_part"))
        .applyInArrow(_name_words(vocabulary.parts), _TOKENISED)
    )


def _count_and_name(parts: int):
    """The same by the words of the very rows that ask; totals of a part stand in its first row."""
    name = _name_words(parts)

    def run(rows: pa.Table) -> pa.Table:
        counted = _count_words(rows)
        named = name(rows, counted)
        for column in ("words", "tokens", "documents"):
            total = np.zeros(named.num_rows, np.int64)
            total[0] = counted.column(column)[0].as_py()
            named = named.append_column(column, pa.array(total))
        return named

    return run


class _Text:
    """Documents of a block as pairs of places: the word before and the word."""

    def __init__(self, data: bytes):
        documents, tokens = _apart(data)
        rows = unpack(documents)
        self.doc_id = rows.column("doc_id")
        self.learn = numbers(rows.column("learn"))
        counts = numbers(rows.column("counts"))
        place, words = expand(tokens)
        self.words = int(words[0])
        self.counts = counts + 1
        ends = np.cumsum(self.counts)
        self._end, self._place = ends - 1, place

    def pairs(self, end: int, begin: int) -> tuple[np.ndarray, np.ndarray]:
        word = np.full(int(self.counts.sum()), end)
        inside = np.ones(len(word), bool)
        inside[self._end] = False
        word[inside] = self._place
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[self._end - self.counts + 1] = begin
        return before, word

    @property
    def first(self) -> np.ndarray:
        """The place of the first word of each text."""
        return self._end - self.counts + 1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


@dataclass
class _Known:
    """Number and count of each word of a block, by its place; both 0 if it was not learned.

    Behind the words of the block, the last of which is the end of a text, stands the
    context at its begin.
    """

    id: np.ndarray
    count: np.ndarray

    @property
    def end(self) -> int:
        return len(self.id) - 2

    @property
    def begin(self) -> int:
        return len(self.id) - 1


@dataclass
class _Grams:
    """Distinct pairs of learned words of a block and the distinct words after each, as they
    travel: in the order of (shard, context, word, next).

    ``pair`` and ``triple`` are those of each token, -1 if a word of it is unknown, and ``after``
    the pair before each token, -1 if there is none. Where a pair's triples are dealt over
    several shards it stands in each of them, with occurrences in its own only.
    """

    before: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    after: np.ndarray
    triple: np.ndarray
    shard: np.ndarray
    context: np.ndarray
    total: np.ndarray
    second: np.ndarray
    often: np.ndarray
    followers: np.ndarray
    next: np.ndarray
    next_often: np.ndarray


def _order(*columns: np.ndarray) -> np.ndarray:
    """The order of distinct rows of numbers from 0 on: one sort where a row fits a number."""
    sizes = [int(column.max(initial=0)) + 1 for column in columns]
    if math.prod(sizes) >= 1 << 63:
        return np.lexsort(columns[::-1])
    key = columns[0]
    for column, size in zip(columns[1:], sizes[1:], strict=True):
        key = key * size + column
    return np.argsort(key)


def _parts(word: np.ndarray, total: np.ndarray, slice_rows: int) -> np.ndarray:
    """The part of each word, of as many as ``total`` occurrences call for."""
    return mix(word.astype(np.uint64)) % (total // slice_rows + 1).astype(np.uint64)


def _distinct_grams(text: _Text, known: _Known, shards: int, slice_rows: int) -> _Grams:
    before, word = text.pairs(known.end, known.begin)
    size = len(known.id)
    learned = text.learn[text.row]

    both = np.flatnonzero((known.id[before] > 0) & (known.id[word] > 0))
    key, inverse = np.unique(before[both] * size + word[both], return_inverse=True)
    first, second = key // size, key % size
    often = np.bincount(inverse, weights=learned[both], minlength=len(key)).astype(np.int64)
    pair = np.full(len(word), -1)
    pair[both] = inverse
    # A triple is the pair of the token before and the word.
    after = np.append(-1, pair[:-1])[: len(pair)]
    after[text.first] = -1
    all_three = np.flatnonzero((after >= 0) & (pair >= 0))
    key, inverse = np.unique(after[all_three] * size + word[all_three], return_inverse=True)
    of_pair, third_place = key // size, key % size
    third = known.id[third_place]
    next_often = np.bincount(inverse, weights=learned[all_three], minlength=len(key)).astype(np.int64)

    context, total, second_id = known.id[first], known.count[first], known.id[second]
    # Words after a common context are dealt over several shards, and those after a common pair.
    home = mix(context.astype(np.uint64) + mix(_parts(second_id, total, slice_rows)))
    part = _parts(third, np.minimum(total, known.count[second])[of_pair], slice_rows)
    shard = (home % np.uint64(shards)).astype(np.int64)
    dealt = np.where(part > 0, mix(home[of_pair] + part), home[of_pair]) % np.uint64(shards)
    dealt = dealt.astype(np.int64)
    away = np.flatnonzero(dealt != shard[of_pair])
    n = len(shard)
    extra, guest = np.unique(dealt[away] * n + of_pair[away], return_inverse=True)
    of_entry = np.concatenate([np.arange(n), extra % max(n, 1)])
    entry_shard = np.concatenate([shard, extra // max(n, 1)])
    entry = of_pair.copy()
    entry[away] = n + guest

    rank = np.empty(size, np.int64)
    rank[np.argsort(known.id)] = np.arange(size)
    order = _order(entry_shard, rank[first[of_entry]], rank[second[of_entry]])
    place = np.empty(len(order) + 1, np.int64)
    place[order], place[-1] = np.arange(len(order)), -1
    next_order = _order(place[entry], rank[third_place])
    next_place = np.empty(len(next_order) + 1, np.int64)
    next_place[next_order], next_place[-1] = np.arange(len(next_order)), -1
    triple = np.full(len(word), -1)
    triple[all_three] = inverse
    from_pair = of_entry[order]
    return _Grams(
        before, word, place[pair], place[after], next_place[triple],
        entry_shard[order], context[from_pair], total[from_pair], second_id[from_pair],
        np.where(order < n, often[from_pair], 0),
        np.bincount(place[entry], minlength=len(order)),
        third[next_order], next_often[next_order],
    )


def _block_pairs(documents: int, shards: int, slice_rows: int):
    def run(block: pa.Table, named: pa.Table) -> pa.Table:
        text = _Text(block.column("data")[0].as_py())
        known = _Known(np.zeros(text.words + 1, np.int64), np.zeros(text.words + 1, np.int64))
        for data in named.column("data").to_pylist():
            at, number, count = expand(data)
            known.id[at], known.count[at] = number, count
        known.id[-1], known.count[-1] = BEGIN, documents
        grams = _distinct_grams(text, known, shards, slice_rows)
        cuts = np.flatnonzero(np.diff(grams.shard, prepend=-1, append=-1))
        ends = np.concatenate([[0], np.cumsum(grams.followers)])
        rows = [squeeze(known.id, known.count)]
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            context = grams.context[low:high]
            new = np.flatnonzero(np.diff(context, prepend=-1))
            rows.append(
                squeeze(
                    np.diff(context[new], prepend=0),
                    np.diff(new, append=high - low),
                    grams.total[low:high][new],
                    grams.second[low:high],
                    grams.often[low:high],
                    grams.followers[low:high],
                    grams.next[ends[low] : ends[high]],
                    grams.next_often[ends[low] : ends[high]],
                )
            )
        number = block.column("block")[0].as_py()
        found = pa.table(
            {
                "block": pa.array([number] * len(rows), pa.int64()),
                "shard": pa.array([-1 - number, *grams.shard[cuts[:-1]].tolist()], pa.int64()),
                "data": pa.array(rows, pa.binary()),
            }
        )
        give_back()
        return found

    return run


class _Row:
    """Pairs of a packed row with the count of their context and their occurrences, and of each
    triple its pair, its last word and its occurrences."""

    def __init__(self, data: bytes):
        steps, pairs, total, self.word, self.often, followers, self.next, self.next_often = expand(data)
        self.context, self.total = np.repeat(np.cumsum(steps), pairs), np.repeat(total, pairs)
        self.pair = np.repeat(np.arange(len(followers)), followers)


def block_pairs(blocks: DataFrame, named: DataFrame, documents: int, shards: int) -> DataFrame:
    """Distinct pairs and triples of each block packed by shard, and a row of a shard below 0,
    its own, that holds the numbers and counts of the block's words."""
    packed = blocks.where("part IS NULL").select("block", "data")
    return (
        packed.groupBy("block")
        .cogroup(named.select("block", "part", "data").groupBy("block"))
        .applyInArrow(_block_pairs(documents, shards, SLICE_ROWS), _PAIRS)
    )


class _Shard:
    """All pairs and triples of a shard, each once, and the rows that hold them."""

    def __init__(self, rows: list[bytes]):
        parts = [_Row(data) for data in rows]
        self.sizes = [(len(part.word), len(part.next)) for part in parts]

        def column(name):
            return np.concatenate([getattr(part, name) for part in parts])

        before = np.cumsum([0, *(pairs for pairs, _ in self.sizes[:-1])])
        of_pair = np.repeat(before, [triples for _, triples in self.sizes]) + column("pair")
        # Numbers of words have less than 31 bits.
        key, self.pair = np.unique(column("context") << 32 | column("word"), return_inverse=True)
        self.context, self.word = key >> 32, key & 0xFFFFFFFF
        self.total = np.empty(len(key), np.int64)
        self.total[self.pair] = column("total")
        self.often = np.bincount(self.pair, weights=column("often"), minlength=len(key))
        key, self.triple = np.unique(self.pair[of_pair] << 32 | column("next"), return_inverse=True)
        self.of_pair, self.next = key >> 32, key & 0xFFFFFFFF
        self.next_often = np.bincount(self.triple, weights=column("next_often"), minlength=len(key))

    def trie(self) -> tuple[int, int, bytes]:
        """The trie of what occurs in documents to learn from, and its pairs and triples."""
        triples = np.flatnonzero(self.next_often)
        there = self.often > 0
        pairs = int(there.sum())
        # Pairs whose triples are dealt here only.
        there[self.of_pair[triples]] = True
        place = np.cumsum(there) - 1
        share = np.log10((self.total[there] + STRENGTH) / np.maximum(self.often[there], 1))
        codes = np.minimum(np.rint(share * STEPS), ABSENT - 1)
        codes = np.where(self.often[there] > 0, codes, ABSENT).astype("<u2")
        counts = np.rint(np.log10(self.next_often[triples]) * STEPS).astype("<u2")
        return pairs, len(triples), join_tries(
            Trie.build(self.context[there], self.word[there], codes),
            Trie.build(place[self.of_pair[triples]], self.next[triples], counts),
        )


def _build(rows: pa.Table) -> pa.Table:
    pairs, triples, trie = _Shard(rows.column("data").to_pylist()).trie()
    shard = rows.column("shard").slice(0, 1)
    return pa.table(
        {"shard": shard, "pairs": [pairs], "triples": [triples], "trie": pa.array([trie], pa.binary())}
    )


@dataclass(frozen=True)
class Model:
    """A language model: its vocabulary, and a table of one trie per shard."""

    vocabulary: Vocabulary
    shards: int
    tries: DataFrame


def _shards(docs: DataFrame) -> int:
    return row_blocks(docs, SHARD_BYTES)


def _codes(tries: list[Trie], context, word, of_pair, following) -> tuple[np.ndarray, np.ndarray]:
    """The code of each pair, and of each triple by the place of its pair."""
    pairs, triples = tries
    place = pairs.places(context, word)
    after = place[of_pair]
    known = np.flatnonzero(after >= 0)
    codes = np.full(len(after), ABSENT)
    codes[known] = triples.codes(after[known], following[known], ABSENT)
    return np.append(pairs.own_codes, ABSENT)[place].astype(np.int64), codes


def _replies(asked: pa.Table, codes) -> pa.Table:
    """The codes of all pairs and triples of each packed row, in its order."""
    # The code of no pair as 0 takes one byte where most are of that kind; a triple's is its count's.
    replies = [squeeze(ABSENT - own, (following + 1) % (ABSENT + 1)) for own, following in codes]
    found = pa.table(
        {
            "block": asked.column("block"),
            "shard": asked.column("shard"),
            "data": pa.array(replies, pa.binary()),
        }
    )
    give_back()
    return found


def _no_shard(asked: pa.Table) -> bool:
    """Whether these are the numbers and counts of the words of a block, which go on as they are."""
    return not asked.num_rows or asked.column("shard")[0].as_py() < 0


def _answer(asked: pa.Table, tries: pa.Table) -> pa.Table:
    if _no_shard(asked):
        return asked
    rows = map(_Row, asked.column("data").to_pylist())
    if not tries.num_rows:
        return _replies(asked, ((np.full(len(r.word), ABSENT), np.full(len(r.next), ABSENT)) for r in rows))
    trie = split_tries(tries.column("trie")[0].as_buffer())
    return _replies(asked, (_codes(trie, r.context, r.word, r.pair, r.next) for r in rows))


def _learn_and_answer(asked: pa.Table) -> pa.Table:
    """Answers of a shard whose trie is built from the very rows that ask, each pair asked once."""
    if _no_shard(asked):
        return asked
    shard = _Shard(asked.column("data").to_pylist())
    *_, trie = shard.trie()
    pairs, triples = _codes(split_tries(trie), shard.context, shard.word, shard.of_pair, shard.next)
    ends = np.cumsum(shard.sizes, axis=0)[:-1]
    return _replies(
        asked,
        zip(
            np.split(pairs[shard.pair], ends[:, 0]), np.split(triples[shard.triple], ends[:, 1]), strict=True
        ),
    )


def _scorer(words: int, tokens: int, shards: int, slice_rows: int):
    def run(block: pa.Table, parts: pa.Table) -> pa.Table:
        text = _Text(block.column("data")[0].as_py())
        rows = parts.sort_by([("shard", "ascending")])  # the words, below 0, come first
        named, *replies = rows.column("data").to_pylist()
        id_, count = expand(named)
        known = _Known(id_, count)
        grams = _distinct_grams(text, known, shards, slice_rows)
        replies = [expand(reply) for reply in replies]
        none = [np.zeros(0, np.int64)]
        codes = ABSENT - np.concatenate([*(pairs for pairs, _ in replies), *none])
        counts = np.concatenate([*(triples for _, triples in replies), *none]) - 1
        seen = np.append(np.where(codes == ABSENT, 0.0, 10.0 ** (-codes / STEPS)), 0.0)
        pair_count = np.append(np.rint(seen[:-1] * (grams.total + STRENGTH)), 0.0)
        triple_count = np.append(np.where(counts < 0, 0.0, 10.0 ** (counts / STEPS)), 0.0)
        learned = np.where(np.arange(len(known.id)) == known.begin, 0, known.count)
        alone = (learned + 1) / (tokens + words + 1)
        prior = STRENGTH / (known.count + STRENGTH)
        word = grams.word
        after_one = seen[grams.pair] + prior[grams.before] * alone[word]
        after_two = (triple_count[grams.triple] + TRIPLE_STRENGTH * after_one) / (
            pair_count[grams.after] + TRIPLE_STRENGTH
        )
        row, size = text.row, len(text.counts)

        def total(values):
            return np.bincount(row, weights=values, minlength=size)

        return pa.table(
            {
                "doc_id": text.doc_id,
                "n_tokens": text.counts,
                "n_known": total(learned[word] > 0).astype(np.int64),
                "base_score": total(np.log10(alone)[word]),
                "score": total(np.log10(after_one)),
                "triple_score": total(np.log10(after_two)),
            }
        )

    return run


def _score(blocks: DataFrame, answers: DataFrame, words: int, tokens: int, shards: int) -> DataFrame:
    packed = blocks.where("part IS NULL").select("block", "data")
    return (
        packed.groupBy("block")
        .cogroup(answers.select(F.col("block").alias("of_block"), "shard", "data").groupBy("of_block"))
        .applyInArrow(_scorer(words, tokens, shards, SLICE_ROWS), SCORED)
    )


def _texts(docs: DataFrame, learn) -> DataFrame:
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").alias("text"),
        learn.alias("learn"),
    )


def learn(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> Model:
    """A model of all texts of ``docs``; null texts count as empty ones."""
    shards = _shards(docs)
    blocks = tokenised(_texts(docs, F.lit(True)), block_bytes, shards)
    vocabulary = vocabulary_of(blocks, shards)
    named = named_words(blocks, vocabulary)
    pairs = block_pairs(blocks, named, vocabulary.documents, shards).where("shard >= 0")
    tries = pairs.select("shard", "data").groupBy("shard").applyInArrow(_build, _TRIES)
    return Model(vocabulary, shards, stored(tries, "tries"))


def score(docs: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score, triple_score)``, one row per row of ``docs``.

    Tokens are the words, A-Z in lower case, and one end; ``base_score`` takes each word
    alone, ``score`` after the word before, ``triple_score`` after the two words before. A null text counts as empty and has the end only. Null
    and repeated ids stay, other columns are ignored, an empty table gives an empty result;
    a model of no documents knows no word. A text longer than a block is a block of its own.
    """
    vocabulary, shards = model.vocabulary, model.shards
    blocks = tokenised(_texts(docs, F.lit(False)), block_bytes, vocabulary.parts)
    pairs = block_pairs(blocks, named_words(blocks, vocabulary), vocabulary.documents, shards)
    tries = model.tries.select(F.col("shard").alias("of_shard"), "trie")
    answers = (
        pairs.groupBy("shard").cogroup(tries.groupBy("of_shard")).applyInArrow(_answer, _PAIRS)
    )
    return _score(blocks, answers, vocabulary.words, vocabulary.tokens, shards)


def held_out():
    """Whether a document is kept from learning: by its id as text, null like an empty one."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2


def learn_and_score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of all documents by a model of those that are not held out.

    As :func:`score`, with ``held_out`` and ``train_tokens``, the tokens learned from. Texts
    are read once for both, words are counted and named in one task, and a shard's trie is built
    and asked in one: it is what :func:`learn` would have stored.
    """
    shards = _shards(docs)
    blocks = tokenised(_texts(docs, ~held_out()), block_bytes, shards)
    asked = blocks.where("part IS NOT NULL")
    named = stored(asked.groupBy("part").applyInArrow(_count_and_name(shards), _NAMED), "named")
    words, tokens, documents = _totals(named)
    pairs = block_pairs(blocks, named, documents, shards)
    answers = pairs.groupBy("shard").applyInArrow(_learn_and_answer, _PAIRS)
    scored = _score(blocks, answers, words, tokens, shards)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "triple_score",
    )
