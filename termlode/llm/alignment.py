"""Alignment of the tokens of two tokenizers by anchors at white space.

Every text is tokenised whole by both. Where a token of either ends before a space-marked
token, at the same byte, lies an anchor; it is verified by the byte offsets of both. Anchors
cut a document into windows, pairs of id tuples, and equal windows of a block are aligned once:
groups end where both have a token end, and all tokens of a group are linked across. Equal
windows of a slice are told by a hash and compared token by token before they count as one.

A block of documents is one stored row of window numbers and a table of its windows. Links
are counted by document within the block, summed over blocks by Spark, and handed back.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.blocks import numbers, pack, ranges, sums, text_blocks, unpack
from termlode.llm.common import documents_of, stored
from termlode.llm.fingerprints import byte_lengths, mix

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

BLOCK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20

_SPACE = 0x20
_STORED = "block long, place int, a int, b int, docs long, rows binary, windows binary"
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes in order for the
    characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Pair:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, byte_level: str, pieces: bytes):
        byte = byte_characters()
        ranks = {
            bytes(byte[c] for c in token): rank
            for token, rank in json.loads(byte_level)["model"]["vocab"].items()
        }
        # A merge's rank is the number of the token it makes, so this is the same encoder.
        self._a = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        self.bytes_b = [
            bytes([int(piece[3:-1], 16)])
            if self._b.is_byte(i)
            else piece.replace("▁", " ").encode("utf-8")
            for i, piece in enumerate(map(self._b.id_to_piece, range(self._b.get_piece_size())))
        ]
        self.length_a, self.length_b = (
            np.array([len(token) for token in table], np.int64)
            for table in (self.bytes_a, self.bytes_b)
        )
        # Each id in decimal, with room for what follows it.
        names = [b"%d" % i for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.digits = np.array([len(name) for name in names], np.int64)
        self.names = np.array(names, f"S{self.digits[-1] + 1}").view(np.uint8).reshape(len(names), -1)

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, bytes] | None]:
        """Ids by both and the bytes they stand for; None where these are not the text's."""
        found = [
            (
                np.array(self._a.encode_ordinary(whole), np.int32),
                self._b.encode(whole[1:], return_type="numpy"),
                whole.encode("utf-8"),
            )
            for whole in (f" {text}" for text in texts if text)
        ]
        data = [tokens[2] for tokens in found]
        right = iter(
            self._spell([tokens[0] for tokens in found], self.bytes_a, self.length_a, data)
            & self._spell([tokens[1] for tokens in found], self.bytes_b, self.length_b, data)
        )
        left = iter(found)
        found = [(next(left), next(right)) if text else (None, False) for text in texts]
        return [tokens if same else None for tokens, same in found]

    @staticmethod
    def _spell(ids: list[np.ndarray], table: list[bytes], lengths: np.ndarray, data: list[bytes]) -> np.ndarray:
        """Whether the ids of each text stand for its bytes."""
        sizes = np.array([len(text) for text in data], np.int64)
        counts = np.array([len(own) for own in ids], np.int64)
        flat = np.concatenate([*ids, np.zeros(0, np.int32)])
        same = sums(lengths[flat], counts) == sizes
        flat = flat[np.repeat(same, counts)]
        spelt = np.frombuffer(b"".join([table[i] for i in flat.tolist()]), np.uint8)
        wanted = np.frombuffer(b"".join([text for text, s in zip(data, same, strict=True) if s]), np.uint8)
        wrong = np.flatnonzero(spelt != wanted)
        same[np.repeat(np.flatnonzero(same), sizes[same])[wrong]] = False
        return same


@lru_cache(maxsize=1)
def _pair(byte_level: str, pieces: bytes) -> _Pair:
    return _Pair(byte_level, pieces)


class _Windows(dict):
    """Number of each window of a block, by its ids as bytes with -1 in between, in order of coming."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def _ends(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths[ids])


def _hashes(tokens: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the runs of tokens that lie one after the other."""
    place = np.arange(len(tokens)) - np.repeat(first, count)
    terms = mix((place << 32 | tokens).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return mix(sums(terms, count) + count.astype(np.uint64))


def _distinct(tokens, firsts, counts) -> tuple[np.ndarray, np.ndarray]:
    """The first of each of several equal windows, in their order, and which of these each is."""
    keys = [_hashes(*side) for side in zip(tokens, firsts, counts, strict=True)]
    key = keys[0] * np.uint64(0xC2B2AE3D27D4EB4F) + keys[1]
    _, at, which = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(at)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    at, which = at[order], rank[which]
    for side, first, count in zip(tokens, firsts, counts, strict=True):
        same = at[which]
        if (count != count[same]).any() or (side != side[ranges(first[same], count)]).any():
            return np.arange(len(key)), np.arange(len(key))  # two windows with one hash
    return at, which


class _Block:
    """Windows and documents of a block, added slice by slice."""

    def __init__(self, pair: _Pair):
        self.pair = pair
        self.numbers = _Windows()
        self.fragments: list[bytes] = []
        self.groups, self.window, self.pairs, self.times = [], [], [], []
        self.rows: list[tuple] = []
        self.of_rows: list[np.ndarray] = []

    def add(self, texts: list[str | None], ids: list[int | None]) -> None:
        pair = self.pair
        found = pair.tokens(texts)
        whole = [tokens for tokens in found if tokens]
        a, b = (
            np.concatenate([*(tokens[side] for tokens in whole), np.zeros(0, np.int32)]) for side in (0, 1)
        )
        # Every document begins with a space, so its end is an anchor like any other.
        data = np.frombuffer(b"".join([tokens[2] for tokens in whole]) + b" ", np.uint8)
        ends_a, ends_b = _ends(a, pair.length_a), _ends(b, pair.length_b)
        is_end_a, is_end_b = np.zeros(len(data), bool), np.zeros(len(data), bool)
        is_end_a[ends_a], is_end_b[ends_b] = True, True
        shared_a, shared_b = is_end_b[ends_a], is_end_a[ends_b]
        lasts = [
            np.flatnonzero(shared & (data[ends] == _SPACE)) + 1
            for shared, ends in ((shared_a, ends_a), (shared_b, ends_b))
        ]
        firsts = [np.concatenate([[0], last[:-1]]) if len(last) else last for last in lasts]
        counts = [last - first for first, last in zip(firsts, lasts, strict=True)]
        at, which = _distinct((a, b), firsts, counts)
        sizes = [4 * count[at] for count in counts]
        ends = np.cumsum(sizes[0] + sizes[1] + 4)
        both = np.full(int(ends[-1]) // 4 if len(ends) else 0, -1, np.int32)
        for side, first, size, begin in zip(
            (a, b), firsts, sizes, (ends - sizes[0] - sizes[1] - 4, ends - sizes[1]), strict=True
        ):
            both[ranges(begin // 4, size // 4)] = side[ranges(first[at], size // 4)]
        data_of, ends = both.tobytes(), ends.tolist()
        known = len(self.numbers)
        number = self.numbers
        own = np.array(
            [number[data_of[low:high]] for low, high in zip([0, *ends], ends, strict=False)], np.int64
        )
        window = own[which]
        new, place = np.unique(own, return_index=True)
        at = at[place[new >= known]]
        self._align(at, firsts, lasts, (a, b), (shared_a, shared_b))
        documents = np.searchsorted(
            ends_a[lasts[0] - 1], np.cumsum([len(tokens[2]) for tokens in whole]), "left"
        ) + 1 if whole else np.zeros(0, np.int64)
        low = part = 0
        for doc_id, tokens in zip(ids, found, strict=True):
            if tokens is None:
                self.rows.append((doc_id, 0, 0, ""))
                self.of_rows.append(window[:0])
                continue
            high = int(documents[part])
            own = window[low:high]
            text = b";".join([self.fragments[i] for i in own.tolist()])
            self.rows.append(
                (doc_id, len(tokens[0]), len(tokens[1]), hashlib.sha256(text).hexdigest())
            )
            self.of_rows.append(own)
            low, part = high, part + 1

    def _align(self, at, firsts, lasts, tokens, shared) -> None:
        """Groups and linked pairs of the windows that are new, in order of their numbers."""
        pair = self.pair
        first_number = len(self.fragments)
        counts = [last[at] - first[at] for first, last in zip(firsts, lasts, strict=True)]
        places = [ranges(first[at], count) for first, count in zip(firsts, counts, strict=True)]
        ids = [side[place] for side, place in zip(tokens, places, strict=True)]
        ends = [side[place] for side, place in zip(shared, places, strict=True)]
        cuts = [np.flatnonzero(end) + 1 for end in ends]
        sizes = [np.diff(cut, prepend=0) for cut in cuts]
        of_window = np.repeat(np.arange(len(at)), counts[0])[cuts[0] - 1]
        self.groups.append(np.bincount(of_window, minlength=len(at)))
        # All tokens of a group across: its A tokens, each as often as it has B tokens.
        group = np.repeat(np.arange(len(cuts[0])), sizes[0])
        left = np.repeat(np.arange(len(ids[0])), sizes[1][group])
        right = ranges((cuts[1] - sizes[1])[group], sizes[1][group])
        key = ids[0][left].astype(np.int64) << 32 | ids[1][right]
        window = of_window[group[left]] + first_number
        order = np.lexsort((key, window))
        key, window = key[order], window[order]
        new = np.flatnonzero(np.diff(key, prepend=-1).astype(bool) | np.diff(window, prepend=-1).astype(bool))
        self.pairs.append(key[new])
        self.window.append(window[new])
        self.times.append(np.diff(new, append=len(key)))
        # Written in the order of groups, each its A tokens and then its B tokens.
        written = [
            np.arange(len(ids[0])) + np.repeat(cuts[1] - sizes[1], sizes[0]),
            np.arange(len(ids[1])) + np.repeat(cuts[0], sizes[1]),
        ]
        name = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        follows = np.full(len(name), ord(","), np.uint8)
        for place, side, cut, mark in zip(written, ids, cuts, b"|;", strict=True):
            name[place] = side
            follows[place[cut - 1]] = mark
        text, digits = pair.names[name], pair.digits[name]
        text[np.arange(len(name)), digits] = follows
        data = text[np.arange(text.shape[1]) <= digits[:, None]].tobytes()
        ends = np.cumsum(digits + 1)[np.cumsum(counts[0] + counts[1]) - 1].tolist()
        self.fragments.extend([data[low : high - 1] for low, high in zip([0, *ends], ends, strict=False)])

    def stored(self, block: int) -> pa.RecordBatch:
        """The pairs of the block with their documents, and the block itself as one more row."""
        window, pairs, times = (
            np.concatenate(parts) if parts else np.zeros(0, np.int64)
            for parts in (self.window, self.pairs, self.times)
        )
        distinct, place = np.unique(pairs, return_inverse=True)
        linked = np.bincount(window, minlength=len(self.fragments))
        starts = np.cumsum(linked) - linked
        docs = np.zeros(len(distinct), np.int64)
        stamp = np.zeros(len(distinct), np.int64)
        own, often = [], []
        for windows in self.of_rows:
            once, count = np.unique(windows, return_counts=True)
            own.append(once)
            often.append(count)
            held = place[ranges(starts[once], linked[once])]
            order = np.arange(len(held))
            stamp[held] = order  # of places that repeat, the last one stays
            docs[held[stamp[held] == order]] += 1
        lengths = np.array([len(once) for once in own], np.int64)
        doc_id, n_a, n_b, digest = zip(*self.rows, strict=True) if self.rows else ((),) * 4
        rows = pack(
            doc_id=pa.array(doc_id, pa.int64()),
            n_a=pa.array(n_a, pa.int64()),
            n_b=pa.array(n_b, pa.int64()),
            digest=pa.array(digest, pa.string()),
            windows=lengths,
        )
        places = pack(
            window=np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.uint32),
            often=np.concatenate([*often, np.zeros(0, np.int64)]).astype(np.uint32),
        )
        groups = np.concatenate([*self.groups, np.zeros(0, np.int64)])
        table = pack(
            groups=pa.array([groups.astype(np.uint32)]),
            linked=pa.array([linked.astype(np.uint32)]),
            place=pa.array([place.astype(np.uint32)]),
            times=pa.array([times.astype(np.uint32)]),
        )
        n = len(distinct)

        def column(values, last, kind):
            return pa.concat_arrays([pa.array(values, kind), pa.array([last], kind)])

        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, block), pa.int64()),
                column(np.arange(n), None, pa.int32()),
                column(distinct >> 32, None, pa.int32()),
                column(distinct & 0xFFFFFFFF, None, pa.int32()),
                column(docs, None, pa.int64()),
                pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([_two(rows, places)], pa.binary())]),
                pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([table], pa.binary())]),
            ],
            ["block", "place", "a", "b", "docs", "rows", "windows"],
        )


def _two(first: bytes, second: bytes) -> bytes:
    return len(first).to_bytes(8, "little") + first + second


def _aligner(byte_level: str, pieces: bytes, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(byte_level, pieces)
        for number, rows in text_blocks(batches, block_bytes):
            block = _Block(pair)
            texts, ids = rows.column("text").combine_chunks(), rows.column("doc_id").to_pylist()
            ends = np.cumsum(byte_lengths(texts))
            low = 0
            while low < len(ids):
                before = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
                block.add(texts.slice(low, high - low).to_pylist(), ids[low:high])
                low = high
            found = block.stored(number)
            for low in range(0, found.num_rows, 100_000):
                yield found.slice(low, 100_000)

    return run


def _summed(rows: pa.Table, replies: pa.Table) -> pa.Table:
    data = rows.column("rows")[0].as_py()
    cut = 8 + int.from_bytes(data[:8], "little")
    documents, own = unpack(data[8:cut]), unpack(data[cut:])
    table = unpack(rows.column("windows")[0].as_py())
    groups, linked, place, times = (
        numbers(table.column(name)[0].values).astype(np.int64)
        for name in ("groups", "linked", "place", "times")
    )
    at = numbers(replies.column("place").combine_chunks())
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at] = numbers(replies.column("count").combine_chunks())
    best[at] = numbers(replies.column("best").combine_chunks())
    window, often = (numbers(own.column(name)).astype(np.int64) for name in ("window", "often"))
    per_row = numbers(documents.column("windows"))
    n_groups, n_links, n_best, count_sum = (
        sums(of_window[window] * often, per_row)
        for of_window in (
            groups,
            sums(times, linked),
            sums(times * best[place], linked),
            sums(times * count[place], linked),
        )
    )
    return pa.table(
        {
            "doc_id": documents.column("doc_id"),
            "n_a": documents.column("n_a"),
            "n_b": documents.column("n_b"),
            "n_groups": n_groups,
            "n_links": n_links,
            "n_best": n_best,
            "count_sum": count_sum,
            "groups_sha256": documents.column("digest"),
        }
    )


def read_tokenizers(byte_level: str | None = None, pieces: str | None = None) -> tuple[str, bytes]:
    """The files of both tokenizers, whose size does not depend on the data."""
    with open(byte_level or public_tokenizers.path(BYTE_LEVEL), encoding="utf-8") as file:
        first = file.read()
    with open(pieces or public_tokenizers.path(PIECES), "rb") as file:
        return first, file.read()


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(a, b, count, best)``: documents that hold each linked pair, and whether no other
    pair of the same A id is held by more."""
    counted = stored(
        blocks.where("place IS NOT NULL").groupBy("a", "b").agg(F.sum("docs").alias("count")), "pairs"
    )
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    return counted.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(
    docs: DataFrame,
    byte_level: str | None = None,
    pieces: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Alignment of the tokens of two tokenizers, one row per row of ``docs``.

    ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``. Offsets
    are those of a space and the text in UTF-8. A text that is null, empty or not what the
    tokens of either stand for has zeros and an empty digest. Null and repeated ids stay,
    equal texts are counted each, other columns are ignored, an empty table gives an empty
    result. A text longer than a block is a block of its own.
    """
    files = read_tokenizers(byte_level, pieces)
    blocks = stored(
        documents_of(docs).mapInArrow(_aligner(*files, block_bytes), _STORED), "blocks"
    )
    replies = (
        blocks.where("place IS NOT NULL")
        .select("block", "place", "a", "b")
        .join(pair_counts(blocks), ["a", "b"])
        .select(F.col("block").alias("of_block"), "place", "count", "best")
    )
    packed = blocks.where("place IS NULL").select("block", "rows", "windows")
    return packed.groupBy("block").cogroup(replies.groupBy("of_block")).applyInArrow(_summed, ALIGNED)
