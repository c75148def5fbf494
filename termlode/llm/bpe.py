"""Byte-level BPE by a global shuffle of distinct words.

Pre-tokens are found with the tokenizer's pattern in the scan. Documents are dealt into
blocks, a block hands its distinct words to the partition of each word, where every word
of the corpus is encoded once, and the ids come back to the block, which puts them in
place of its pre-tokens by position. So what crosses the network beside the text is the
distinct words of each block and their ids, packed, and not every occurrence.

Decoding is a map-side join with the token-byte table, which has one row per token.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.blocks import give_back
from termlode.llm.common import keyed, row_blocks

RANKS = "byte_bpe_multi_50k.tiktoken"
BLOCK_BYTES = 12 << 20


_PACKED = "part long, block long, size long, packed binary"
ENCODED = "rid long, doc_id long, n_tokens long, ids binary, decoded binary"


def read_ranks(path: str | None = None) -> bytes:
    """The rank file, one line per token; its size is fixed by the tokenizer."""
    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def tokens_of(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}


@lru_cache(maxsize=2)
def _encoding(ranks: bytes) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "ranks",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=tokens_of(ranks),
        special_tokens={},
    )


_CODEC = pa.Codec("zstd", compression_level=6)


def pack(words: list[bytes]) -> tuple[int, bytes]:
    """Size unpacked, and the words compressed: item size, count, lengths, bytes."""
    longest = max(map(len, words), default=0)
    width = 1 if longest < 1 << 8 else 2 if longest < 1 << 16 else 4
    lengths = np.array([len(word) for word in words], f"<u{width}").tobytes()
    data = bytes([width]) + np.uint32(len(words)).tobytes() + lengths + b"".join(words)
    return len(data), _CODEC.compress(data, asbytes=True)


def unpack(size: int, packed: bytes) -> list[bytes]:
    data = _CODEC.decompress(packed, decompressed_size=size, asbytes=True)
    width, count = data[0], int(np.frombuffer(data, "<u4", 1, 1)[0])
    first = 5 + width * count
    ends = (first + np.cumsum(np.frombuffer(data, f"<u{width}", count, 5), dtype=np.int64)).tolist()
    return [data[a:b] for a, b in zip([first, *ends], ends, strict=False)]


def _id_type(ranks: bytes) -> str:
    """The narrowest type on the way that holds every id."""
    return "<u2" if max(tokens_of(ranks).values()) < 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def _bytes_of(ranks: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in tokens_of(ranks).items()}


def decode_ids(ids: bytes | None, ranks: bytes) -> bytes:
    """Bytes of little-endian unsigned 32-bit ids, by a join with the token-byte table."""
    table = _bytes_of(ranks)
    return b"".join([table[i] for i in np.frombuffer(ids or b"", "<u4").tolist()])


def _block_words(table: pa.Table, parts: int) -> tuple[pa.Array, list[bytes], np.ndarray]:
    """All pre-tokens of a block, its distinct ones in order, and the part of each.

    The order is that of (part, word), whatever the order of the rows.
    """
    flat = table.column("words").combine_chunks().flatten().cast(pa.binary())
    distinct = flat.unique()
    words = distinct.take(pc.sort_indices(distinct)).to_pylist()
    part = np.array([zlib.crc32(word) % parts for word in words], np.int64)
    order = np.argsort(part, kind="stable")
    return flat, [words[i] for i in order.tolist()], part[order]


def _bundles(parts: int):
    def run(table: pa.Table) -> pa.Table:
        _, words, part = _block_words(table, parts)
        block = table.column("block")[0].as_py()
        cuts = np.searchsorted(part, np.arange(parts + 1))
        rows = [
            (p, block, *pack(words[cuts[p] : cuts[p + 1]]))
            for p in range(parts)
            if cuts[p] < cuts[p + 1]
        ]
        give_back()
        return pa.table(dict(zip(("part", "block", "size", "packed"), _columns(rows), strict=True)))

    return run


def _columns(rows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())]


def _encode_part(ranks: bytes):
    def run(table: pa.Table) -> pa.Table:
        encode = _encoding(ranks).encode_ordinary
        known: dict[bytes, bytes] = {}
        kind = _id_type(ranks)
        rows = []
        for part, block, size, packed in zip(
            *(table.column(c).to_pylist() for c in ("part", "block", "size", "packed")), strict=True
        ):
            words = unpack(size, packed)
            for word in words:
                if word not in known:
                    known[word] = np.array(encode(word.decode("utf-8")), kind).tobytes()
            rows.append((part, block, *pack([known[word] for word in words])))
        del known
        give_back()
        return pa.table(dict(zip(("part", "block", "size", "packed"), _columns(rows), strict=True)))

    return run


def _assemble(parts: int, ranks: bytes, with_decoded: bool):
    def run(documents: pa.Table, replies: pa.Table) -> pa.Table:
        flat, words, _ = _block_words(documents, parts)
        replies = replies.sort_by("part")
        kind = _id_type(ranks)
        ids = [
            word_ids
            for size, packed in zip(
                replies.column("size").to_pylist(), replies.column("packed").to_pylist(), strict=True
            )
            for word_ids in unpack(size, packed)
        ]
        place = pc.index_in(flat, pa.array(words, pa.binary())).to_numpy(zero_copy_only=False)
        del flat, words
        give_back()
        counts = pc.fill_null(pc.list_value_length(documents.column("words")), 0).to_numpy()
        ends = np.cumsum(counts)
        joined = [
            np.frombuffer(b"".join([ids[i] for i in place[low:high].tolist()]), kind)
            .astype("<u4")
            .tobytes()
            for low, high in zip(ends - counts, ends, strict=True)
        ]
        return pa.table(
            {
                "rid": documents.column("rid"),
                "doc_id": documents.column("doc_id"),
                "n_tokens": pa.array([len(x) // 4 for x in joined], pa.int64()),
                "ids": pa.array(joined, pa.binary()),
                "decoded": pa.array(
                    [decode_ids(x, ranks) if with_decoded else None for x in joined], pa.binary()
                ),
            }
        )

    return run


def pre_tokens(text):
    """Array of the pattern's matches; ``\\s`` means all Unicode white space.

    A text with a character that is newer than this engine's tables, where it is neither
    letter nor digit, is one pre-token: the encoder cuts what it gets by the same pattern.
    """
    text = F.coalesce(text, F.lit(""))
    matches = F.regexp_extract_all(text, F.lit("(?U)" + public_tokenizers.PATTERN), F.lit(0))
    return F.when(text.rlike(r"\p{Cn}"), F.array(text)).otherwise(matches)


def _encoded(
    docs: DataFrame, ranks_path: str | None, with_decoded: bool, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    ranks = read_ranks(ranks_path)
    rows = keyed(docs)
    blocks = row_blocks(rows, block_bytes)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks))).repartition(
        tasks, "block"
    )
    split = dealt.select("block", "rid", "doc_id", pre_tokens(F.col("text")).alias("words"))
    bundles = split.groupBy("block").applyInArrow(_bundles(tasks), _PACKED)
    replies = bundles.groupBy("part").applyInArrow(_encode_part(ranks), _PACKED)
    return (
        split.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(_assemble(tasks, ranks, with_decoded), ENCODED)
    )


def encode(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """``(rid, doc_id, n_tokens, ids)``, one row per row of ``docs``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers, as an
    encoder of the whole text without special tokens gives them. A null or empty text
    has no tokens. Repeated rows are encoded each; columns other than doc_id and text
    are ignored; an empty table gives an empty result.
    """
    return _encoded(docs, ranks_path, False).drop("decoded")


def decode(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """All columns of a table with ``ids``, and ``decoded``, the bytes these stand for.

    Null ids decode to no bytes; an id that is no token is an error. A column
    ``decoded`` of the input is replaced.
    """
    ranks = read_ranks(ranks_path)
    encoded = encoded.drop("decoded")
    schema = encoded.select("*", F.lit(b"").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                decoded = [decode_ids(ids, ranks) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())], schema.names
                )

    return encoded.mapInArrow(run, schema)


def round_trip(
    docs: DataFrame, ranks_path: str | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row per row of ``docs``.

    Encodes, and decodes the ids in the task that put them together: a second Python
    worker per task would only hold them once more. Larger blocks share more words and
    shuffle less, smaller ones need less memory.
    """
    return _encoded(docs, ranks_path, True, block_bytes).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
