"""Alignment of two tokenizers against a plain form that goes token by token."""

import hashlib
import os
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from termlode.llm import alignment
from termlode.llm.queries import op11_tokenizer_alignment

SF_DIR = "/root/testdata/sf0.001"
os.environ["TOKENIZERS_PARALLELISM"] = "false"

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
BYTE = alignment.byte_characters()


def piece_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def groups_of(text):
    if not text:
        return None
    data = (" " + text).encode()
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    sides = []
    for ids, of in ((a, lambda i: bytes(BYTE[c] for c in A.id_to_token(i))), (b, piece_bytes)):
        end, ends = 0, []
        for i in ids:
            end += len(of(i))
            ends.append(end)
        if b"".join(map(of, ids)) != data:
            return None
        sides.append(list(zip(ids, ends, strict=True)))
    common = sorted({end for _, end in sides[0]} & {end for _, end in sides[1]})
    groups, low = [], 0
    for high in common:
        groups.append([[i for i, end in side if low < end <= high] for side in sides])
        low = high
    return groups


def expected(texts):
    parsed = [groups_of(text) for text in texts]
    links = [[(a, b) for left, right in groups or [] for a in left for b in right] for groups in parsed]
    count = Counter(pair for own in links for pair in set(own))
    most = Counter()
    for (a, _), docs in count.items():
        most[a] = max(most[a], docs)
    for groups, own in zip(parsed, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups or [])
        yield (
            sum(len(x) for x, _ in groups or []),
            sum(len(y) for _, y in groups or []),
            len(groups or []),
            len(own),
            sum(count[pair] == most[pair[0]] for pair in own),
            sum(count[pair] for pair in own),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        )


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {row["doc_id"]: tuple(row[c] for c in COLUMNS) for row in op11_tokenizer_alignment(spark, SF_DIR).collect()}
    assert found == dict(zip([r["doc_id"] for r in rows], expected([r["text"] for r in rows]), strict=True))


TEXTS = [
    None, "", " ", "a", "a", "  two  blanks\n\nlines\t", "▁ mark", "<|endoftext|> and <s> </s> <unk>",
    "café 你好 \U0001f600 ࡰ's house", "\x00 nul", "x" * 3000, "word " * 4000,
    "café ﬁ ½    ", " ", "it's we'll 12345 !!!  ...",
]


def test_odd_texts_in_small_blocks(spark, monkeypatch):
    rows = [(i if i % 3 else None, text, 7, 8) for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a int, block int")
    want = sorted(expected(TEXTS))
    for block_bytes in (10, 1 << 20):
        found = alignment.align(docs, block_bytes=block_bytes).collect()
        assert sorted(tuple(row[c] for c in COLUMNS) for row in found) == want
        assert sorted(row["doc_id"] or 0 for row in found) == sorted(row[0] or 0 for row in rows)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 7)
    found = alignment.align(docs).collect()
    assert sorted(tuple(row[c] for c in COLUMNS) for row in found) == want
    assert alignment.align(docs.limit(0)).count() == 0


def test_both_engines_of_the_byte_level_tokenizer_agree():
    """Ids come from another library than the file was made for: same for all characters."""
    pair = alignment._pair(*alignment.read_tokenizers())
    for low in range(0, 0x32000, 512):
        points = [chr(c) for c in range(low, low + 512) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b {c}1{c}'s{c}{c} x\n{c} {c}  {c}" for c in points)
        assert A.encode(text, add_special_tokens=False).ids == pair._a.encode_ordinary(text)


def test_windows_count_as_equal_only_token_by_token(monkeypatch):
    words = ["a", "b", "café", "12345", "x" * 40, "▁", "你好", "it's"]
    texts = [" ".join(words[(i * k + i) % len(words)] for k in range(i)) for i in range(1, 30)]
    texts += TEXTS

    def block():
        found = alignment._Block(alignment._pair(*alignment.read_tokenizers()))
        found.add(texts, list(range(len(texts))))
        return found

    def windows(block):
        return [[block.fragments[i] for i in own.tolist()] for own in block.of_rows]

    apart, asked = block(), []
    hashes = alignment._hashes

    def few(tokens, first, count):
        asked.append(len(first))
        return hashes(tokens, first, count) % np.uint64(3)

    monkeypatch.setattr(alignment, "_hashes", few)
    together = block()
    assert asked and apart.rows == together.rows
    assert windows(apart) == windows(together)
    assert apart.stored(0).equals(together.stored(0))
