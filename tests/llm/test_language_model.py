"""The n-gram model against plain dictionaries, and its sequences against numpy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termlode.llm import language_model
from termlode.llm.blocks import expand, squeeze
from termlode.llm.elias_fano import EliasFano, Trie
from termlode.llm.queries import op13_lm_scoring

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def expected(rows):
    """(held_out, n_tokens, n_known, train_tokens, base, score) of each (doc_id, text)."""
    single, pair, context = Counter(), Counter(), Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            words = words_of(text)
            single.update(words)
            pair.update(zip([None, *words], words, strict=False))
            context.update([None, *words[:-1]])
    n, strength = sum(single.values()), language_model.STRENGTH
    for doc_id, text in rows:
        words = words_of(text)
        alone = [(single[w] + 1) / (n + len(single) + 1) for w in words]
        score = sum(
            math.log10((pair[v, w] + strength * p) / (context[v] + strength))
            for v, w, p in zip([None, *words], words, alone, strict=False)
        )
        yield (
            is_held_out(doc_id), len(words), sum(single[w] > 0 for w in words), n,
            sum(map(math.log10, alone)), score,
        )


def check(found, rows):
    want = sorted(zip([r[0] for r in rows], expected(rows), strict=True), key=repr)
    got = sorted(
        ((row["doc_id"], (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"],
                          row["base_score"], row["score"])) for row in found.collect()), key=repr)
    assert len(got) == len(want)
    for (a, (*x, base, score)), (b, (*y, base2, score2)) in zip(got, want, strict=True):
        assert (a, x) == (b, y)
        assert base == pytest.approx(base2, rel=1e-9)
        # Half a step of the codes for each token.
        assert abs(score - score2) <= x[1] / language_model.STEPS / 2 + 1e-9


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    check(op13_lm_scoring(spark, SF_DIR), rows)


def test_it_predicts_held_out_text_better_than_words_alone(spark):
    found = op13_lm_scoring(spark, SF_DIR).where("held_out").collect()
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)


ROWS = [
    (1, "A b a B"), (2, None), (3, ""), (None, "a b c"), (None, None), (5, "  a\tb\n\n x y "), (5, "a b"),
    (7, "É é ſ \x00 ''"), (8, "w " * 5000), (9, "a"), (10, "b a " * 30), (11, "zz zz"), (12, "q a b"), (13, "a b"),
]


def test_odd_rows_small_blocks_and_sliced_contexts(spark, monkeypatch):
    schema = "doc_id long, text string, block int, learn int, word int, id int"
    docs = spark.createDataFrame([(*row, 1, 1, 1, 1) for row in ROWS], schema)
    check(language_model.learn_and_score(docs), ROWS)
    monkeypatch.setattr(language_model, "SLICE_ROWS", 3)
    monkeypatch.setattr(language_model, "SHARD_BYTES", 200)
    check(language_model.learn_and_score(docs.repartition(3), block_bytes=12), ROWS)
    assert language_model.learn_and_score(docs.limit(0)).count() == 0
    only_held_out = [row for row in ROWS if is_held_out(row[0])] or [(2, "a")]
    check(language_model.learn_and_score(spark.createDataFrame(only_held_out, "doc_id long, text string")), only_held_out)


def test_a_stored_model_scores_other_texts(spark):
    docs = spark.createDataFrame([(1, "a b c a b"), (2, "a b")], "doc_id long, text string")
    model = language_model.learn(docs)
    found = {r["doc_id"]: r for r in language_model.score(
        spark.createDataFrame([(1, "a b"), (2, "b a"), (3, "d d")], "doc_id long, text string"), model).collect()}
    assert found[1]["score"] > found[2]["score"] > found[3]["score"]
    assert [found[i]["n_known"] for i in (1, 2, 3)] == [3, 3, 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**7), max_size=300), st.lists(st.integers(0, 2 * 10**7), max_size=50))
def test_sequences(values, asked):
    values, asked = np.sort(np.array(values, np.int64)), np.array(asked, np.int64)
    sequence = EliasFano.of(values)
    assert (sequence.get(np.arange(len(values))) == values).all()
    assert (sequence.successor(asked) == np.searchsorted(values, asked, "left")).all()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 40), st.integers(0, 9)), max_size=80))
def test_trie(pairs):
    pairs = sorted(pairs)
    context, word = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    trie = Trie.view(Trie.build(context, word, np.arange(len(pairs)).astype("<u2")).to_bytes())
    every = [(c, w) for c in range(42) for w in range(11)]
    found = trie.codes(*(np.array([p[i] for p in every], np.int64) for i in (0, 1)), 999)
    assert found.tolist() == [pairs.index(p) if p in pairs else 999 for p in every]


@given(st.lists(st.lists(st.integers(0, 2**40)), max_size=4))
def test_squeeze(lists):
    arrays = [np.array(x, np.int64) for x in lists]
    assert [a.tolist() for a in expand(squeeze(*arrays))] == lists
