"""Scores after two words, against plain dictionaries."""

import math
from collections import Counter

import numpy as np
import pytest
from test_language_model import ROWS, SF_DIR, is_held_out, words_of

from termlode.llm import language_model
from termlode.llm.queries import op13_lm_scoring


def expected(rows):
    """The score after two words of each (doc_id, text), by a model of those not held out."""
    single, pair, triple, context = Counter(), Counter(), Counter(), Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            words = [None, *words_of(text)]
            single.update(words[1:])
            pair.update(zip(words, words[1:], strict=False))
            triple.update(zip(words, words[1:], words[2:], strict=False))
            context.update(words[:-1])
    n = sum(single.values())
    one, two = language_model.STRENGTH, language_model.TRIPLE_STRENGTH
    for _, text in rows:
        words, score = [None, *words_of(text)], 0
        for i in range(1, len(words)):
            p = (single[words[i]] + 1) / (n + len(single) + 1)
            p = (pair[words[i - 1], words[i]] + one * p) / (context[words[i - 1]] + one)
            if i > 1:
                p = (triple[tuple(words[i - 2 : i + 1])] + two * p) / (pair[tuple(words[i - 2 : i])] + two)
            score += math.log10(p)
        yield len(words) - 1, score


def check(found, rows):
    want = sorted(((r[0], *e) for r, e in zip(rows, expected(rows), strict=True)), key=repr)
    got = sorted(((r["doc_id"], r["n_tokens"], r["triple_score"]) for r in found.collect()), key=repr)
    assert len(got) == len(want)
    for (doc_id, n, score), (other, m, plain) in zip(got, want, strict=True):
        assert (doc_id, n) == (other, m)
        # A step of the codes for each token: half a one of the triple, half a one of each pair.
        assert abs(score - plain) <= 1.5 * n / language_model.STEPS + 1e-9


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = op13_lm_scoring(spark, SF_DIR)
    check(found, rows)
    held_out = found.where("held_out").collect()
    assert sum(r["triple_score"] for r in held_out) > sum(r["score"] for r in held_out)


@pytest.mark.parametrize("slice_rows", [1, 3, 1_000_000])
def test_pairs_dealt_over_shards(spark, monkeypatch, slice_rows):
    rows = ROWS + [(20 + i, f"the of {'xyzuvw'[i % 6]} the of a b {i % 4} c the of") for i in range(40)]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, entry int")
    monkeypatch.setattr(language_model, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(language_model, "SHARD_BYTES", 100)
    check(language_model.learn_and_score(docs.repartition(3), block_bytes=60), rows)


def test_a_stored_model_scores_the_same(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SLICE_ROWS", 3)
    rows = [row for row in ROWS if row[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = language_model.learn(docs.where(~language_model.held_out()))
    check(language_model.score(docs, model), rows)


def test_guests_of_other_shards_hold_no_pairs():
    text = language_model._Text.__new__(language_model._Text)
    # One text: 0 1 0 1 ... each time followed by another word; 30 is the end.
    place = np.array([x for i in range(28) for x in (0, 1, 2 + i)])
    text.words, text.learn, text._place = 31, np.array([True]), place
    text.counts = np.array([len(place) + 1])
    text._end = text.counts - 1
    known = language_model._Known(np.arange(2, 34), np.full(32, 28))
    known.id[-1] = language_model.BEGIN
    grams = language_model._distinct_grams(text, known, 7, 2)
    both = (grams.context == known.id[0]) & (grams.second == known.id[1])
    assert both.sum() == len(set(grams.shard[both])) > 1
    assert sorted(grams.often[both])[-2:] == [0, 28]
    assert grams.followers[both].sum() == 28
    assert (np.diff(grams.shard) >= 0).all() and grams.followers.sum() == len(grams.next)


def test_order_of_rows_that_do_not_fit_a_number():
    columns = [np.array([5, 1, 1, 5]), np.array([1 << 40, 3, 1 << 40, 0]), np.array([0, 1 << 40, 2, 9])]
    assert language_model._order(*columns).tolist() == [1, 2, 3, 0]
    assert language_model._order(*(np.minimum(c, 10) for c in columns)).tolist() == [1, 2, 3, 0]
