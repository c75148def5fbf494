"""Labels and texts that are hard to learn from."""

import math
import random
import re
import struct
import unicodedata
import zlib

import pytest
import xxhash

from termlode.llm import language
from termlode.llm.queries import op4_language_id

SCHEMA = "doc_id long, lang string, text string"


def prose(letters, seed, n=300):
    dice = random.Random(seed)
    words = ["".join(dice.choice(letters) for _ in range(4)) for _ in range(20)]
    return " ".join(dice.choice(words) for _ in range(n))


def table(spark, extra, n=40):
    rows = [(i, "en" if i % 2 else "fr", prose("abcde" if i % 2 else "fghij", i % 2)) for i in range(n)]
    return spark.createDataFrame([*rows, *extra], SCHEMA), {i: lang for i, lang, _ in rows}


def learned(label, text, n=20):
    """Enough rows that some are not held out."""
    return [(1000 + i, label, text) for i in range(n)]


def test_label_whose_rows_begin_without_letters(spark):
    docs, wanted = table(spark, learned("odd", "1 " * 3000 + "xyzzy quux " * 30))
    model = language.training_sample(docs)
    assert model["odd"].startswith(b"xyzzy quux")
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert all(found[i] == lang for i, lang in wanted.items())
    assert found[1000] == "odd"


def test_label_of_two_bytes_wins_nothing_else(spark):
    docs, wanted = table(spark, learned("xx", "ab", 1) + learned("xx", "ab", 1))
    model = language.training_sample(docs) | {"xx": b"ab"}
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert all(found[i] == lang for i, lang in wanted.items())


def test_numerals_are_no_letters():
    assert [language.letters_only(t) for t in ("½", "² Ⅷ ①", "a½b", "é一")] == [
        b"",
        b"",
        b"a b",
        "é一".encode(),
    ]
    model = {"a": b"abc", "b": b"def"}
    assert language.predict(["½ Ⅷ", "abc"], model) == [("und", 0.0), language.predict(["abc"], model)[0]]


def test_more_languages_than_one_table_holds(spark):
    rows = [
        (100 * k + i, f"l{k:02}", " ".join(prose("abcdefghijklmnopqrstuvwxyz", k, 60).split()))
        for k in range(70)
        for i in range(4)
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language.training_sample(docs)
    assert len(model) == 70
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert all(found[i] == lang for i, lang, _ in rows)


def expected_predictions(rows):
    """All steps of the query in plain Python: held-out rule, sample, phrases, choice."""
    learn = [
        (lang, xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42), text)
        for i, text, lang in rows
        if zlib.crc32(str(i).encode()) % 5 and lang is not None and re.search(r"[^\W\d_]", text or "")
    ]
    model = {}
    for name in sorted({lang for lang, _, _ in learn}):
        own = sorted((h - (1 << 64) if h >> 63 else h, text) for lang, h, text in learn if lang == name)
        parts = []
        for _, text in own[: language.SAMPLE_ROWS]:
            first = next(i for i, c in enumerate(text) if unicodedata.category(c)[0] == "L")
            parts.append(letters(text[first:][: language.ROW_BYTES]))
        model[name] = b" ".join(parts)[: language.LANGUAGE_BYTES]
    for i, text, _ in rows:
        own = letters(text)
        held_out = zlib.crc32(str(i).encode()) % 5 == 0
        if not own:
            yield i, held_out, "und", 0.0
            continue
        bits = sorted(
            (stretches(own, sample) * math.log2(max(len(sample), language.LEAST_BYTES) + 1), name)
            for name, sample in model.items()
        )
        yield i, held_out, bits[0][1], 1 - bits[0][0] / bits[1][0]


def letters(text):
    """Letters in lower case, each run of anything else one blank."""
    kept = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text or "")
    return " ".join(kept.split()).lower().encode()


def stretches(text, sample):
    """Greedy longest matches in the sample; a phrase ends with its stretch, and a symbol
    that the sample lacks is a phrase of its own."""
    phrases = 0
    for at in range(0, len(text), language.STRETCH):
        stretch = text[at : at + language.STRETCH]
        i = 0
        while i < len(stretch):
            end, found = i + 1, sample.find(stretch[i : i + 1])
            while 0 <= found and end < len(stretch):
                longer = sample.find(stretch[i : end + 1], found)
                if longer < 0:
                    break
                end, found = end + 1, longer
            phrases += 1
            i = end
    return phrases


def test_whole_query_against_plain_python(spark):
    table_of = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table_of.collect()]
    wanted = {i: row for i, *row in expected_predictions(rows)}
    found = op4_language_id(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(rows)
    for row in found:
        held_out, name, score = wanted[row["doc_id"]]
        assert (row["held_out"], row["lang_pred"]) == (held_out, name)
        assert row["score"] == pytest.approx(score, abs=1e-12)
