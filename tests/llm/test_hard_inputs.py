"""Inputs made against a hash, a character table and a parse tree."""

import hashlib
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

from termlode.llm import bpe, line_templates, near_dedup, substrings
from termlode.llm.fingerprints import split_words


def thue_morse(n, swap=False):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


def test_words_that_cancel_out_in_polynomials_differ(spark):
    a, b = thue_morse(1024), thue_morse(1024, True)
    words = split_words(pa.array([f"{a} {b} {a}"]))
    for kind in (0, 1):
        hashes = words.hashes(kind)
        assert hashes[0] == hashes[2] != hashes[1]
    docs = spark.createDataFrame([(1, " ".join([a] * 20)), (2, " ".join([b] * 20 + ["x"]))], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substrings.drop_repeats(docs).collect()} == {1: 0, 2: 0}
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_equal_words_have_equal_hashes_wherever_they_stand():
    texts = ["abc x", None, "  x abc", "éé abc", "", "x"]
    words = split_words(pa.array(texts))
    names = [w for t in texts for w in (t or "").split()]
    for kind in (0, 1):
        by_name = {}
        for name, value in zip(names, words.hashes(kind).tolist(), strict=True):
            assert by_name.setdefault(name, value) == value
        assert len(set(by_name.values())) == len(by_name) == 3
    assert len(split_words(pa.array([None, ""])).hashes()) == 0 and np.diff(words.first).tolist() == [2, 0, 2, 2, 0, 1]


def test_characters_of_every_age_are_cut_as_the_library_does(spark):
    ranks = bpe.tokens_of(bpe.read_ranks())
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    letters = [
        chr(c) for c in range(0x32000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] in "LNM"
    ]
    texts = ["ࡰ's house", "ᲊ's", "Ɤ's \U0001e4d0's \U00011f02's"]
    texts += [" ".join(f"{c}'s 1{c}" for c in letters[low : low + 40]) for low in range(0, len(letters), 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in bpe.round_trip(docs).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_only_links_leave_the_join_of_a_bucket(spark):
    """Texts that share a core are candidates of each other, at 0.724 unless the own part is short."""
    core = " ".join(f"c{i}" for i in range(88))
    own = [6 if i < 4 else 16 for i in range(40)]
    texts = [" ".join([core, *(f"d{i}x{k}" for k in range(n))]) for i, n in enumerate(own)]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "rid long, doc_id long, text string")
    known = near_dedup.sketch_documents(rows)
    sets = rows.select("rid", "text").mapInArrow(near_dedup._set_batches, near_dedup.SETS)
    torn = known.select(F.explode("bands").alias("bucket"), "rid", F.col("rid").alias("component"))
    found = {(r["a"], r["b"]) for r in near_dedup._links_across(torn, sets, known).collect()}
    assert found == {
        (a, b) for a in range(40) for b in range(a) if 100 * 84 >= 75 * (84 + own[a] + own[b])
    }


def test_no_link_is_lost_where_short_hashes_fall_together(spark):
    one, other = [k << 32 | 5 for k in range(100)], [k << 32 | 5 for k in range(10, 110)]
    sets = spark.createDataFrame([(1, one), (2, other), (3, [k << 32 | k for k in range(100)])], near_dedup.SETS)
    known = spark.createDataFrame([(i, 100, [7]) for i in (1, 2, 3)], "rid long, n_shingles long, bands array<long>")
    torn = spark.createDataFrame([(7, i, i) for i in (1, 2, 3)], "bucket long, rid long, component long")
    assert [tuple(r) for r in near_dedup._links_across(torn, sets, known).collect()] == [(2, 1)]


def test_near_duplicates_take_small_batches_and_leave_the_session_as_it_was(spark, monkeypatch):
    name, asked, stored = "spark.sql.execution.arrow.maxRecordsPerBatch", set(), near_dedup.stored
    before = spark.conf.get(name)

    def noted(frame, path):
        asked.add(int(spark.conf.get(name)))
        return stored(frame, path)

    monkeypatch.setattr(near_dedup, "stored", noted)
    docs = spark.createDataFrame([(i, f"a b c d e f g {i % 3}") for i in range(6)], "doc_id long, text string")
    assert near_dedup.near_duplicates(docs).where("kept").count() == 3
    assert asked == {1000} and spark.conf.get(name) == before


CITIES = ["Paris", "Rome", "Oslo", "Bern", "Riga", "Lima", "Cairo"]


def dropped(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_recurring(docs).collect()}


def test_a_leaf_has_several_templates(spark):
    offices = [f"Click here to visit our {city} office\nown text {city} of {i * 'x'}" for i, city in enumerate(CITIES)]
    stories = [f"Click here to read the full story\nother words {'y' * i} here" for i in range(9)]
    assert list(dropped(spark, offices).values()) == [1] * 7
    assert set(dropped(spark, offices + stories).values()) == {1}
    few = offices[:5] + stories
    assert dropped(spark, few) == dict(enumerate([0] * 5 + [1] * 9))
    # Copies of a document count once, also within such a template.
    assert set(dropped(spark, offices[:5] + offices[:5]).values()) == {0}


def test_one_common_line_takes_those_along_that_differ_in_a_word(spark):
    texts = [f"a b c d e f g h\n{'z' * i} unlike" for i in range(8)] + ["a b c d e f g X\nanother one"]
    assert set(dropped(spark, texts).values()) == {1}


def test_lines_of_rare_leaves_meet_nothing_and_places_hold_no_text(spark, monkeypatch):
    offices = [f"Click here to visit our {city} office" for city in CITIES]
    names = ["".join(chr(97 + int(digit)) for digit in str(i)) for i in range(60)]
    rare = [f"own{name} words of{name} this one" for name in names]
    texts = [f"{o}\n{o} today" for o in offices] + rare
    kept, stored = {}, line_templates.stored
    monkeypatch.setattr(line_templates, "stored", lambda frame, name: kept.setdefault(name, stored(frame, name)))
    assert dropped(spark, texts) == dict(enumerate([2] * 7 + [0] * 60))
    assert kept["recurring"].count() == 14 < kept["held"].count()
    assert "string" not in kept["places"].schema.simpleString()
