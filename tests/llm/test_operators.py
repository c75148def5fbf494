"""Operators against brute force and SQL on the smallest tables."""

import html
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from brute import SF_DIR
from termlode.llm import (
    decontaminate,
    fingerprints,
    html_text,
    language,
    licenses,
    line_templates,
    near_dedup,
    token_counts,
)
from termlode.llm.queries import ORACLES, QUERIES
from termlode.sources.store import scratch_path


def by_id(frame, *columns):
    return {row["doc_id"]: tuple(row[c] for c in columns) for row in frame.collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    expected = connection.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    picked = ", ".join(f'"{c}"' for c in result.columns)
    wanted = sorted(map(repr, expected.project(picked).fetchall()))
    assert sorted(repr(tuple(row)) for row in result.collect()) == wanted


# --- licences ---


def test_spelling_and_layout_do_not_matter(spark):
    rows = [
        (1, "Copyright (c) 2020 A. Nobody\n\n" + licenses.KNOWN[0][1].upper().replace(" ", "   ")),
        (2, licenses.KNOWN[0][1].replace("sublicense", "sublicence").replace('"', "“")),
        (3, licenses.KNOWN[0][1] + " unless I say so"),
        (4, "prose\n  released under the M.I.T. license\nReleased  under the MIT Licence!\nprose"),
        (5, "All rights reserved"),
    ]
    found = by_id(
        licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")),
        "license_id",
        "notices",
        "n_notices",
    )
    assert found == {
        1: ("MIT", "", 0),
        2: ("MIT", "", 0),
        3: (None, "", 0),
        4: (None, "MIT", 1),
        5: (None, "", 0),
    }


# --- near duplicates ---


def test_components_equal_brute_force(spark, texts):
    found = by_id(
        near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")),
        "n_shingles",
        "component_id",
    )
    assert found == brute.components(texts)


def test_chains_of_links_are_one_component(spark):
    words = [f"w{i}" for i in range(160)]
    texts = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(15)]
    expected = brute.components(texts)
    assert {c for _, c in expected.values()} == {0}
    found = by_id(
        near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")),
        "n_shingles",
        "component_id",
    )
    assert found == expected


def test_sketches_fill_and_estimate():
    generator = np.random.default_rng(5)
    base = generator.integers(0, 1 << 63, 1000, np.uint64)
    sets = [base[:800], base[200:], base[:1], base[:3], base[:0]]
    table = near_dedup.sketches(sets)
    assert (table[:4] != near_dedup._UNFILLED).all()
    assert (table[4] == near_dedup._UNFILLED).all()
    assert abs((table[0] == table[1]).mean() - 0.6) < 0.15


# --- token files ---


@pytest.mark.parametrize("block_tokens", [1, 2, 3, 7, 1000])
def test_documents_across_blocks(spark, block_tokens):
    end = token_counts.END_ID
    streams = {
        "part-1": [5, 6, end, end, 7, 8, 9, 10, 11, end, 12],
        "part-2": [end],
        "part-3": [1, 2, 3],
        "part-4": [4, end, 5, 5, end],
    }
    blocks = [
        (name, i // block_tokens, bytearray(np.array(ids[i : i + block_tokens], "<u2").tobytes()))
        for name, ids in streams.items()
        for i in range(0, len(ids), block_tokens)
    ]
    frame = spark.createDataFrame(blocks, "file string, block long, ids binary")
    found = sorted(tuple(row) for row in token_counts.count_tokens(frame).collect())
    assert found == [
        ("part-1", 0, 2), ("part-1", 1, 0), ("part-1", 2, 5), ("part-1", 3, 1),
        ("part-2", 0, 0), ("part-3", 0, 3), ("part-4", 0, 1), ("part-4", 1, 2),
    ]


def test_token_counts_equal_the_encoder(spark, documents, texts):
    found = by_id(token_counts.document_token_counts(documents), "n_tokens")
    assert found == {i: (n,) for i, (n, _, _) in brute.encoded(texts).items()}


def test_files_are_flat(spark, documents):
    path = scratch_path(spark, "flat")
    token_counts.write_token_files(documents.coalesce(1), path)
    content = spark.read.format("binaryFile").load(path).first()["content"]
    ids = np.frombuffer(bytes(content), "<u2")
    assert (ids == token_counts.END_ID).sum() == documents.count()
    assert token_counts.read_blocks(spark, path, 1000).count() == -(-len(ids) // 1000)


# --- language ---


def test_phrases_equal_brute_force(texts):
    samples = (language.letters_only(texts[0][1])[:3000], language.letters_only(texts[1][1])[:3000])
    parsed = [language.letters_only(text)[: language.STRETCH] for _, text in texts[:40]]
    found = language.count_phrases(parsed, samples)
    assert found.tolist() == [[brute.phrases(t, s) for s in samples] for t in parsed]


def test_held_out_accuracy(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op4_language_id"](spark, sf_dir).where("held_out")
    right = found.join(docs.select("doc_id", "lang"), "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))
    )
    assert right.first()[0] >= 0.98


def test_no_letters_is_undetermined(spark):
    rows = [(1, "123 !"), (2, None), (3, "the letters of it and the rest")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    found = by_id(language.identify(docs, {"en": b"the letters"}), "lang_pred", "score")
    assert found == {1: ("und", 0.0), 2: ("und", 0.0), 3: ("en", 1.0)}


# --- line templates ---


def test_variable_fields_are_generalised(spark):
    rows = [(i, f"own words of text {i}a\nPage {i} of 9 printed by user{i}\nSeen by Bob in room {i} on day x") for i in range(8)]
    rows += [(20 + i, f"Seen by Bob in the hall on day y{i}z") for i in range(2)]
    rows += [(30, "unlike any other line here\n\n  \nlast")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cleaned = by_id(line_templates.drop_recurring(docs), "kept_text", "n_dropped")
    assert cleaned[30] == ("unlike any other line here\n\n  \nlast", 0)
    assert all(cleaned[i] == ("", 3) for i in range(8))
    keyed = docs.select(F.col("doc_id").alias("rid"), "doc_id", "text")
    found = line_templates.templates(line_templates.lines_of(keyed))
    assert "Page <*> of <*> printed by <*>" in {row["template"] for row in found.collect()}


def test_copies_alone_make_no_template(spark):
    docs = spark.createDataFrame([(i, "the same\ntwo lines") for i in range(9)], "doc_id long, text string")
    assert line_templates.drop_recurring(docs).agg(F.sum("n_dropped")).first()[0] == 0


# --- BPE, repeats, leaks ---


def test_bpe_equals_the_library(spark, texts):
    odd = [(10_001, "a  b  c\n\n x's 'tis ½٣ 漢字 \U0001f600\u0085z\t\tq'll"), (10_002, None)]
    rows = texts + odd
    path = scratch_path(spark, "bpe")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    found = by_id(QUERIES["op6_byte_bpe"](spark, path), "n_tokens", "ids_sha256", "decoded_sha256")
    assert found == brute.encoded(rows)


def test_repeats_equal_brute_force(spark, texts):
    found = by_id(
        QUERIES["op7_substring_dedup"](spark, SF_DIR), "n_words", "n_removed", "kept_sha256"
    )
    assert found == brute.without_repeats(texts)


def test_every_offset_of_a_repeat_is_found(spark):
    shared = [f"s{i}" for i in range(20)]
    texts = [(0, " ".join(shared))]
    texts += [(i, " ".join([f"d{i}x{k}" for k in range(i)] + shared + [f"e{i}"])) for i in range(1, 30)]
    path = scratch_path(spark, "offsets")
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    found = by_id(QUERIES["op7_substring_dedup"](spark, path), "n_words", "n_removed", "kept_sha256")
    assert found == brute.without_repeats(texts)


def test_leaks_equal_brute_force(spark, texts):
    items = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = QUERIES["op10_decontamination"](spark, SF_DIR).collect()
    found = {(row["doc_id"], row["item_id"]) for row in found}
    expected = brute.leaks([t for t in texts if t[0] < 120], items)
    assert found and expected == {pair for pair in found if pair[0] < 120}


def test_altered_and_partial_items(spark):
    item = "The quick brown fox jumps over one lazy dog near a river bank today. It was never seen again."
    rows = [
        (1, "noise " * 90 + item.upper().replace(" ", "\n") + " noise" * 50),
        (2, "noise " * 90 + item.split(".")[0]),
        (3, item.replace("fox", "cat").replace("bank", "side")),
        (4, "the quick and the dead fox, a river, a bank and a lazy dog it was"),
        (5, item),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "quite another text of some words")], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert {(row["doc_id"], row["item_id"]) for row in found} == {(1, 7), (5, 7)} == brute.leaks(rows, [(7, item)])
    assert [row["doc_id"] for row in decontaminate.decontaminate(docs, bench).orderBy("doc_id").collect()] == [2, 3, 4]


def test_words_equal_the_regular_expression(texts):
    some = [text for _, text in texts[:50]] + [None, "", " a\x0b\x0cb\r", "é x y"]
    words = fingerprints.split_words(pa.array(some, pa.string()))
    expected = [brute.WORD.findall(text or "") for text in some]
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == [w for own in expected for w in own]
    assert words.counts.tolist() == [len(own) for own in expected]
    windows = words.windows(20)[words.whole_windows(20)]
    plain = [tuple(own[k : k + 20]) for own in expected for k in range(len(own) - 19)]
    assert len(set(windows.tolist())) == len(set(plain))
    assert len(windows) == len(plain)


# --- pages ---

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
{body}
<div id="cookie-notice">We use cookies</div><footer>&copy; us</footer></body></html>"""


def text_of(body):
    blocks, _ = html_text.blocks_of(PAGE.format(body=body))
    return "\n".join(blocks)


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<article><h1>A &amp; B</h1><p>one<br>two  three<p>f&uuml;r&nbsp;x</article>", "A & B\none two three\nfür x"),
        ("<article><p>a</p><script>var t='</article>'</script><p>b<b>old</article>", "a\nbold"),
        ("<main><div class='sidebar left'>no</div><p title='a>b'>yes</p></main><p>outside</p>", "yes"),
        ("<article>x<section class=comments><article>reader</article></section></article>", "x"),
        ("<article><form><p>name</p></form><p hidden>h</p><p style='display: none'>h</p><p>y</p></article>", "y"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
        ("<article><p>5 < 6 & 7 > 2</p><!-- <p>no</p> --></article>", "5 < 6 & 7 > 2"),
        ("<article><aside><p>no</article>", ""),
    ],
)
def test_marked_articles(body, expected):
    assert text_of(body) == expected


def test_host_repeats_without_markup(spark):
    shared = "Sign here for all of our weekly letters and offers from the whole shop"
    rows = [
        (i, f"https://Site.example/{i}", f"<body><p>{shared}</p><p>own text {i} of a page numbered {i}</p><p>{shared} now {i}</p></body>")
        for i in range(5)
    ] + [(9, "https://other.example/", f"<body><p>{shared}</p></body>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {row["page_id"]: row["text"] for row in html_text.main_text(pages).collect()}
    assert found[9] == shared
    assert found[3] == "own text 3 of a page numbered 3\n3"


def test_pages_table_gives_its_articles(spark):
    rows = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    found = {row["page_id"]: row for row in QUERIES["op8_html_extraction"](spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    for row in rows:
        article = row["html"].partition("<article>")[2].partition("</article>")[0]
        bare = html.unescape(re.sub(r"<[^>]*>", " ", article))
        assert found[row["page_id"]]["text"].split() == bare.split()
        assert found[row["page_id"]]["n_chars"] == len(found[row["page_id"]]["text"])
