"""Runs inside and across the blocks of marked articles that the pages of a host repeat."""

import random
from collections import defaultdict

from termlode.llm import html_text

SCHEMA = "page_id long, url string, html string"


def words(kind, n):
    return " ".join(f"{kind}w{k}" for k in range(n))


def page(i, *blocks, host="one.example"):
    return (i, f"http://{host}/{i}", "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>")


def parsed_of(spark, rows):
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("host", html_text.F.xxhash64(html_text._host()))
    return pages.mapInArrow(html_text._parse, html_text._PARSED)


def texts_of(spark, rows):
    found = html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["page_id"] for r in found) == sorted(r[0] for r in rows)
    return {r["page_id"]: r["text"] for r in found}


def test_long_runs_go_from_within_blocks_and_menus_of_short_blocks_go(spark):
    tail, menu = words("tail", 18), [f"item {k}" for k in range(9)]
    rows = [page(i, f"{words(f'own{i}x', 25)} {tail}", words(f"more{i}x", 30)) for i in range(12)]
    rows += [page(100 + i, words(f"o{i}x", 40), *menu, words(f"m{i}x", 30), host="b.example") for i in range(10)]
    rows += [page(200 + i, words(f"p{i}x", 40), tail, host="c.example") for i in range(7)]
    found = texts_of(spark, rows)
    for i in range(12):
        assert found[i] == f"{words(f'own{i}x', 25)}\n{words(f'more{i}x', 30)}"
    for i in range(10):
        assert found[100 + i] == f"{words(f'o{i}x', 40)}\n{words(f'm{i}x', 30)}"
    for i in range(7):
        assert found[200 + i] == f"{words(f'p{i}x', 40)}\n{tail}"


def test_common_runs_of_many_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(html_text, "GROUP_PAGES", 5)
    dice = random.Random(5)
    rows = []
    for i in range(90):
        blocks = [words("abcd"[dice.randint(0, 3)], dice.randint(7, 14)) for _ in range(dice.randint(2, 5))]
        rows.append(page(i, *blocks, words(f"own{i}x", 20), host=f"h{i % 2}"))
    rows += [(200 + i, *rows[i][1:]) for i in range(30)]
    pages = defaultdict(set)
    for i, url, markup in rows:
        pages[url.split("/")[2]].add(tuple(html_text._tokens(html_text.blocks_of(markup)[0])))
    expected = {}
    for host, streams in pages.items():
        held = defaultdict(set)
        for tokens in streams:
            for at in range(len(tokens) - html_text.RUN_TOKENS + 1):
                held[tokens[at : at + html_text.RUN_TOKENS]].add(tokens)
        least = max(html_text.COMMON_PAGES, html_text.COMMON_SHARE * len(streams))
        runs = [list(run) for run, having in held.items() if len(having) >= least]
        expected[host] = {int(html_text.run_hashes(run)[0]) for run in runs}
    assert all(expected.values())
    found = html_text.common_runs(parsed_of(spark, rows)).collect()
    hosts = {spark.sql(f"SELECT xxhash64('{h}') AS h").first()["h"]: h for h in expected}
    assert {hosts[r["host"]]: set(r["gone"]) for r in found} == expected
