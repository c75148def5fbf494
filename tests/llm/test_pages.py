"""Pages whose markup misleads, and the repeats of whole hosts against brute force."""

import random
import time
from collections import defaultdict

import pytest

from termlode.llm import html_text

SCHEMA = "page_id long, url string, html string"
TEXT = "the whole text"


@pytest.mark.parametrize(
    "body",
    [
        "<body class='single no-sidebar'><article>{}</article></body>",
        "<body class='sidebar'><article>{}</article></body>",
        "<article class='post has-comments'>{}</article>",
        "<main id='search'>{}</main>",
        "<div id='content' class='with-sidebar'><article>{}</article></div>",
        "<div class='page-with-sidebar comments-open'>{}</div>",
        "<div class='widget'><article>{}</article></div>",
        "<div class='sidebar'><main><p>{}</p><div class='site-footer'>no</div></main></div>",
        "<article>{}</article><div class='comments'><article>reader</article></div>",
        "<article>{}<div class='sidebar-left'>no</div><p class='main-menu ad-slot'>no</p></article>",
        "<div>{}</div><div id='related-posts'>no</div>",
    ],
)
def test_class_words_leave_the_article(body):
    assert html_text.blocks_of(body.format(TEXT))[0] == [TEXT]


def texts_of(spark, rows):
    found = html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["page_id"] for r in found) == sorted(r[0] for r in rows)
    return {r["page_id"]: r["text"] for r in found}


def words(kind, n=12):
    return " ".join(f"{kind}w{i}" for i in range(n))


def page(i, *blocks, host="big.example", to=None):
    return (i, f"http://{host}/{i if to is None else to}", "".join(f"<p>{b}</p>" for b in blocks))


def test_what_two_of_many_pages_share_goes(spark):
    rows = [page(i, words(f"own{i}x"), words(f"pair{i % 1050}x")) for i in range(2100)]
    assert texts_of(spark, rows) == {i: words(f"own{i}x") for i in range(2100)}


def test_copies_keep_their_article(spark):
    menu, article = words("menu"), words("article", 60)
    rows = [page(i, menu, words(f"own{i}x")) for i in range(20)]
    rows += [page(30, menu, article), page(31, menu, article), page(31, menu, article, to=31)]
    rows += [page(40, menu, words("b", 60), words("note")), page(41, words("b", 60))]
    found = html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    text = {r["page_id"]: r["text"] for r in found}
    assert text[3] == words("own3x")
    assert [r["text"] for r in found if r["page_id"] == 31] == [article] * 2
    assert text[30] == article
    assert text[40] == words("b", 60) + "\n" + words("note")
    assert text[41] == words("b", 60)


def test_host_repeats_equal_brute_force(spark):
    dice = random.Random(3)
    rows = []
    for i in range(120):
        blocks = [
            " ".join(dice.choice("abc") for _ in range(dice.randint(1, 14)))
            for _ in range(dice.randint(1, 5))
        ]
        rows.append(page(i, *blocks, *(words(f"own{i}b{b}x", 40) for b in range(3)), host=f"h{i % 3}"))
    where = defaultdict(set)
    streams = {}
    for i, url, markup in rows:
        tokens = [t for b in html_text.blocks_of(markup)[0] for t in ("\n", *b.split(" "))]
        streams[i] = tokens
        for at in range(len(tokens) - html_text.RUN_TOKENS + 1):
            where[url.split("/")[2], *tokens[at : at + html_text.RUN_TOKENS]].add(i)
    expected = {}
    for i, url, _ in rows:
        tokens, covered = streams[i], set()
        for at in range(len(tokens) - html_text.RUN_TOKENS + 1):
            if len(where[url.split("/")[2], *tokens[at : at + html_text.RUN_TOKENS]]) > 1:
                covered.update(range(at, at + html_text.RUN_TOKENS))
        kept, at = [], 0
        while at < len(tokens):
            end = at + 1
            while end < len(tokens) and tokens[end] != "\n":
                end += 1
            size, left, run = end - at - 1, [], []
            for k in [*range(at + 1, end), None]:
                if k in covered:
                    run.append(tokens[k])
                    continue
                if len(run) < min(html_text.RUN_TOKENS, size):
                    left += run
                run = []
                left += [] if k is None else [tokens[k]]
            kept += [" ".join(left)] if left else []
            at = end
        expected[i] = "\n".join(kept)
    assert any(len(" ".join(streams[i]).split()) > len(expected[i].split()) for i in expected)
    assert texts_of(spark, rows) == expected


def text_of(page):
    return "\n".join(html_text.blocks_of(page)[0])


def test_comments_and_other_articles_in_and_beside_the_article():
    assert text_of('<article><p>A</p><article class="comment"><p>C</p></article><p>B</p></article>') == "A\nB"
    for name in ("related-post", "teaser", "teaser-card teaser", "comment"):
        page = f'<article><p>A</p></article><article class="{name}"><p>T</p></article>'
        assert text_of(page) == "A", name
        assert text_of(f'<article class="{name}"><p>T</p></article>') == "T", name
    for attribute in ('id="discussion"', 'class="sponsored-content"', 'class="discussion-thread"'):
        assert text_of(f"<article><p>A</p><div {attribute}>X</div><p>B</p></article>") == "A\nB"
    for name in ("post has-comments", "entry", "post comment-status-open"):
        assert text_of(f'<article class="{name}"><p>A</p></article>') == "A"


def test_names_never_empty_an_article():
    assert text_of('<article><section class="content comment"><p>Z</p></section></article>') == "Z"
    assert text_of('<main class="content sidebar"><p>Z</p></main>') == "Z"
    assert text_of('<article><nav>x</nav></article>') == ""


def test_tags_that_begin_like_others():
    assert text_of("<p>Before</p><title-card>Hello</title-card><p>After</p>") == "Before\nHello\nAfter"
    assert text_of("<p>Before</p><script-x>a</script-x><p>After</p>") == "Before\na\nAfter"
    assert text_of("<title>T</title><p>A</p><script>x</script >B") == "A\nB"


def test_deep_and_broken_pages_take_time_in_proportion():
    def seconds(n):
        page = "<div>" * n + "</x>" * n + "<b>" * n + "<p>" * n + "<li>" * n + "x"
        begin = time.process_time()
        assert text_of(page) == "x"
        return time.process_time() - begin

    seconds(2000)
    assert seconds(40000) < 60 * max(seconds(2000), 0.005)
