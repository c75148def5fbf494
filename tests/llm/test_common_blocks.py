"""What the pages of a host repeat inside their marked articles."""

from termlode.llm import html_text

SCHEMA = "page_id long, url string, html string"
NOTICE = "Sign up here for the weekly letter of the house"


def own(i, n=30):
    return " ".join(f"own{i}w{k}" for k in range(n))


def page(i, *blocks, host="one.example"):
    blocks = "".join(f"<p>{block}</p>" for block in blocks)
    return (i, f"http://{host}/{i}", f"<nav>Home</nav><article>{blocks}</article>")


def texts_of(spark, rows):
    found = html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["page_id"] for r in found) == sorted(r[0] for r in rows)
    return {r["page_id"]: r["text"] for r in found}


def test_a_block_that_half_of_the_host_repeats_goes_from_marked_articles(spark):
    rows = [page(i, own(i), NOTICE, own(-i - 1)) for i in range(10)]
    rows += [page(i, own(i), "short line of all", f"told by {i} {NOTICE}") for i in range(10, 20)]
    rows += [page(i, own(i), NOTICE, host="few.example") for i in range(20, 27)]
    found = texts_of(spark, rows)
    for i, text in found.items():
        if i < 10:
            assert text == f"{own(i)}\n{own(-i - 1)}"
        elif i < 20:
            assert text == f"{own(i)}\nshort line of all\ntold by {i} {NOTICE}"
        else:
            assert text == f"{own(i)}\n{NOTICE}"


def test_a_block_of_less_than_half_stays_and_equal_pages_count_once(spark):
    rows = [page(i, own(i), NOTICE) for i in range(9)] + [page(i, own(i)) for i in range(9, 19)]
    # Forty copies of one page with the notice are one page with it: 10 of 20.
    less = texts_of(spark, rows)
    assert all(less[i] == f"{own(i)}\n{NOTICE}" for i in range(9))
    copies = [(100 + i, "http://one.example/copy", page(0, own("c"), NOTICE)[2]) for i in range(40)]
    half = texts_of(spark, rows + copies)
    assert all(half[i] == own(i) for i in range(9))
    assert all(half[i] == own("c") for i in range(100, 140))
    others = [(100 + i, "http://one.example/copy", page(0, own("c"))[2]) for i in range(40)]
    assert texts_of(spark, rows + others)[0] == f"{own(0)}\n{NOTICE}"


def test_near_copies_stay_whole(spark):
    shared = [own(f"s{k}") for k in range(4)]
    rows = [page(i, *shared, own(i)) for i in range(12)]
    assert texts_of(spark, rows) == {i: "\n".join([*shared, own(i)]) for i in range(12)}


def test_null_urls_and_empty_pages(spark):
    rows = [(i, None, page(i, own(i), NOTICE)[2]) for i in range(8)]
    rows += [(8, None, None), (9, "http://one.example/", ""), (10, None, "<nav>Home</nav>")]
    found = texts_of(spark, rows)
    assert [found[i] for i in (0, 7, 8, 9, 10)] == [own(0), own(7), "", "", ""]
