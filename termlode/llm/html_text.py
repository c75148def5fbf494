"""Main text of web pages: markup where it speaks, the repeats of a host where it does not.

A page is cut into blocks of text. Scripts, styles, menus, headers, footers, sidebars,
notices, adverts, forms and reader comments are dropped by tag, role or class name. The
repeats of a host are looked for on all of its pages. If the page marks its article, that is
the text, without the runs of tokens that half of the host's pages repeat. On pages that do
not, what is common to a host is told by its repeats alone: runs of tokens that occur on
several pages of the host are boilerplate, and the unique runs stay.

Runs have a fixed length and are counted over the whole host, so a host of any size is many
tasks. What half of the pages have, half of some group of them has: groups of pages sort the
suffixes of their streams, and only what is frequent in one is counted on all pages. Equal
pages are one page, and near-equal ones do not count against each other.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import small_join, stored
from termlode.llm.near_dedup import components
from termlode.operators.skew import join_by_frequency, join_sliced

# A repeated run has at least this many tokens, block ends included, and is found on at
# least two pages of a host.
RUN_TOKENS = 8

# A run of a marked article is the host's if so many of its different pages have it, and
# as large a share of them.
COMMON_PAGES, COMMON_SHARE = 8, 0.5

# Of a marked article, less than a block of RUN_TOKENS goes only if so many tokens on end do.
LONG_RUN_TOKENS = 16

# Different pages of a host whose suffixes are sorted together, in the mean.
GROUP_PAGES = 48

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea|title)(?=[\s/>]).*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAME_WORDS = re.compile(r"[a-z][a-z0-9]*")

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
    "q s samp small span strike strong sub sup time tt u var".split()
)
_DROPPED_TAGS = frozenset(
    "nav header footer aside form menu dialog iframe object svg canvas button select "
    "audio video head".split()
)
_DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu "
    "menubar toolbar".split()
)
_DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar cookie cookies consent gdpr "
    "notice notices banner popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social comment comments commentlist respond disqus discussion related "
    "recommended teaser teasers "
    "footer masthead pagination pager widget search skip".split()
)
# What such a name may be followed by: sidebar-left, comments-area, related-posts.
_NAME_PARTS = frozenset(
    "left right top bottom primary secondary main area bar box list item items wrap wrapper "
    "container section block inner outer panel slot unit group row column links link buttons "
    "button icons form text title posts post articles article stories story content nav menu "
    "toggle modal thread".split()
)
# A name with one of these says how the page is laid out: no-sidebar, has-comments.
_STATE_WORDS = frozenset(
    "no not non without with has have had is hide hides show shows enable enabled disable "
    "disabled open closed layout".split()
)
_DROPPED_WHOLE_NAMES = frozenset("header site-header page-header top-bar topbar".split())
_SINGLE_PARENT = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}


_KEPT, _BY_NAME, _FOR_SURE = 0, 1, 2


def _names_boilerplate(name: str) -> bool:
    """Whether a class or id, as a whole or by its head word, names what is no text."""
    if name in _DROPPED_WHOLE_NAMES:
        return True
    words = _NAME_WORDS.findall(name)
    if not words or _STATE_WORDS.intersection(words):
        return False
    return words[-1] in _DROPPED_NAMES or (
        words[0] in _DROPPED_NAMES and _NAME_PARTS.issuperset(words[1:])
    )


def _dropped(tag: str, attributes: str) -> int:
    if tag in _DROPPED_TAGS:
        return _FOR_SURE
    if not attributes.strip(" /"):
        return _KEPT
    how = _KEPT
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            if any(map(_names_boilerplate, value.split())):
                how = _BY_NAME
        elif name == "role" and value in _DROPPED_ROLES:
            return _FOR_SURE
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return _FOR_SURE
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return _FOR_SURE
    # No name drops a page.
    return _KEPT if tag in ("html", "body") else how


def _is_main(tag: str, attributes: str) -> bool:
    return tag in ("article", "main") or "main" in (
        value.strip("\"'").lower()
        for name, value in _ATTRIBUTE.findall(attributes)
        if name.lower() == "role"
    )


class _Open:
    """Open elements ``(tag, dropped, region)``, the innermost last, counted by name."""

    def __init__(self):
        self.stack: list[tuple[str, int, str]] = []
        self._named: Counter[str] = Counter()

    def cut(self, i: int) -> None:
        """Close an element and all within it."""
        for tag, _, _ in self.stack[i:]:
            self._named[tag] -= 1
        del self.stack[i:]

    def close(self, tag: str) -> None:
        if self._named[tag]:
            self.cut(max(i for i, element in enumerate(self.stack) if element[0] == tag))

    def _close_by_itself(self, tag: str) -> None:
        if tag not in _INLINE and self._named["p"]:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == "p":
                    self.cut(i)
                if i >= len(self.stack) or self.stack[i][0] not in _INLINE:
                    break
        if tag in _SINGLE_PARENT and self._named[tag]:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in _SINGLE_PARENT[tag]:
                    break
                if self.stack[i][0] == tag:
                    self.cut(i)
                    break

    def add(self, tag: str, attributes: str) -> None:
        self._close_by_itself(tag)
        _, dropped, region = self.stack[-1] if self.stack else ("", _KEPT, "")
        own = _dropped(tag, attributes)
        if _is_main(tag, attributes):
            if region != "article" and _BY_NAME in (dropped, own) and own != _FOR_SURE:
                # Told apart: it counts if the page has no other article.
                region, dropped, own = f"named {'article' if tag == 'article' else 'main'}", _KEPT, _KEPT
            elif own != _BY_NAME and region != "article" and (not region or tag == "article"):
                inner = "article" if tag == "article" else "main"
                region = f"named {inner}" if region.startswith("named") else inner
            elif tag != "article":
                own = _KEPT if own == _BY_NAME else own
        if own == _BY_NAME and dropped == _KEPT and region in _MARKED and tag not in _INLINE:
            # Kept aside: it counts if all of the article has such names.
            region = f"aside {region}"
        self.stack.append((tag, max(dropped, own), region))
        self._named[tag] += 1

    def region(self) -> str:
        return self.stack[-1][2] if self.stack else ""

    def drops(self) -> bool:
        """Whether text here is dropped, and not even kept aside."""
        if not self.stack:
            return False
        _, dropped, region = self.stack[-1]
        return dropped == _FOR_SURE or (dropped == _BY_NAME and not region.startswith("aside "))


_MARKED = ("article", "main", "named article", "named main")


def blocks_of(page: str) -> tuple[list[str], bool]:
    """Blocks of text in page order, and whether the page itself marks its article.

    Of any length: tags are looked up by name, so unclosed and unopened ones, however many,
    do not make it slower than in proportion to the page. An empty page has no blocks.
    """
    found: list[tuple[str, str]] = []
    elements = _Open()
    pending: list[str] = []

    def flush() -> None:
        if pending:
            block = " ".join("".join(pending).split())
            pending.clear()
            if block:
                found.append((elements.region(), block))

    def say(raw: str) -> None:
        if raw and not elements.drops():
            pending.append(html.unescape(raw))

    at = 0
    for match in _TAG.finditer(page):
        say(page[at : match.start()])
        at = match.end()
        tag = (match[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            say(" ")
            continue
        if tag not in _INLINE:
            flush()
        if tag in _VOID:
            continue
        if match[2]:
            elements.close(tag)
        elif not match[4].endswith("/") or tag in ("p", "div"):
            elements.add(tag, match[4])
    say(page[at:])
    flush()
    for region in (*_MARKED, *(f"aside {name}" for name in _MARKED)):
        marked = [block for where, block in found if where == region]
        if marked:
            return marked, True
    return [block for _, block in found], False


_BLOCK_END = "\n"


def _tokens(blocks: list[str]) -> list[str]:
    return [token for block in blocks for token in (_BLOCK_END, *block.split(" "))]


_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(RUN_TOKENS)], np.uint64)


def _token_hashes(tokens: list[str]) -> np.ndarray:
    return np.array(
        [int.from_bytes(blake2b(t.encode("utf-8", "replace"), digest_size=8).digest()) for t in tokens],
        np.uint64,
    )


def _windows(own: np.ndarray) -> np.ndarray:
    """Hashes of the runs of tokens with these hashes."""
    if len(own) < RUN_TOKENS:
        return np.zeros(0, np.int64)
    places = np.lib.stride_tricks.sliding_window_view(own, RUN_TOKENS)
    return (places * _POWERS).sum(axis=1, dtype=np.uint64).view(np.int64)


def run_hashes(tokens: list[str]) -> np.ndarray:
    """A 64-bit hash of the run that begins at each token, whole runs only."""
    return _windows(_token_hashes(tokens))


def _covered(tokens: list[str], gone: list[int]) -> np.ndarray:
    """Whether a run of ``gone`` covers each token."""
    begin = np.flatnonzero(np.isin(run_hashes(tokens), np.array(gone, np.int64)))
    edges = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + RUN_TOKENS, -1)
    return np.cumsum(edges)[:-1] > 0


def _stretches(covered: np.ndarray) -> np.ndarray:
    """Rows ``(first, end)`` of what is covered on end."""
    return np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]))).reshape(-1, 2)


def without_runs(blocks: list[str], gone: list[int] | None) -> str:
    """Text of a page without the runs whose hashes are ``gone``.

    Of a block goes what is covered whole, or for ``RUN_TOKENS`` on end; the end of a
    longer run that only reaches into a block leaves it as it is.
    """
    if not gone:
        return _BLOCK_END.join(blocks)
    covered = _covered(_tokens(blocks), gone)
    at, kept = 0, []
    for block in blocks:
        words = block.split(" ")
        own = covered[at + 1 : at + 1 + len(words)]
        at += 1 + len(words)
        left = np.ones(len(words), bool)
        for first, end in _stretches(own):
            left[first:end] = end - first < min(RUN_TOKENS, len(words))
        if left.any():
            kept.append(" ".join(w for w, k in zip(words, left.tolist(), strict=True) if k))
    return _BLOCK_END.join(kept)


def without_common(blocks: list[str], gone: list[int]) -> list[str]:
    """Blocks of a marked article without the runs ``gone``, which its host repeats.

    What the markup keeps is not taken lightly: a block goes if it is covered whole and has
    ``RUN_TOKENS`` tokens, its end included, or stands among ``LONG_RUN_TOKENS`` that are
    covered on end; of others go ``LONG_RUN_TOKENS`` on end. A page of which more than half
    its words would go is a copy of others and stays whole.
    """
    covered = _covered(_tokens(blocks), gone)
    long = np.zeros(len(covered), bool)
    for first, end in _stretches(covered):
        long[first:end] = end - first >= LONG_RUN_TOKENS
    at, total, kept = 0, 0, []
    for block in blocks:
        words = block.split(" ")
        place = slice(at + 1, at + 1 + len(words))
        at += 1 + len(words)
        total += len(words)
        if covered[place].all() and (len(words) + 1 >= RUN_TOKENS or long[place].all()):
            continue
        left = np.ones(len(words), bool)
        for first, end in _stretches(covered[place]):
            left[first:end] = end - first < LONG_RUN_TOKENS
        kept.append([word for word, stays in zip(words, left.tolist(), strict=True) if stays])
    if 2 * sum(map(len, kept)) < total:
        return blocks
    return [" ".join(words) for words in kept if words]


_PARSED = (
    "page_id long, url string, host long, content long, first boolean, "
    "blocks array<string>, marked boolean"
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``first`` is true for the first of the equal pages of a host that this task sees."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        found = [blocks_of(page or "") for page in batch.column("html").to_pylist()]
        texts = [_BLOCK_END.join(blocks).encode("utf-8", "replace") for blocks, _ in found]
        contents = [
            int.from_bytes(blake2b(text, digest_size=8).digest(), signed=True) for text in texts
        ]
        first = []
        for key in zip(batch.column("host").to_pylist(), contents, strict=True):
            first.append(key not in seen)
            seen.add(key)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                batch.column("host"),
                pa.array(contents, pa.int64()),
                pa.array(first, pa.bool_()),
                pa.array([blocks for blocks, _ in found], pa.list_(pa.string())),
                pa.array([marked for _, marked in found], pa.bool_()),
            ],
            ["page_id", "url", "host", "content", "first", "blocks", "marked"],
        )


def _packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The token streams of pages, small enough to be shuffled beside the stored pages."""
    for batch in batches:
        streams = (" ".join(_tokens(blocks)).encode() for blocks in batch.column("blocks").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("host"),
                batch.column("content"),
                pa.array([zlib.compress(stream) for stream in streams], pa.binary()),
            ],
            ["host", "content", "stream"],
        )


class _Streams:
    """Tokens of the different pages of a group, numbered, one stream after the other."""

    def __init__(self, table: pa.Table):
        _, rows = np.unique(table.column("content").to_numpy(), return_index=True)
        packed = table.column("stream").take(pa.array(rows)).to_pylist()
        streams = pa.array([zlib.decompress(stream).decode() for stream in packed], pa.string())
        lists = pc.split_pattern(streams, " ")
        self.pages = len(rows)
        self.counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        self.tokens = coded.indices.to_numpy().astype(np.int64)
        self.names = coded.dictionary
        self.page = np.repeat(np.arange(self.pages), self.counts)

    def starts(self) -> np.ndarray:
        """Places where a whole run begins."""
        ends = np.repeat(np.cumsum(self.counts), self.counts)
        return np.flatnonzero(np.arange(len(self.tokens)) + RUN_TOKENS <= ends)

    def hashes(self) -> np.ndarray:
        return _windows(_token_hashes(self.names.to_pylist())[self.tokens])

    def ranks(self) -> np.ndarray:
        """Ranks of all suffixes of the streams, sorted up to ``RUN_TOKENS`` tokens by doubling."""
        ranks, width = self.tokens, 1
        while width < RUN_TOKENS:
            step = min(width, RUN_TOKENS - width)
            ahead = np.concatenate([ranks[step:] + 1, np.zeros(min(step, len(ranks)), np.int64)])
            pairs = ranks * (len(ranks) + len(self.names) + 1) + ahead
            ranks = np.unique(pairs, return_inverse=True)[1].reshape(-1)
            width += step
        return ranks

    def held_by(self, runs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many pages have each of the runs, which are numbered and begin at ``at``."""
        pairs = np.unique(runs * self.pages + self.page[at])
        return np.bincount(pairs // self.pages)


_FREQUENT = "host long, host_pages long, run long"
_COUNTED = "host long, host_pages long, run long, n long"


def _frequent_runs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Runs that so large a share of the group's pages have as makes them common to the host."""
    host_pages = table.column("host_pages")[0].as_py()
    streams = _Streams(table)
    at = streams.starts()
    ranks = streams.ranks()[at]
    found, where, again = np.unique(ranks, return_index=True, return_inverse=True)
    runs = np.zeros(0, np.int64)
    if len(found):
        share = max(COMMON_SHARE, COMMON_PAGES / host_pages)
        frequent = streams.held_by(again.reshape(-1), at) >= share * streams.pages - 1e-6
        if frequent.any():
            runs = np.unique(streams.hashes()[at[where[frequent]]])
    return pa.table(
        {
            "host": pa.array(np.full(len(runs), key[0].as_py(), np.int64)),
            "host_pages": pa.array(np.full(len(runs), host_pages, np.int64)),
            "run": pa.array(runs),
        }
    )


def _count_runs(key: tuple[pa.Scalar, ...], table: pa.Table, wanted: pa.Table) -> pa.Table:
    """How many pages of the group have each of the wanted runs."""
    runs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if table.num_rows and wanted.num_rows:
        streams = _Streams(table)
        at = streams.starts()
        hashes = streams.hashes()[at] if len(at) else runs
        at = at[np.isin(hashes, wanted.column("run").to_numpy())]
        if len(at):
            runs, again = np.unique(streams.hashes()[at], return_inverse=True)
            n = streams.held_by(again.reshape(-1), at)
    pages = wanted.column("host_pages")[0].as_py() if wanted.num_rows else 0
    return pa.table(
        {
            "host": pa.array(np.full(len(runs), key[0].as_py(), np.int64)),
            "host_pages": pa.array(np.full(len(runs), pages, np.int64)),
            "run": pa.array(runs),
            "n": pa.array(n.astype(np.int64)),
        }
    )


def _without_common_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks, gone = batch.column("blocks").to_pylist(), batch.column("gone").to_pylist()
        texts = [_BLOCK_END.join(without_common(b, g)) for b, g in zip(blocks, gone, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, run, page)``, each run of a page once."""
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part = batch.slice(low, 500)
            found = [np.unique(run_hashes(_tokens(b))) for b in part.column("blocks").to_pylist()]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("host").take(owner),
                    pa.array(np.concatenate(found)),
                    part.column("page").take(owner),
                ],
                ["host", "run", "page"],
            )


def _clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks, gone = batch.column("blocks").to_pylist(), batch.column("gone").to_pylist()
        texts = [without_runs(b, g) for b, g in zip(blocks, gone, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("content"), batch.column("copies"), pa.array(texts, pa.string())],
            ["content", "copies", "text"],
        )


def _met(frame: DataFrame, facts: DataFrame, keys: list[str], spread_by: str, n: str) -> DataFrame:
    """Join with facts that tell in ``n`` how often their key occurs in ``frame``."""
    total, largest = facts.agg(F.sum(n), F.max(n)).first()
    return join_by_frequency(
        frame, facts, keys, spread_by=spread_by, frequency=n, total_rows=total or 0, largest=largest or 0
    )


def _host() -> Column:
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/?#]*)", 1))


def _words_of(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0), lambda n, block: n + F.size(F.split(block, " ")))


def common_runs(pages: DataFrame) -> DataFrame:
    """``(host, gone)`` of parsed pages: hashes of the runs that each host repeats.

    A run of ``RUN_TOKENS`` tokens, block ends included, is one if at least ``COMMON_PAGES``
    and ``COMMON_SHARE`` of the host's different pages have it; equal pages are one page. What
    is not frequent in any group of the pages, by the same share, cannot be, so only the others
    are counted on all pages, and no run is lost. A host has few, by its share no more than
    twice as many as its pages have on average. Hosts without any have no row.
    """
    held = pages.where("first AND size(blocks) > 0")
    hosts = stored(
        held.groupBy("host")
        .agg(F.count_distinct("content").alias("host_pages"))
        .where(F.col("host_pages") >= COMMON_PAGES),
        "hosts",
    )
    slices = F.ceil(F.col("host_pages") / F.lit(GROUP_PAGES)).cast("long")
    packed = held.select("host", "content", "blocks").mapInArrow(
        _packed_rows, "host long, content long, stream binary"
    )
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        small_join(packed, hosts, "host", row_bytes=16)
        .withColumn("slice", F.pmod(F.xxhash64("content"), slices))
        .repartition(tasks, "host", "slice")
    )
    frequent = dealt.groupBy("host", "slice").applyInArrow(_frequent_runs, _FREQUENT).distinct()
    wanted = frequent.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)))
    counted = (
        dealt.groupBy("host", "slice")
        .cogroup(wanted.groupBy("host", "slice"))
        .applyInArrow(_count_runs, _COUNTED)
    )
    return (
        counted.groupBy("host", "host_pages", "run")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= COMMON_PAGES) & (F.col("n") >= COMMON_SHARE * F.col("host_pages")))
        .groupBy("host")
        .agg(F.collect_list("run").alias("gone"))
    )


def without_common_runs(pages: DataFrame, common: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of parsed pages without their host's runs, see :func:`without_common`."""
    own = small_join(
        pages.select("page_id", "url", "host", "blocks"),
        common,
        "host",
        "left",
        row_bytes=8 + 8 * F.size("gone"),
    )
    cut = own.where("gone IS NOT NULL").select("page_id", "url", "blocks", "gone")
    return _whole_text(own.where("gone IS NULL")).unionByName(
        cut.mapInArrow(_without_common_rows, "page_id long, url string, text string")
    )


def _whole_text(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.array_join("blocks", _BLOCK_END).alias("text"))


def near_equal_pages(pages: DataFrame, repeats: DataFrame) -> DataFrame:
    """``(page, group)`` of the pages that are near-equal to another of their host.

    A run on n of a host's N different pages weighs log((N + 1) / n), so what all pages
    have counts for little. Pages are near-equal if the runs of both weigh at least half
    of those of either. Each page is held against the shortest page of each of its runs,
    never against all that share it.
    """
    linked = stored(
        repeats.groupBy("page", "leader").agg(
            F.count(F.lit(1)).alias("c"), F.sum(F.log(F.col("n"))).alias("logs")
        ),
        "linked",
    )
    own = linked.groupBy("page").agg(F.sum("logs").alias("own_logs"))
    weight = F.col("runs") * F.log1p("host_pages") - F.coalesce("own_logs", F.lit(0.0))
    weighed = stored(
        pages.join(own, "page", "left").select("page", "host_pages", weight.alias("weight")), "weighed"
    )
    shared = F.col("c") * F.log1p("host_pages") - F.col("logs")
    likely = stored(
        linked.where("page <> leader")
        .join(weighed, "page")
        .select("page", "leader", "weight", shared.alias("shared"))
        .where(F.col("shared") >= F.col("weight") / 2),
        "likely",
    )
    leaders = stored(
        likely.groupBy("leader")
        .agg(F.count(F.lit(1)).alias("followers"))
        .join(weighed.select(F.col("page").alias("leader"), F.col("weight").alias("w")), "leader"),
        "leaders",
    )
    links = (
        _met(likely, leaders, ["leader"], "page", "followers")
        .where(2 * F.col("shared") >= F.col("weight") + F.col("w") - F.col("shared"))
        .select(F.col("page").alias("a"), F.col("leader").alias("b"))
    )
    return components(links).select(F.col("rid").alias("page"), F.col("component").alias("group"))


def host_unique_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of pages ``(page_id, url, blocks)`` without what their host repeats.

    A run of ``RUN_TOKENS`` tokens goes if it is on two pages of the host that are neither
    equal nor near-equal. The whole host is one: runs are counted by hash in Spark, each
    page content once.
    """
    rows = stored(
        pages.select(
            "*",
            F.xxhash64(_host()).alias("host"),
            F.md5(F.concat_ws("\n", _host(), F.array_join("blocks", "\n"))).alias("content"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    # Numbered by length: the least page of a run is the shortest that has it.
    contents = stored(
        rows.groupBy("content")
        .agg(
            F.first("host").alias("host"),
            F.first("blocks").alias("blocks"),
            F.count(F.lit(1)).alias("copies"),
        )
        .orderBy(_words_of(F.col("blocks")), "content")
        .withColumn("page", F.monotonically_increasing_id()),
        "contents",
    )
    held = stored(
        contents.select("host", "page", "blocks").mapInArrow(
            _run_rows, "host long, run long, page long"
        ),
        "runs",
    )
    counted = stored(
        held.groupBy("host", "run")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("leader"))
        .where("n > 1"),
        "counted",
    )
    repeats = stored(_met(held, counted, ["host", "run"], "page", "n"), "repeats")
    hosts = contents.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    sizes = held.groupBy("page").agg(F.count(F.lit(1)).alias("runs"))
    facts = join_sliced(contents.select("host", "page"), hosts, ["host"], "page").join(sizes, "page")
    groups = stored(near_equal_pages(facts, repeats), "groups")
    grouped = stored(
        repeats.join(groups, "page", "left").withColumn("group", F.coalesce("group", "page")), "grouped"
    )
    apart = (
        grouped.groupBy("host", "run")
        .agg(F.count(F.lit(1)).alias("times"), F.min("group").alias("low"), F.max("group").alias("high"))
        .where("low < high")
        .select("host", "run", "times")
    )
    gone = (
        _met(grouped.select("host", "run", "page"), stored(apart, "apart"), ["host", "run"], "page", "times")
        .groupBy("page")
        .agg(F.collect_list("run").alias("gone"))
    )
    cleaned = stored(
        contents.join(gone, "page", "left")
        .select("content", "copies", "blocks", "gone")
        .mapInArrow(_clean_rows, "content string, copies long, text string"),
        "cleaned",
    )
    found = _met(rows.drop("blocks"), cleaned, ["content"], "row", "copies")
    return found.select("page_id", "url", "text")


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)``, one row per row of ``pages``.

    White space inside a block is one space, blocks are joined by a newline in page
    order, character references are decoded. Null or empty html gives an empty text, a
    null url is a host of its own. Broken markup is read as far as it goes. Equal and
    near-equal pages of a host take nothing from each other. Of a marked article go the runs
    that at least half of the host's pages repeat, see :func:`common_runs`. Other columns are
    ignored; no rows give no rows.
    """
    url = F.col("url").cast("string").alias("url")
    parsed = stored(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"), url, F.col("html").cast("string").alias("html")
        )
        .withColumn("host", F.xxhash64(_host()))
        .mapInArrow(_parse, _PARSED),
        "parsed",
    )
    common = stored(common_runs(parsed), "common")
    marked = parsed.where("marked OR size(blocks) = 0")
    sure = _whole_text(marked) if common.isEmpty() else without_common_runs(marked, common)
    unsure = parsed.where("NOT marked AND size(blocks) > 0").select("page_id", "url", "blocks")
    return sure if unsure.isEmpty() else sure.unionByName(host_unique_text(unsure))
