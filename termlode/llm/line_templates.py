"""Lines that recur across documents as one template, in built-in functions only.

A parse tree of fixed depth: the number of tokens, then the leading tokens, variable ones
(those with a digit) as a wildcard, lead to a leaf. Of the distinct lines of a leaf the one
in most documents is the seed of a template; lines of which enough tokens are equal at their
places belong to it, and places where members differ are its variable fields. Any other
line is a template of its own. A leaf has more templates than that of its seed: lines of it
that differ in one token alone are members of a template with that field. A template that
recurs in enough documents is dropped from them. Documents with equal texts count once, so
copies alone make no template.

Lines travel as two hashes; the text of a line is fetched only in leaves that enough
documents reach, and lines of other leaves meet nothing further. Equal lines are counted
together before anything is joined, so a line that every document has is one row per task
in a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import keyed, small_join, stored
from termlode.operators.skew import join_by_frequency

LEADING_TOKENS = 3
SIMILAR_PERCENT = 70
LEAST_DOCUMENTS = 6
WILDCARD = "<*>"
_WHITE = r"[\x20\t\x0B\f\r]+"


def masked(line: Column) -> Column:
    """Tokens of a line joined by single blanks, those with a digit as a wildcard."""
    tokens = F.split(F.btrim(line, F.lit(" \t\x0b\f\r")), _WHITE)
    return F.array_join(
        F.transform(tokens, lambda t: F.when(t.rlike(r"\p{N}"), F.lit(WILDCARD)).otherwise(t)), " "
    )


def lines_of(rows: DataFrame) -> DataFrame:
    """``(rid, doc, line_no, line, key, leaf)`` of the lines that have a token."""
    lines = rows.select(
        "rid",
        F.xxhash64("text").alias("doc"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "raw"),
    ).where(F.col("raw").rlike(r"[^\x20\t\x0B\f\r]"))
    tokens = F.split("line", " ")
    leading = F.array_join(F.slice(tokens, 1, LEADING_TOKENS), " ")
    return lines.select("rid", "doc", "line_no", masked(F.col("raw")).alias("line")).select(
        "*",
        _key("line").alias("key"),
        F.xxhash64(F.size(tokens), leading).alias("leaf"),
    )


def _equal_places(line: str, seed: str) -> Column:
    return F.zip_with(F.split(line, " "), F.split(seed, " "), lambda a, b: a == b)


def _key(line: str | Column) -> Column:
    """The two hashes by which a line is known."""
    return F.struct(F.xxhash64(line), F.xxhash64(F.reverse(line)))


def templates(lines: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(key, template, documents)`` of every distinct line of a recurring template.

    A line that belongs to several templates has a row for each.
    """
    held = stored(
        lines.groupBy("key", "leaf", "doc").agg(F.count(F.lit(1)).alias("n")).drop("n"), "held"
    )
    leaves = stored(
        held.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") >= least_documents
        ),
        "leaves",
    )
    held = stored(small_join(held, leaves.select("leaf"), "leaf", "left_semi"), "recurring")
    texts = (
        small_join(lines.select("key", "leaf", "line"), leaves.select("leaf"), "leaf", "left_semi")
        .groupBy("key", "leaf")
        .agg(F.first("line").alias("line"))
    )
    counts = held.groupBy("key").agg(F.count(F.lit(1)).alias("documents"))
    known = stored(texts.join(counts, "key"), "lines")
    seeds = stored(
        known.groupBy("leaf").agg(
            F.max(F.struct("documents", "line")).alias("top"), F.count(F.lit(1)).alias("members")
        ).select("leaf", "members", F.col("top.line").alias("seed")),
        "seeds",
    )
    total, largest = seeds.agg(F.sum("members"), F.max("members")).first()
    own = F.xxhash64("key", F.lit("own"))
    placed = join_by_frequency(
        known,
        seeds,
        ["leaf"],
        spread_by="key",
        frequency="members",
        total_rows=total or 0,
        largest=largest or 0,
    ).withColumn("equal", _equal_places("line", "seed"))
    alike = 100 * F.size(F.filter("equal", lambda x: x)) >= SIMILAR_PERCENT * F.size("equal")
    placed = stored(
        placed.withColumn("alike", alike).select(
            "key",
            F.when(F.col("alike"), F.struct("leaf", F.lit(0).cast("long").alias("part")))
            .otherwise(F.struct("leaf", own.alias("part")))
            .alias("group"),
            F.when(F.col("alike"), F.col("seed")).otherwise(F.col("line")).alias("seed"),
            F.when(
                F.col("alike"),
                F.filter(
                    F.transform("equal", lambda same, i: F.when(~same, i)), lambda i: i.isNotNull()
                ),
            ).alias("differs"),
        ),
        "placed",
    )
    recurring = (
        held.select("key", "doc")
        .join(placed.select("key", "group"), "key")
        .groupBy("group", "doc")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("group")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= least_documents)
    )
    fields = (
        placed.select("group", F.explode("differs").alias("place"))
        .groupBy("group")
        .agg(F.collect_set("place").alias("fields"))
    )
    shape = F.array_join(
        F.transform(
            F.split("seed", " "),
            lambda t, i: F.when(F.array_contains("fields", i), F.lit(WILDCARD)).otherwise(t),
        ),
        " ",
    )
    of_seeds = (
        placed.join(recurring, "group")
        .join(fields, "group", "left")
        .withColumn("fields", F.coalesce("fields", F.array().cast("array<int>")))
        .select("key", shape.alias("template"), "documents")
    )
    return of_seeds.unionByName(_one_field_templates(known, held, least_documents))


def _one_field_templates(known: DataFrame, held: DataFrame, least_documents: int) -> DataFrame:
    """``(key, template, documents)`` of lines of a leaf that differ in one place only.

    Such lines share the half that does not hold the place, so lines are first met by their
    halves, and a line that shares one stands for each place of the other with that token
    masked. These are known by two hashes; the text of a template is made once it recurs. A
    member in enough documents by itself makes a template recur, with at least its number of
    documents; the documents of other members, each in fewer, are counted together.
    """
    tokens = F.split("line", " ")
    size = F.size(tokens)
    half = F.floor(size / F.lit(2)).cast("int")
    long_enough = 100 * (size - 1) >= SIMILAR_PERCENT * size
    sides = known.where(long_enough).select(
        "key",
        "leaf",
        "documents",
        F.explode(
            F.array(
                F.struct(
                    F.xxhash64(F.slice(tokens, F.lit(1), half)).alias("same"),
                    (half + 1).alias("first"),
                    size.alias("last"),
                ),
                F.struct(
                    F.xxhash64(F.slice(tokens, half + 1, size)).alias("same"),
                    F.lit(1).alias("first"),
                    half.alias("last"),
                ),
            )
        ).alias("side"),
    ).select("key", "leaf", "documents", "side.same", "side.first", "side.last")
    shared = (
        sides.groupBy("leaf", "same", "first")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("documents").alias("sum"))
        .where((F.col("lines") > 1) & (F.col("sum") >= least_documents))
        .select("leaf", "same", "first")
    )
    alike = stored(sides.join(shared, ["leaf", "same", "first"]), "halves")
    tokens_of = known.select("key", tokens.alias("tokens"))
    without_one = F.array_join(
        F.concat(
            F.slice("tokens", F.lit(1), F.col("place") - 1),
            F.array(F.lit(WILDCARD)),
            F.slice("tokens", F.col("place") + 1, F.size("tokens")),
        ),
        " ",
    )
    members = stored(
        alike.join(tokens_of, "key")
        .select("key", "leaf", "documents", "tokens", F.explode(F.sequence("first", "last")).alias("place"))
        .select("key", "documents", "leaf", "place", _key(without_one).alias("shape")),
        "places",
    )
    group = ["leaf", "place", "shape"]
    several = members.groupBy(*group).agg(
        F.count(F.lit(1)).alias("lines"),
        F.max("documents").alias("most"),
        F.sum("documents").alias("sum"),
    ).where((F.col("lines") > 1) & (F.col("sum") >= least_documents))
    several = stored(several, "several")
    by_one = several.where(F.col("most") >= least_documents).select(*group, F.col("most").alias("documents"))
    by_many = (
        members.join(several.where(F.col("most") < least_documents).select(*group), group)
        .select(*group, "key")
        .join(held.select("key", "doc"), "key")
        .groupBy(*group)
        .agg(F.count_distinct("doc").alias("documents"))
        .where(F.col("documents") >= least_documents)
    )
    found = by_one.unionByName(by_many)
    return (
        members.drop("documents")
        .join(found, group)
        .join(tokens_of, "key")
        .select("key", without_one.alias("template"), "documents")
    )


def drop_recurring(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text, rid)``, one row per row of ``docs``.

    Lines end at a newline; a line without tokens belongs to no template and is kept.
    A null text counts as empty and is one empty line. Copies of a document lose the
    same lines. Repeated rows, null ids and further columns change nothing; an empty
    table gives an empty result. Of lines that are equally common the last in order is the
    seed. Texts and lines may be of any length; a text is one row throughout.
    """
    rows = keyed(docs)
    lines = stored(lines_of(rows), "all-lines")
    dropped = stored(templates(lines, least_documents).select("key").distinct(), "templates")
    gone = stored(
        small_join(lines.select("rid", "line_no", "key"), dropped, "key", "left_semi", 24)
        .groupBy("rid")
        .agg(F.collect_list("line_no").alias("gone")),
        "gone",
    )
    text_lines = F.split(F.coalesce("text", F.lit("")), "\n")
    left = F.filter(text_lines, lambda line, i: ~F.array_contains("gone", i))
    return (
        small_join(rows, gone, "rid", "left", 4 * F.size("gone") + 16)
        .withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
        .select(
            "doc_id",
            F.size(text_lines).cast("long").alias("n_lines"),
            F.size("gone").cast("long").alias("n_dropped"),
            F.array_join(left, "\n").alias("kept_text"),
            "rid",
        )
    )


SQL = rf"""WITH
    raw AS (
        SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
        FROM documents),
    lines AS (
        SELECT *, list_transform(
                   regexp_split_to_array(
                       trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                       '[\x20\t\x0B\f\r]+'),
                   lambda t: CASE WHEN regexp_matches(t, '\p{{N}}') THEN '{WILDCARD}' ELSE t END
               ) AS tokens
        FROM raw WHERE regexp_matches(raw, '[^\x20\t\x0B\f\r]')),
    placed AS (
        SELECT *, len(tokens) AS size, tokens[1:{LEADING_TOKENS}] AS head,
               array_to_string(tokens, ' ') AS line FROM lines),
    held AS (
        SELECT size, head, line, any_value(tokens) AS tokens,
               count(DISTINCT text) AS documents FROM placed GROUP BY ALL),
    seeds AS (
        SELECT size, head, line AS seed, tokens AS seed_tokens FROM held
        QUALIFY row_number() OVER (
            PARTITION BY size, head ORDER BY documents DESC, line DESC) = 1),
    grouped AS (
        SELECT held.line, CASE WHEN 100 * len(list_filter(range(1, size + 1),
                   lambda i: tokens[i] = seed_tokens[i])) >= {SIMILAR_PERCENT} * size
               THEN seed ELSE held.line END AS template
        FROM held JOIN seeds USING (size, head)),
    recurring AS (
        SELECT template FROM grouped JOIN placed USING (line)
        GROUP BY template HAVING count(DISTINCT text) >= {LEAST_DOCUMENTS}),
    places AS (
        SELECT DISTINCT size, head, line, place,
               tokens[1:place - 1] || ['{WILDCARD}'] || tokens[place + 1:] AS shape
        FROM (SELECT size, head, line, tokens, unnest(range(1, size + 1)) AS place FROM held)
        WHERE 100 * (size - 1) >= {SIMILAR_PERCENT} * size),
    shapes AS (
        SELECT size, head, place, shape FROM places JOIN placed USING (size, head, line)
        GROUP BY ALL
        HAVING count(DISTINCT line) > 1 AND count(DISTINCT text) >= {LEAST_DOCUMENTS}),
    dropped AS (
        SELECT line FROM grouped JOIN recurring USING (template)
        UNION SELECT line FROM places JOIN shapes USING (size, head, place, shape)),
    gone AS (
        SELECT doc_id, line_no FROM placed WHERE line IN (SELECT line FROM dropped)),
    kept AS (
        SELECT raw.doc_id, count(*) AS n_lines, count(gone.line_no) AS n_dropped,
               coalesce(string_agg(raw.raw, chr(10) ORDER BY raw.line_no)
                        FILTER (WHERE gone.line_no IS NULL), '') AS kept_text
        FROM raw LEFT JOIN gone ON raw.doc_id = gone.doc_id AND raw.line_no = gone.line_no
        GROUP BY raw.doc_id)
SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM kept"""
