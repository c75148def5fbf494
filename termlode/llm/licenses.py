"""Licence texts found by canonical digest, in built-in functions only.

A text is brought to a canonical form: lower case, copyright lines dropped, punctuation
and white space reduced to single blanks, equivalent spellings made one. Its digest is
looked up among those of known licences by a hash join. What is looked up is an entire
text: that of the document, and that of each of its lines, as notices are one line long.
The known digests are a table of fixed size and come from the same expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.llm.common import keyed, keyed_rows, stored, with_key, without
from termlode.llm.license_texts import FULL_TEXTS, KNOWN, NOTICES

# Spellings that licence matching treats as equal, the second is kept.
EQUIVALENT = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("noncommercial", "non commercial"),
    ("v2", "version 2"),
    ("v3", "version 3"),
    ("owner", "holder"),
    ("owners", "holders"),
    ("percent", "per cent"),
    ("https", "http"),
)

COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Canonical form of a text; empty for null and for a text without words."""
    lines = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    # Two blanks between words, so that neighbours do not share one in a replacement.
    spaced = F.concat(F.lit("  "), F.regexp_replace(lines, NOT_WORD, "  "), F.lit("  "))
    for other, kept in EQUIVALENT:
        spaced = F.replace(spaced, F.lit(f" {other} "), F.lit(f" {kept} "))
    return F.trim(F.regexp_replace(spaced, " +", " "))


def with_digests(rows: DataFrame, texts: Column) -> DataFrame:
    """One row per element of ``texts``, with the ``digest`` of its canonical form.

    The digest is null where the form is empty. The form leaves a generator as a plain
    column, so that a filter or join on the digest does not work it out again.
    """
    forms = rows.select("*", F.explode_outer(F.transform(texts, canonical)).alias("form"))
    return forms.withColumn("digest", F.when(F.col("form") != "", F.sha2("form", 256))).drop("form")


def known_digests(spark: SparkSession) -> DataFrame:
    """``(license_id, digest)`` of the known texts, one row per digest."""

    def rows(pairs: tuple[tuple[str, str], ...], column: str) -> DataFrame:
        structs = (F.struct(F.lit(a).alias("license_id"), F.lit(b).alias(column)) for a, b in pairs)
        return spark.range(1).select(F.inline(F.array(*structs)))

    known = with_digests(rows((*KNOWN, *NOTICES), "t"), F.array("t")).drop("t")
    known = known.unionByName(rows(FULL_TEXTS, "digest"))
    return known.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, canonical_sha256, license_id, notices, n_notices, rid)`` of each row.

    ``license_id`` names the licence that the whole text is, ``notices`` the sorted ids of
    those that a whole line is, joined by commas, ``n_notices`` how many lines are. Null,
    empty and wordless texts have a null digest and no licence; so do texts that consist
    of copyright lines. Repeated rows, null ids and further columns change nothing; an
    empty table gives an empty result.
    """
    return scan_rows(keyed(docs))


def scan_rows(rows: DataFrame) -> DataFrame:
    known = F.broadcast(known_digests(rows.sparkSession))
    lines = with_digests(rows.select("rid", "text"), F.split("text", "\n")).drop("text")
    notices = (
        lines.join(known, "digest")
        .groupBy("rid")
        .agg(
            F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"),
            F.count(F.lit(1)).alias("n_notices"),
        )
    )
    whole = with_digests(rows, F.array("text")).drop("text")
    return (
        whole.join(known, "digest", "left")
        .join(stored(notices, "notices"), "rid", "left")
        .select(
            "doc_id",
            F.col("digest").alias("canonical_sha256"),
            "license_id",
            F.coalesce("notices", F.lit("")).alias("notices"),
            F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
            "rid",
        )
    )


def drop_licenses(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not a licence text as a whole."""
    named = with_key(docs)
    return without(named, scan_rows(keyed_rows(named)).where("license_id IS NOT NULL"))


def sql() -> str:
    """The scan of ``documents`` in SQL."""

    def form(text: str) -> str:
        lines = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', '', 'g')"
        spaced = f"'  ' || regexp_replace({lines}, '{NOT_WORD}', '  ', 'g') || '  '"
        for other, kept in EQUIVALENT:
            spaced = f"replace({spaced}, ' {other} ', ' {kept} ')"
        return f"trim(regexp_replace({spaced}, ' +', ' ', 'g'))"

    values = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN
    )
    return f"""WITH
    listed(license_id, t) AS (VALUES {values}),
    known AS (SELECT sha256({form("t")}) AS digest, min(license_id) AS license_id
              FROM listed GROUP BY 1),
    whole AS (SELECT doc_id, {form("text")} AS form FROM documents),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    forms AS (SELECT doc_id, {form("line")} AS form FROM lines),
    notices AS (
        SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices,
               count(*) AS n_notices
        FROM forms JOIN known ON sha256(form) = digest AND form <> '' GROUP BY doc_id)
SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS canonical_sha256, license_id,
       coalesce(notices, '') AS notices, coalesce(n_notices, 0)::BIGINT AS n_notices
FROM whole LEFT JOIN known ON form <> '' AND sha256(form) = digest
LEFT JOIN notices USING (doc_id)"""
