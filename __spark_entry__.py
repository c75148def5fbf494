"""

Every query reads a whole table of ``sf_dir``. The corpus is ``documents`` with one
collection per language; ``benchmark`` supplies query texts and ``pages`` URLs.
Doubles are rounded to six places, arrays and maps are emitted as sorted strings.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The package lies next to this file, wherever the file is loaded from.
sys.path.insert(0, str(Path(__file__).resolve().parent))

import termlode as tl  # noqa: E402
from termlode.functions import clean, doc_name, strip_prefix, tf  # noqa: E402

QUERY = "The ention of onthe and"
REPEATED_QUERY = "ention onthe onthe of"
COMPAT_QUERY = "the ention nosuchword"
COLLECTION = "en"
PART_ROWS = 100
COMMON_ROWS = 256
ADDITIONS = 3


# --- inputs -----------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.corpus_from_table(_table(spark, sf_dir, "documents"), "lang", "doc_id", "text")


def _docs(spark: SparkSession, sf_dir: str, collection: str | None = None) -> DataFrame:
    return tl.spread(tl.in_collection(_corpus(spark, sf_dir), collection))


def _index(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return tl.build_index(_docs(spark, sf_dir), **options)


def _query_index(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    return _index(spark, sf_dir, words=sorted(set(tl.query_words(query))))


def _query_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole benchmark text as a query for 1 to 5 results."""
    return _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"),
        "text",
        (F.col("item_id") % 5 + 1).alias("amount"),
    )


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.select(
        *(
            F.round(name, 6).alias(name) if kind == "double" else F.col(name)
            for name, kind in frame.dtypes
        )
    )


def _map_text(column: str) -> F.Column:
    """A map as ``key=millionths`` entries in order."""
    entries = F.transform(
        F.sort_array(F.map_entries(column)),
        lambda e: F.concat_ws(
            "=", e["key"].cast("string"), F.round(e["value"] * 1e6).cast("long").cast("string")
        ),
    )
    return F.array_join(entries, "\n")


# --- queries ----------------------------------------------------------------------


def corpus_documents(spark, sf_dir):
    return _corpus(spark, sf_dir)


def collection_sizes(spark, sf_dir):
    return tl.collection_sizes(_corpus(spark, sf_dir))


def doc_key_prefix_strip(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select(
        "page_id", strip_prefix(F.col("url"), "https://").alias("file")
    )


def doc_key_name(spark, sf_dir):
    filename = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return _table(spark, sf_dir, "documents").select(
        "doc_id", doc_name(F.col("lang"), filename).alias("filename")
    )


def index_orc_roundtrip(spark, sf_dir):
    path = tl.scratch_path(spark, "index")
    tl.index_corpus(_docs(spark, sf_dir), path)
    return _rounded(tl.load_index(spark, path, file_type="bigint"))


def index_rebuild_collection(spark, sf_dir):
    """Every collection stored on its own, one of them built anew afterwards."""
    path = tl.scratch_path(spark, "index")
    docs = _docs(spark, sf_dir)
    names = [row[0] for row in tl.collection_sizes(docs).select("collection").collect()]
    for name in sorted(names):
        tl.index_corpus(tl.in_collection(docs, name), path)
    tl.index_corpus(tl.in_collection(docs, COLLECTION), path, mode="overwrite")
    return _rounded(tl.load_index(spark, path, file_type="bigint"))


def corpus_files_roundtrip(spark, sf_dir):
    """The documents as text files, one each, read back as a folder of folders."""
    path = tl.scratch_path(spark, "corpus")
    tl.write_corpus(_corpus(spark, sf_dir), path)
    files = tl.read_corpus(spark, path, source="binaryFile")
    return files.select(
        F.substring_index("collection", "=", -1).alias("collection"),
        F.regexp_extract("file", r"/file=(\d+)[/.]", 1).cast("long").alias("file"),
        "text",
    )


def clean_documents_roundtrip(spark, sf_dir):
    path = tl.scratch_path(spark, "clean")
    tl.write_clean(tl.clean_documents(_docs(spark, sf_dir)), path)
    return tl.load_clean(spark, path)


def _cleaned(normalizer):
    def query(spark, sf_dir):
        return _docs(spark, sf_dir).select(
            "collection", "file", clean(F.col("text"), normalizer).alias("content")
        )

    return query


def clean_punct_lines(spark, sf_dir):
    return _docs(spark, sf_dir).select(
        "collection",
        "file",
        F.explode(F.split(clean(F.col("text"), "punct_lines"), "\n")).alias("line"),
    )


def tokens_word_hyphen(spark, sf_dir):
    return tl.tokens(_docs(spark, sf_dir))


def tokens_punct(spark, sf_dir):
    return tl.tokens(_docs(spark, sf_dir), "punct_lines")


def inverted_index(spark, sf_dir):
    lists = tl.inverted_index(tl.weighted_counts(_docs(spark, sf_dir)), PART_ROWS)
    return lists.withColumn("files", F.array_join(F.col("files").cast("array<string>"), " "))


def postings_roundtrip(spark, sf_dir):
    """The inverted index of posting lists that were stored as blocks of document numbers."""
    path = tl.scratch_path(spark, "postings")
    tl.write_postings(_docs(spark, sf_dir), path)
    lists = tl.inverted_index(tl.load_postings(spark, path, file_type="bigint"), PART_ROWS)
    return lists.withColumn("files", F.array_join(F.col("files").cast("array<string>"), " "))


def doc_lengths(spark, sf_dir):
    return tl.doc_lengths(_docs(spark, sf_dir))


def term_counts(spark, sf_dir):
    return tl.term_counts(_docs(spark, sf_dir)).select("collection", "file", "word", "count")


def _term_frequency(form):
    def query(spark, sf_dir):
        counts = tl.term_counts(_docs(spark, sf_dir))
        return _rounded(counts.select("collection", "file", "word", tf(form).alias("tf")))

    return query


def doc_freq(spark, sf_dir):
    return tl.doc_freq(_docs(spark, sf_dir))


def _idf(flipped):
    def query(spark, sf_dir):
        words = tl.vocabulary(_docs(spark, sf_dir), flipped_idf=flipped)
        return _rounded(words.select("collection", "word", "df", "idf"))

    return query


def _tfidf(**options):
    def query(spark, sf_dir):
        return _rounded(_index(spark, sf_dir, **options))

    return query


def query_terms(spark, sf_dir):
    return tl.query_terms(_query_set(spark, sf_dir))


def query_matches(spark, sf_dir):
    return _rounded(tl.query_matches(_query_index(spark, sf_dir, QUERY), QUERY))


def query_unmatched_terms(spark, sf_dir):
    terms = tl.query_terms(_query_set(spark, sf_dir)).select("query_id", "word")
    words = tl.distinct_words(_docs(spark, sf_dir))
    return tl.unmatched_terms(terms, words).select("query_id", "word")


def _search(query, collection=None, **options):
    def run(spark, sf_dir):
        return _rounded(tl.search_documents(_docs(spark, sf_dir, collection), query, **options))

    return run


def _search_bounded(n, collection=None):
    """Top n of a stored index whose common words are kept in classes of weight too."""

    def run(spark, sf_dir):
        path, impacts = tl.scratch_path(spark, "index"), tl.scratch_path(spark, "impacts")
        tl.index_corpus(_docs(spark, sf_dir), path)
        index = tl.load_index(spark, path, file_type="bigint")
        tl.write_impacts(index, impacts, COMMON_ROWS)
        loaded = tl.load_impacts(spark, impacts, file_type="bigint")
        return _rounded(tl.search_top(index, loaded, QUERY, n, collection))

    return run


def search_word_files_top5(spark, sf_dir):
    """Top 5 from the files of the query's words, looked up in the stored vocabulary."""
    path, vocab = tl.scratch_path(spark, "index"), tl.scratch_path(spark, "vocabulary")
    tl.index_corpus(_docs(spark, sf_dir), path, vocab_path=vocab)
    words = tl.query_words(QUERY)
    return _rounded(
        tl.search(tl.load_words(spark, path, vocab, words, file_type="bigint"), QUERY, 5)
    )


def _grown(spark, sf_dir):
    """A store to which the documents were added in several lots."""
    path = tl.scratch_path(spark, "growing")
    docs = _docs(spark, sf_dir)
    for lot in range(ADDITIONS):
        tl.add_documents(docs.where(F.pmod(F.xxhash64("file"), F.lit(ADDITIONS)) == lot), path)
    return path


def growing_index(spark, sf_dir):
    return _rounded(tl.load_growing(spark, _grown(spark, sf_dir), file_type="bigint"))


def growing_vocabulary(spark, sf_dir):
    words = tl.growing_vocabulary(spark, _grown(spark, sf_dir))
    return _rounded(words.select("collection", "word", "df", "idf"))


def growing_norms(spark, sf_dir):
    return _rounded(tl.growing_norms(spark, _grown(spark, sf_dir), file_type="bigint"))


def growing_search_top5(spark, sf_dir):
    path, words = _grown(spark, sf_dir), tl.query_words(QUERY)
    index = tl.load_growing(spark, path, words=words, file_type="bigint")
    return _rounded(tl.search(index, QUERY, 5))


def search_batch_topk(spark, sf_dir):
    queries = _query_set(spark, sf_dir)
    return _rounded(tl.search_batch(_index(spark, sf_dir), queries, store_entries=True))


def search_batch_compat(spark, sf_dir):
    queries = _query_set(spark, sf_dir).withColumn("amount", F.lit(1_000_000))
    index = _index(spark, sf_dir)
    return _rounded(tl.search_batch(index, queries, compat=True, store_entries=True)).drop("rank")


def search_batch_collections(spark, sf_dir):
    """Every second query searches one collection, each cleaned like a document."""
    scope = F.when(F.col("query_id") % 2 == 0, COLLECTION)
    queries = _query_set(spark, sf_dir).withColumn("collection", scope)
    return _rounded(
        tl.search_batch(_index(spark, sf_dir), queries, normalize_query=True, store_entries=True)
    )


def search_batch_rejects(spark, sf_dir):
    holes = _query_set(spark, sf_dir).select(
        "query_id",
        F.when(F.col("query_id") % 7 != 0, F.col("text")).otherwise("").alias("text"),
        F.when(F.col("query_id") % 3 != 0, F.col("amount")).alias("amount"),
    )
    _, rejected = tl.reject_invalid(holes)
    return rejected


def term_map(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    weighted = tl.weighted_counts(docs, vocab=tl.store_vocabulary(docs, cf=False))
    index = weighted.withColumn("tf_idf", tf() * F.col("idf"))
    return _rounded(tl.term_map(index, PART_ROWS).withColumn("scores", _map_text("scores")))


def doc_vectors(spark, sf_dir):
    return tl.doc_vectors(_index(spark, sf_dir)).withColumn("vector", _map_text("vector"))


def doc_norms(spark, sf_dir):
    return _rounded(tl.doc_norms(_index(spark, sf_dir)))


def query_vector(spark, sf_dir):
    index = _query_index(spark, sf_dir, REPEATED_QUERY)
    return _rounded(tl.query_vector(index, REPEATED_QUERY))


def cosine_scores(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    vocab = tl.store_vocabulary(docs, cf=False)
    index = tl.build_index(docs, vocab=vocab)
    return _rounded(tl.cosine(index, REPEATED_QUERY, vocab=vocab.frame))


def _training_data() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and oracles of the training-data operators, where these are installed."""
    queries: dict[str, Callable] = {}
    oracles: dict[str, str] = {}
    package = find_spec("termlode.llm")
    if package is not None and package.origin is not None:
        from termlode.llm.queries import ORACLES, QUERIES

        queries.update(QUERIES)
        oracles.update(ORACLES)
        if find_spec("corpus_pipeline") is not None:
            import corpus_pipeline

            queries["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL is not None:
                oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, oracles


def entry(spark: SparkSession) -> DataFrame:
    """Five best documents for a query of common words on the smallest tables."""
    return _search("the of and", n=5)(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**text_search_queries(), **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**text_search_oracles(), **_training_data()[1]}


def text_search_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "corpus_documents": corpus_documents,
        "collection_sizes": collection_sizes,
        "doc_key_prefix_strip": doc_key_prefix_strip,
        "doc_key_name": doc_key_name,
        "index_orc_roundtrip": index_orc_roundtrip,
        "index_rebuild_collection": index_rebuild_collection,
        "corpus_files_roundtrip": corpus_files_roundtrip,
        "clean_documents_roundtrip": clean_documents_roundtrip,
        "clean_word_hyphen": _cleaned("word_hyphen"),
        "clean_punct_lines": clean_punct_lines,
        "clean_strip_last": _cleaned("word_hyphen_strip_last"),
        "tokens_word_hyphen": tokens_word_hyphen,
        "tokens_punct": tokens_punct,
        "inverted_index": inverted_index,
        "postings_roundtrip": postings_roundtrip,
        "doc_lengths": doc_lengths,
        "term_counts": term_counts,
        "tf_ratio": _term_frequency("ratio"),
        "tf_raw": _term_frequency("raw"),
        "doc_freq": doc_freq,
        "idf": _idf(flipped=False),
        "idf_flipped": _idf(flipped=True),
        "tfidf_index": _tfidf(),
        "tfidf_index_raw": _tfidf(tf="raw"),
        "tfidf_index_punct": _tfidf(normalizer="punct_lines"),
        "query_terms": query_terms,
        "query_matches": query_matches,
        "query_unmatched_terms": query_unmatched_terms,
        "search_scores": _search(QUERY),
        "search_top1": _search(QUERY, n=1),
        "search_top3": _search(QUERY, n=3),
        "search_top5": _search(QUERY, n=5),
        "search_scores_compat": _search(COMPAT_QUERY, compat=True),
        "search_repeated_terms": _search(REPEATED_QUERY),
        "search_in_collection": _search(QUERY, n=10, collection=COLLECTION),
        "search_bounded_top1": _search_bounded(1),
        "search_bounded_top5": _search_bounded(5),
        "search_bounded_in_collection": _search_bounded(10, COLLECTION),
        "search_word_files_top5": search_word_files_top5,
        "growing_index": growing_index,
        "growing_vocabulary": growing_vocabulary,
        "growing_norms": growing_norms,
        "growing_search_top5": growing_search_top5,
        "search_batch_topk": search_batch_topk,
        "search_batch_compat": search_batch_compat,
        "search_batch_collections": search_batch_collections,
        "search_batch_rejects": search_batch_rejects,
        "term_map": term_map,
        "doc_vectors": doc_vectors,
        "doc_norms": doc_norms,
        "query_vector": query_vector,
        "cosine_scores": cosine_scores,
    }


# --- oracles ----------------------------------------------------------------------

_SPACE = r"[\p{Z}\s\x0B\x1C-\x1F\x{85}]"
_DELETED = r"[^\p{L}\p{N}_\p{Z}\s\x0B\x1C-\x1F\x{85}-]"
_STRIP = rf"^{_SPACE}+|{_SPACE}+$"
_PUNCT = r"[!-/:-@\[\]-`{-~]"

_TOKENS = {
    "word_hyphen": f"""
    cleaned AS (
        SELECT lang AS collection, doc_id AS file,
               regexp_replace(regexp_replace(lower(
                   replace(regexp_replace(text, '\\n+', chr(10), 'g'), chr(10), ' ')),
                   '{_STRIP}', '', 'g'), '{_DELETED}', '', 'g') AS content
        FROM documents),
    tokens AS (
        SELECT collection, file, unnest(string_split(content, ' ')) AS word FROM cleaned)""",
    "punct_lines": f"""
    raw_lines AS (
        SELECT lang AS collection, doc_id AS file,
               unnest(string_split(text, chr(10))) AS raw_line
        FROM documents),
    cleaned AS (
        SELECT collection, file,
               regexp_replace(regexp_replace(lower(raw_line), '{_STRIP}', '', 'g'),
                              '{_PUNCT}', '', 'g') AS line
        FROM raw_lines),
    tokens AS (
        SELECT collection, file, unnest(string_split(line, ' ')) AS word FROM cleaned)""",
    "word_hyphen_strip_last": f"""
    cleaned AS (
        SELECT lang AS collection, doc_id AS file,
               regexp_replace(lower(replace(regexp_replace(regexp_replace(
                   text, '{_DELETED}', '', 'g'), '\\n+', chr(10), 'g'), chr(10), ' ')),
                   '{_STRIP}', '', 'g') AS content
        FROM documents),
    tokens AS (
        SELECT collection, file, unnest(string_split(content, ' ')) AS word FROM cleaned)""",
}

_INDEX = """
    lengths AS (
        SELECT collection, file, count(*) AS word_count FROM tokens GROUP BY ALL),
    counts AS (
        SELECT collection, file, word, count(*) AS "count" FROM tokens GROUP BY ALL),
    sizes AS (
        SELECT lang AS collection, count(*) AS n_docs FROM documents GROUP BY ALL),
    freqs AS (
        SELECT collection, word, count(DISTINCT file) AS df FROM tokens GROUP BY ALL),
    idfs AS (
        SELECT collection, word, df, ln(n_docs::DOUBLE / df) AS idf
        FROM freqs JOIN sizes USING (collection)),
    entries AS (
        SELECT collection, word, file, "count", word_count, df, idf,
               "count"::DOUBLE / word_count AS tf,
               "count"::DOUBLE / word_count * idf AS tf_idf
        FROM counts JOIN lengths USING (collection, file) JOIN idfs USING (collection, word))"""

_QUERY_SET = """
    query_set AS (
        SELECT item_id AS query_id,
               text, item_id % 5 + 1 AS amount
        FROM benchmark),
    query_words AS (
        SELECT query_id, amount, unnest(string_split(lower(text), ' ')) AS word,
               len(string_split(lower(text), ' ')) AS total_words
        FROM query_set),
    terms AS (
        SELECT query_id, amount, word, count(*) AS tf, total_words
        FROM query_words GROUP BY ALL)"""


def _with(select: str, *more: str, normalizer: str = "word_hyphen") -> str:
    return "WITH " + ",".join([_TOKENS[normalizer], _INDEX, *more]) + "\n" + select


def _query_cte(query: str, lowered: bool = True) -> str:
    text = f"lower('{query}')" if lowered else f"'{query}'"
    return f"""
    asked AS (SELECT unnest(string_split({text}, ' ')) AS word),
    q AS (
        SELECT word, count(*) AS tf, (SELECT count(*) FROM asked) AS total FROM asked GROUP BY word),
    scored AS (
        SELECT collection, file, sum(tf_idf) * (count(*)::DOUBLE / max(total)) AS score
        FROM q JOIN entries USING (word) GROUP BY ALL)"""


_RANKED = "ORDER BY round(score, 9) DESC NULLS LAST, collection, file"


def _search_sql(query: str, n: int | None = None, where: str = "") -> str:
    limit = "" if n is None else f" LIMIT {n}"
    return _with(
        f"SELECT collection, file, round(score, 6) AS score FROM scored {where} {_RANKED}{limit}",
        _query_cte(query),
    )


_FILE_DIGEST = "('0x' || left(md5(file::VARCHAR), 8))::BIGINT"


def _part_sql(rows: str) -> str:
    parts = f"ceil({rows}::DOUBLE / {PART_ROWS})::BIGINT"
    return f"CASE WHEN {parts} > 1 THEN {_FILE_DIGEST} % {parts} ELSE 0 END"


def _map_sql(key: str, value: str) -> str:
    return (
        f"string_agg({key}::VARCHAR || '=' || round({value} * 1000000)::BIGINT::VARCHAR, "
        f"chr(10) ORDER BY {key})"
    )


_INDEX_SELECT = """SELECT collection, word, file, round(idf, 6) AS idf,
       round(tf_idf, 6) AS tf_idf FROM entries"""


_INVERTED = f"""SELECT collection, word, bucket + buckets * (occurrence // {PART_ROWS}) AS part,
       string_agg(file::VARCHAR, ' ' ORDER BY file) AS files
FROM (SELECT *, sum("count") OVER (PARTITION BY collection, word, bucket ORDER BY file
                                   ROWS UNBOUNDED PRECEDING)::BIGINT - "count"
                + unnest(range("count")) AS occurrence
      FROM (SELECT *, {_FILE_DIGEST} % buckets AS bucket
            FROM (SELECT collection, word, file, "count",
                         CASE WHEN cf > {PART_ROWS} THEN ceil(2 * cf / {PART_ROWS})::BIGINT
                              ELSE 1 END AS buckets
                  FROM (SELECT *, sum("count") OVER (PARTITION BY collection, word) AS cf
                        FROM counts))))
GROUP BY ALL"""


def text_search_oracles() -> dict[str, str]:
    scores = {
        "search_scores": _search_sql(QUERY),
        "search_top1": _search_sql(QUERY, 1),
        "search_top3": _search_sql(QUERY, 3),
        "search_top5": _search_sql(QUERY, 5),
        "search_repeated_terms": _search_sql(REPEATED_QUERY),
        "search_in_collection": _search_sql(QUERY, 10, f"WHERE collection = '{COLLECTION}'"),
        "search_bounded_top1": _search_sql(QUERY, 1),
        "search_bounded_top5": _search_sql(QUERY, 5),
        "search_bounded_in_collection": _search_sql(
            QUERY, 10, f"WHERE collection = '{COLLECTION}'"
        ),
        "search_word_files_top5": _search_sql(QUERY, 5),
        "growing_search_top5": _search_sql(QUERY, 5),
        "search_scores_compat": _with(
            f"""SELECT collection, file, round(score, 6) AS score FROM (
    SELECT collection, file, sum(tf_idf) * (count(word)::DOUBLE / max(total)) AS score
    FROM (SELECT entries.collection, entries.file, q.word, q.total, entries.tf_idf
          FROM q LEFT JOIN entries ON q.word = entries.word)
    GROUP BY ALL) {_RANKED}""",
            _query_cte(COMPAT_QUERY),
        ),
    }
    cosine = _with(
        """SELECT collection, file,
       round(coalesce(dot, 0) / nullif(query_norm * norm, 0), 6) AS score
FROM norms LEFT JOIN dots USING (collection, file) LEFT JOIN query_norms USING (collection)""",
        _query_cte(REPEATED_QUERY, lowered=False),
        """
    weights AS (
        SELECT collection, word, q.tf AS repeats, q.tf::DOUBLE / total * idf AS weight
        FROM q JOIN idfs USING (word)),
    norms AS (
        SELECT collection, file, sqrt(sum(tf_idf * tf_idf)) AS norm FROM entries GROUP BY ALL),
    dots AS (
        SELECT collection, file, sum(repeats * weight * tf_idf) AS dot
        FROM entries JOIN weights USING (collection, word) GROUP BY ALL),
    query_norms AS (
        SELECT collection, sqrt(sum(weight * weight)) AS query_norm FROM weights GROUP BY ALL)""",
    )
    return {
        "corpus_documents": "SELECT lang AS collection, doc_id AS file, text FROM documents",
        "collection_sizes": (
            "SELECT lang AS collection, count(*) AS n_docs FROM documents GROUP BY lang"
        ),
        "doc_key_prefix_strip": (
            "SELECT page_id, replace(url, 'https://', '') AS file FROM pages"
        ),
        "doc_key_name": "SELECT doc_id, lang || '-' || doc_id AS filename FROM documents",
        "index_orc_roundtrip": _with(_INDEX_SELECT),
        "index_rebuild_collection": _with(_INDEX_SELECT),
        "corpus_files_roundtrip": (
            "SELECT lang AS collection, doc_id AS file, text || chr(10) AS text FROM documents"
        ),
        "clean_documents_roundtrip": _with(
            "SELECT collection || '-' || file AS filename, content FROM cleaned",
            normalizer="word_hyphen_strip_last",
        ),
        "clean_word_hyphen": _with("SELECT collection, file, content FROM cleaned"),
        "clean_punct_lines": _with(
            "SELECT collection, file, line FROM cleaned", normalizer="punct_lines"
        ),
        "clean_strip_last": _with(
            "SELECT collection, file, content FROM cleaned", normalizer="word_hyphen_strip_last"
        ),
        "tokens_word_hyphen": _with("SELECT collection, file, word FROM tokens"),
        "tokens_punct": _with(
            "SELECT collection, file, word FROM tokens", normalizer="punct_lines"
        ),
        "inverted_index": _with(_INVERTED),
        "postings_roundtrip": _with(_INVERTED),
        "doc_lengths": _with("SELECT collection, file, word_count FROM lengths"),
        "term_counts": _with('SELECT collection, file, word, "count" FROM counts'),
        "tf_ratio": _with("SELECT collection, file, word, round(tf, 6) AS tf FROM entries"),
        "tf_raw": _with('SELECT collection, file, word, "count"::DOUBLE AS tf FROM counts'),
        "doc_freq": _with("SELECT collection, word, df FROM freqs"),
        "idf": _with("SELECT collection, word, df, round(idf, 6) AS idf FROM idfs"),
        "growing_index": _with(_INDEX_SELECT),
        "growing_vocabulary": _with("SELECT collection, word, df, round(idf, 6) AS idf FROM idfs"),
        "growing_norms": _with(
            """SELECT collection, file, round(coalesce(sqrt(sum(tf_idf * tf_idf)), 0), 6) AS norm
FROM lengths LEFT JOIN entries USING (collection, file) GROUP BY collection, file"""
        ),
        "idf_flipped": _with(
            """SELECT collection, word, df, round(ln(df::DOUBLE / n_docs), 6) AS idf
FROM freqs JOIN sizes USING (collection)"""
        ),
        "tfidf_index": _with(_INDEX_SELECT),
        "tfidf_index_raw": _with(
            """SELECT collection, word, file, round(idf, 6) AS idf,
       round("count" * idf, 6) AS tf_idf FROM entries"""
        ),
        "tfidf_index_punct": _with(_INDEX_SELECT, normalizer="punct_lines"),
        "query_terms": _with("SELECT query_id, word, tf, total_words FROM terms", _QUERY_SET),
        "query_matches": _with(
            """SELECT collection, file, word, q.tf AS tf, round(idf, 6) AS idf,
       round(tf_idf, 6) AS tf_idf FROM q JOIN entries USING (word)""",
            _query_cte(QUERY),
        ),
        "query_unmatched_terms": _with(
            """SELECT query_id, word FROM terms
WHERE NOT EXISTS (SELECT 1 FROM freqs WHERE freqs.word = terms.word)""",
            _QUERY_SET,
        ),
        **scores,
        "search_batch_topk": _with(
            f"""SELECT query_id, rank, collection, file, round(score, 6) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id {_RANKED}) AS rank FROM (
        SELECT query_id, amount, collection, file,
               sum(tf_idf) * (count(*)::DOUBLE / max(total_words)) AS score
        FROM terms JOIN entries USING (word) GROUP BY ALL))
WHERE rank <= amount""",
            _QUERY_SET,
        ),
        "search_batch_compat": _with(
            """SELECT query_id, collection, file, round(score, 6) AS score FROM (
    SELECT query_id, collection, file,
           sum(tf_idf) * (count(tf_idf)::DOUBLE / max(total_words)) AS score
    FROM terms LEFT JOIN entries USING (word) GROUP BY ALL)""",
            _QUERY_SET,
        ),
        "search_batch_collections": _with(
            f"""SELECT query_id, rank, collection, file, round(score, 6) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id {_RANKED}) AS rank FROM (
        SELECT query_id, amount, collection, file,
               sum(tf_idf) * (count(*)::DOUBLE / max(total_words)) AS score
        FROM clean_terms JOIN entries USING (word)
        WHERE query_id % 2 = 1 OR collection = '{COLLECTION}' GROUP BY ALL))
WHERE rank <= amount""",
            f"""
    clean_words AS (
        SELECT item_id AS query_id, item_id % 5 + 1 AS amount,
               unnest(string_split(content, ' ')) AS word,
               len(string_split(content, ' ')) AS total_words
        FROM (SELECT item_id, regexp_replace(regexp_replace(lower(
                  replace(regexp_replace(text, '\\n+', chr(10), 'g'), chr(10), ' ')),
                  '{_STRIP}', '', 'g'), '{_DELETED}', '', 'g') AS content FROM benchmark)),
    clean_terms AS (
        SELECT query_id, amount, word, count(*) AS tf, total_words
        FROM clean_words GROUP BY ALL)""",
        ),
        "search_batch_rejects": f"""WITH {_QUERY_SET},
    holes AS (
        SELECT query_id, CASE WHEN query_id % 7 <> 0 THEN text ELSE '' END AS text,
               CASE WHEN query_id % 3 <> 0 THEN amount END AS amount
        FROM query_set)
SELECT query_id, text, amount,
       CASE WHEN text = '' THEN 'query missing' ELSE 'amount missing' END AS reason
FROM holes WHERE text = '' OR amount IS NULL""",
        "term_map": _with(
            f"""SELECT collection, word, round(idf, 6) AS idf, part,
       {_map_sql("file", "tf_idf")} AS scores
FROM (SELECT *, {_part_sql("df")} AS part FROM entries) GROUP BY collection, word, idf, part"""
        ),
        "doc_vectors": _with(
            f"""SELECT collection, file, {_map_sql("word", "tf_idf")} AS vector
FROM entries GROUP BY collection, file"""
        ),
        "doc_norms": _with(
            """SELECT collection, file, round(sqrt(sum(tf_idf * tf_idf)), 6) AS norm
FROM entries GROUP BY collection, file"""
        ),
        "query_vector": _with(
            """SELECT collection, word, round(q.tf::DOUBLE / total, 6) AS tf, round(idf, 6) AS idf,
       round(q.tf::DOUBLE / total * idf, 6) AS weight FROM q JOIN idfs USING (word)""",
            _query_cte(REPEATED_QUERY, lowered=False),
        ),
        "cosine_scores": cosine,
    }
