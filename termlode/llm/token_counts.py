"""Token counts from flat token files that have no index.

A token file is one run of little-endian 16-bit ids, an end-of-document id after each
document. It is read in blocks of fixed size, in any order and in parallel. A vectorised
search finds the end ids of a block, which settles the documents that lie inside it. The
first piece of a block belongs to a document that began earlier; how long it has grown by
then, and how many documents came before, is a prefix scan over the blocks' few numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termlode.llm import bpe
from termlode.llm.common import documents_of, stored
from termlode.sources.store import scratch_path

END_ID = 50256
BLOCK_TOKENS = 1 << 19

_SCANNED = "file string, block long, n_ends long, n_tokens long, head long, tail long, inner binary"


def write_token_files(docs: DataFrame, path: str, ranks_path: str | None = None) -> None:
    """Write the token ids of the texts as flat files, one per task, in the order of rows.

    A row's ids are its bytes and the end id is the line separator, so the text writer
    lays down the flat format on any file system. Null and empty texts are documents
    without tokens. Ids must fit 16 bits.
    """
    ranks = bpe.read_ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe._encoding(ranks).encode_ordinary
        for batch in batches:
            ids = [np.array(encode(t or ""), "<u2").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["value"])

    end = END_ID.to_bytes(2, "little").decode("latin-1")
    flat = docs.select("text").mapInArrow(run, "value binary")
    flat.select(F.col("value").cast("string")).write.option("lineSep", end).option(
        "encoding", "ISO-8859-1"
    ).text(path)


def read_blocks(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(file, block, ids)`` of the flat files of a folder, cut into blocks in the reader."""
    size = 2 * block_tokens
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("length") / size) - 1, F.lit(0)).cast("int"))
    return files.select(
        F.regexp_extract("path", r"([^/]*)$", 1).alias("file"), "content", F.explode(blocks).alias("b")
    ).select(
        "file",
        F.col("b").cast("long").alias("block"),
        F.substring("content", F.col("b") * size + 1, F.lit(size)).alias("ids"),
    )


def _scan(end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ids in batch.column("ids"):
                tokens = np.frombuffer(ids.as_buffer(), "<u2")
                ends = np.flatnonzero(tokens == end_id)
                lengths = np.diff(ends) - 1
                head = int(ends[0]) if len(ends) else len(tokens)
                tail = len(tokens) - int(ends[-1]) - 1 if len(ends) else len(tokens)
                rows.append((len(ends), len(tokens), head, tail, lengths.astype("<u4").tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"),
                    batch.column("block"),
                    *(pa.array(c, pa.int64()) for c in columns[:4]),
                    pa.array(columns[4], pa.binary()),
                ],
                ["file", "block", "n_ends", "n_tokens", "head", "tail", "inner"],
            )

    return run


def count_tokens(blocks: DataFrame, end_id: int = END_ID) -> DataFrame:
    """``(file, ordinal, n_tokens)`` of every document of the blocks of token files.

    ``ordinal`` counts the documents of a file from 0. Tokens after the last end id are
    a last document without an end. Documents may span any number of blocks, and a block
    may hold no end; an end id right after another is a document of 0 tokens; empty
    files have no documents. The window that stitches sees four numbers a block.
    """
    scanned = stored(blocks.mapInArrow(_scan(end_id), _SCANNED), "scanned")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Tokens up to a block, and as they stood after the last end before it.
    sums = (
        scanned.drop("inner")
        .withColumn("tokens_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
        .withColumn("ordinal", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
        .withColumn(
            "began",
            F.when(F.col("n_ends") > 0, F.col("tokens_before") + F.col("n_tokens") - F.col("tail")),
        )
        .withColumn("open_since", F.coalesce(F.last("began", True).over(before), F.lit(0)))
        .withColumn("is_last", F.lead("block").over(order).isNull())
    )
    first = sums.where("n_ends > 0").select(
        "file", "ordinal", (F.col("tokens_before") + F.col("head") - F.col("open_since")).alias("n_tokens")
    )
    rest = (
        sums.where("is_last")
        .select(
            "file",
            (F.col("ordinal") + F.col("n_ends")).alias("ordinal"),
            (
                F.col("tokens_before")
                + F.col("n_tokens")
                - F.when(F.col("n_ends") > 0, F.col("began")).otherwise(F.col("open_since"))
            ).alias("n_tokens"),
        )
        .where("n_tokens > 0")
    )
    inner = scanned.join(sums.select("file", "block", "ordinal"), ["file", "block"]).select(
        "file", "ordinal", "inner"
    )
    return first.unionByName(rest).unionByName(
        inner.mapInArrow(_inner_documents, "file string, ordinal long, n_tokens long")
    )


def _inner_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = [np.frombuffer(x.as_buffer(), "<u4") for x in batch.column("inner")]
        counts = [len(x) for x in lengths]
        first = batch.column("ordinal").to_numpy(zero_copy_only=False) + 1
        ordinals = [start + np.arange(n) for start, n in zip(first, counts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("file").take(pa.array(np.repeat(np.arange(len(counts)), counts))),
                pa.array(np.concatenate([np.zeros(0, np.int64), *ordinals]), pa.int64()),
                pa.array(np.concatenate([np.zeros(0, "<u4"), *lengths]).astype(np.int64)),
            ],
            ["file", "ordinal", "n_tokens"],
        )


def document_token_counts(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """``(doc_id, file, ordinal, n_tokens)`` of a stored table, through flat token files.

    The files say nothing of ids. A task writes its rows in order to the file of its
    number, so numbering the same scan again gives the id of each document of a file;
    ``docs`` must be a stored table, whose scan is the same each time. Null and empty
    texts count 0; repeated rows and null ids are counted each; other columns are
    ignored; an empty table gives no rows.
    """
    rows = documents_of(docs)
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(rows, path, ranks_path)
    counts = count_tokens(read_blocks(docs.sparkSession, path))
    # Number and place of a row: the upper bits are the task, the lower 33 the row.
    number = F.monotonically_increasing_id()
    manifest = rows.select("doc_id", number.alias("n")).select(
        "doc_id",
        F.shiftright("n", 33).alias("task"),
        F.col("n").bitwiseAND((1 << 33) - 1).alias("ordinal"),
    )
    task = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    return (
        counts.withColumn("task", task)
        .join(manifest, ["task", "ordinal"])
        .select("doc_id", "file", "ordinal", "n_tokens")
    )
