"""Document sources: ``DataFrame(collection, file, text)``, one row per document."""

from __future__ import annotations

import fnmatch
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.functions.text import clean, doc_name, strip_prefix

# Folders of a written collection, which are listed side by side.
FOLDERS = 64

# Text of small files that are read by one task.
READ_BYTES = 32 << 20

# Bytes of files that a task hands on at a time.
BATCH_BYTES = 8 << 20

# Folders that are listed by as many tasks, for each core.
LISTED_FOLDERS = 8

# What Spark replaces in the names of partition folders.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def _qualified(spark: SparkSession, path: str) -> str:
    """The absolute path with scheme and authority, as the file system itself names it."""
    context = spark.sparkContext
    given = context._jvm.org.apache.hadoop.fs.Path(path)
    system = given.getFileSystem(context._jsc.hadoopConfiguration())
    return system.makeQualified(given).toString()


def read_corpus(
    spark: SparkSession,
    root: str,
    collection: str | None = None,
    suffix: str = ".txt",
    prefix: str | None = None,
    source: str = "text",
) -> DataFrame:
    """Read a folder of folders, one row per file with its whole text.

    The first folder below ``root`` is the collection; with ``collection`` given
    only that folder is listed. ``file`` is the path below ``root``, or, with
    ``prefix`` given, the full path with that literal prefix removed. ``root`` may be
    relative, absolute or a URL; it is qualified by its file system and cut off at
    the start of each path only. A file found elsewhere is an error. ``source`` may be
    ``"binaryFile"``, which gives the same rows and, unlike ``"text"``, makes no copy of the
    configuration for each file. Below a local or mounted folder it also has the files listed
    by tasks, so the driver holds folders only; Spark's own listing holds every file there.
    """
    top = _qualified(spark, root).rstrip("/") + "/"
    local = _local(top) + (collection or "") if top.startswith("file:") else ""
    if source == "binaryFile" and os.path.isdir(local):
        return _read_local(spark, top, local, suffix, prefix)
    files = spark.read.format(source).load(
        top + (collection or ""),
        wholetext=True,
        pathGlobFilter="*" + suffix,
        recursiveFileLookup=True,
    )
    # A split takes few small files, so a folder of them is far more splits than its bytes need.
    size = int(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = spark.sparkContext.defaultParallelism
    files = files.coalesce(max(4 * cores, -(-size // READ_BYTES)))
    # The metadata column is URL-encoded; a plus sign in it stands for itself.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    # An empty authority may be written as three slashes or left out.
    plain = F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+(?=/)", "$1:")
    if not top.startswith("file:"):
        plain = path
    below = F.when(F.startswith(plain, F.lit(top)), F.substr(plain, F.lit(len(top) + 1))).otherwise(
        F.raise_error(F.concat(path, F.lit(f" does not lie below {top}")))
    )
    return files.select(
        F.split(below, "/", 2)[0].alias("collection"),
        (strip_prefix(path, prefix) if prefix else below).alias("file"),
        F.col("value" if source == "text" else "content").cast("string").alias("text"),
    ).where(F.instr(below, "/") > 0)


def _local(top: str) -> str:
    """The path of a ``file:`` URL of Hadoop, which encodes nothing."""
    return "/" + top.removeprefix("file:").lstrip("/")


def _hidden(name: str) -> bool:
    """Whether Spark passes over a file or folder of that name."""
    if name in ("_metadata", "_common_metadata"):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str, suffix: str) -> tuple[list[str], Iterator[str]]:
    """Folders in a folder, and the files in it whose names have the suffix."""
    folders = [e.path for e in os.scandir(folder) if not _hidden(e.name) and e.is_dir()]
    files = (
        e.path
        for e in os.scandir(folder)
        if not _hidden(e.name) and fnmatch.fnmatchcase(e.name, "*" + suffix) and not e.is_dir()
    )
    return folders, files


def _folders(root: str, wanted: int) -> list[tuple[str, bool]]:
    """``(folder, deep)``: folders to list, those with ``deep`` with all below them.

    Levels are opened until there are as many as wanted; only folders are held.
    """
    flat, deep = [], [root]
    while deep and len(deep) < wanted:
        below = [path for folder in deep for path in _entries(folder, "")[0]]
        flat, deep = flat + deep, below
    return [(folder, False) for folder in flat] + [(folder, True) for folder in deep]


def _list_files(suffix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folders, deep = batch.column("folder").to_pylist(), batch.column("deep").to_pylist()
            todo = list(zip(folders, deep, strict=True))
            paths: list[str] = []
            while todo:
                folder, below = todo.pop()
                inner, files = _entries(folder, suffix)
                todo += [(path, True) for path in inner] if below else []
                for path in files:
                    paths.append(path)
                    if len(paths) == 10_000:
                        yield pa.RecordBatch.from_pydict({"path": paths})
                        paths = []
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string())})

    return run


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(paths, contents):
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"]
        )

    paths: list[str] = []
    contents: list[bytes] = []
    size = 0
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open(path, "rb") as file:
                contents.append(file.read())
            paths.append(path)
            size += len(contents[-1])
            if size >= BATCH_BYTES or len(paths) == 1000:
                yield batch_of(paths, contents)
                paths, contents, size = [], [], 0
    yield batch_of(paths, contents)


def _read_local(
    spark: SparkSession, top: str, folder: str, suffix: str, prefix: str | None
) -> DataFrame:
    """The rows of :func:`read_corpus`, listed and read by tasks."""
    cores = spark.sparkContext.defaultParallelism
    found = _folders(folder.rstrip("/"), LISTED_FOLDERS * cores)
    folders = spark.createDataFrame(found, "folder string, deep boolean")
    tasks = max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = (
        folders.repartition(min(len(found), tasks), "folder")
        .mapInArrow(_list_files(suffix), "path string")
        .repartition(tasks, "path")
        .mapInArrow(_read_files, "path string, content binary")
    )
    below = F.substr("path", F.lit(len(_local(top)) + 1))
    path = F.concat(F.lit("file:"), F.col("path"))
    return files.select(
        F.split(below, "/", 2)[0].alias("collection"),
        (strip_prefix(path, prefix) if prefix else below).alias("file"),
        F.col("content").cast("string").alias("text"),
    ).where(F.instr(below, "/") > 0)


def _name(value) -> str:
    """A value as part of the name of a folder or file, as Spark writes it."""
    escaped = _ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", "" if value is None else str(value))
    return escaped or _NO_NAME


def _write_files(top: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(top)
        made: set[str] = set()
        rows = (
            row
            for batch in batches
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        )
        written = 0
        for (collection, file), texts in groupby(rows, key=lambda row: row[:2]):
            name = f"file={_name(file)}.txt"
            number = zlib.crc32(name.encode("utf-8", "surrogatepass")) % FOLDERS
            folder = f"{root}/collection={_name(collection)}/{number:02}"
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            # Another attempt of the task may write the same file.
            draft = f"{folder}/.{uuid.uuid4().hex}"
            with system.open_output_stream(draft) as out:
                for _, _, text in texts:
                    out.write(text)
                    out.write(b"\n")
            system.move(draft, f"{folder}/{name}")
            written += 1
        yield pa.RecordBatch.from_pydict({"files": [written]})

    return run


def write_corpus(docs: DataFrame, root: str) -> None:
    """Write ``(collection, file, text)`` as text files, one per document, below ``root``.

    A line end follows each text, and rows of one (collection, file) are one file. The path
    has a folder ``collection=...`` and goes on with ``file=...``, named as partitions are.
    Files of a local or mounted folder are written by the Python workers, as Hadoop's local
    file system starts processes for every file; other stores get Spark's own partitions.
    """
    rows = docs.select("collection", "file", F.col("text").cast("binary").alias("text"))
    rows = rows.repartition("collection", "file").sortWithinPartitions("collection", "file")
    top = _qualified(docs.sparkSession, root).rstrip("/")
    if not top.startswith("file:"):
        rows.withColumn("text", F.col("text").cast("string")).write.partitionBy(
            "collection", "file"
        ).text(root)
        return
    top = "file://" + top.removeprefix("file:").removeprefix("//")
    rows.mapInArrow(_write_files(top), "files long").agg(F.sum("files")).collect()


def corpus_from_table(table: DataFrame, collection: str, file: str, text: str) -> DataFrame:
    """Use a table as a corpus; ``file`` must be unique within a collection.

    A document is addressed by both, as a file is by its path, so a row without
    them is no document. A missing text is an empty one, as an empty file has.
    """
    return table.select(
        F.col(collection).alias("collection"),
        F.col(file).alias("file"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).where(F.col("collection").isNotNull() & F.col("file").isNotNull())


def spread(docs: DataFrame) -> DataFrame:
    """Hand the documents of a small scan out to every core.

    Spark cuts a scan into fewer splits than cores only where the input is below
    its open-cost floor (4 MB per core), so whatever is moved here is small, and
    a large corpus passes through without a shuffle. Call it on a plain scan.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() >= cores:
        return docs
    return docs.repartition(cores, "file")


def in_collection(frame: DataFrame, collection: str | None) -> DataFrame:
    """Rows of one collection; everything when none is named."""
    return frame if collection is None else frame.where(F.col("collection") == collection)


def clean_documents(
    docs: DataFrame,
    normalizer: str = "word_hyphen_strip_last",
    filename: Column | None = None,
) -> DataFrame:
    """Cleaned documents as ``(filename, content)``."""
    name = F.element_at(F.split(F.col("file").cast("string"), "/"), -1)
    return docs.select(
        (doc_name(F.col("collection"), name) if filename is None else filename).alias("filename"),
        clean(F.col("text"), normalizer).alias("content"),
    )
