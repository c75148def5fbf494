import os

import pytest
from pyspark.sql import functions as F

import termlode as tl
from helpers import CORPUS, make_docs, plan, rows
from termlode.sources import store


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "my corpus"
    for path, _, text in CORPUS:
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(text, encoding="utf-8")
    (root / "c1" / "notes.md").write_text("skip me")
    (root / "top.txt").write_text("in no collection")
    return root


def test_whole_files_are_read(spark, folder):
    found = tl.read_corpus(spark, str(folder))
    assert rows(found, "file", "collection", "text") == sorted(CORPUS, key=repr)


def test_one_folder_is_read(spark, folder):
    found = tl.read_corpus(spark, f"{folder}/", collection="c2")
    assert rows(found, "collection", "file") == [("c2", "c2/001.txt")]


def test_prefix_and_suffix_and_odd_names(spark, folder):
    (folder / "c2" / "a+b c.md").write_text("odd")
    found = tl.read_corpus(
        spark, str(folder), collection="c2", suffix=".md", prefix=f"file:{folder}/"
    )
    assert rows(found) == [("c2", "c2/a+b c.md", "odd")]


def test_index_of_files_equals_index_of_rows(spark, folder, index, tmp_path):
    path = str(tmp_path / "index")
    tl.index_corpus(tl.spread(tl.read_corpus(spark, str(folder))), path)
    assert rows(tl.load_index(spark, path)) == rows(index)


def test_existing_index_is_not_overwritten(spark, index, tmp_path):
    path = str(tmp_path / "index")
    tl.write_index(index, path)
    with pytest.raises(ValueError, match="already in"):
        tl.write_index(index, path)
    with pytest.raises(ValueError, match="neither"):
        tl.write_index(index, path, mode="append")
    whole = tl.warm(tl.load_index(spark, path))
    in_c1 = tl.warm(tl.load_index(spark, path, "c1"))
    tl.write_index(index.where("word = 'dog' AND collection = 'c1'"), path, mode="overwrite")
    assert tl.warm(tl.load_index(spark, path)) == whole - in_c1 + 4


def test_collections_built_one_by_one_equal_one_build(spark, docs, index, tmp_path):
    path = str(tmp_path / "index")
    for name in ("c1", "c2"):
        tl.index_corpus(tl.in_collection(docs, name), path)
    assert rows(tl.load_index(spark, path)) == rows(index)
    with pytest.raises(ValueError, match="already in"):
        tl.index_corpus(tl.in_collection(docs, "c2"), path)
    tl.index_corpus(tl.in_collection(docs, "c2"), path, mode="overwrite")
    assert rows(tl.load_index(spark, path)) == rows(index)
    assert tl.stored_collections(spark, path) == {"c1", "c2"}


def test_a_collection_needs_a_name(index, tmp_path):
    with pytest.raises(ValueError, match="without a name"):
        tl.write_index(index.withColumn("collection", F.lit("")), str(tmp_path / "index"))


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}", "{}/"])
def test_forms_of_a_root(spark, folder, form):
    found = tl.read_corpus(spark, form.format(folder))
    assert rows(found, "file", "collection", "text") == sorted(CORPUS, key=repr)


def test_relative_root_whose_name_comes_twice(spark, tmp_path, monkeypatch):
    root = tmp_path / "corpus" / "old" / "corpus"
    for collection in ("a1", "b1"):
        (root / collection).mkdir(parents=True)
        (root / collection / "x.txt").write_text(collection)
    user_dir = spark._jvm.java.lang.System.getProperty("user.dir")
    relative = os.path.relpath(root, user_dir)
    for given in (str(root), relative):
        found = tl.read_corpus(spark, given)
        assert rows(found) == [("a1", "a1/x.txt", "a1"), ("b1", "b1/x.txt", "b1")]
    assert rows(tl.read_corpus(spark, relative, collection="b1"), "file") == [("b1/x.txt",)]


def test_norms_cover_every_document(spark, tmp_path):
    texts = [("a", "c", "red dog"), ("b", "c", "& !"), ("d", "c", "red")]
    docs = make_docs(spark, texts)
    path, norms_path, vocab_path = (str(tmp_path / x) for x in ("index", "norms", "vocab"))
    for mode in ("errorifexists", "overwrite"):
        tl.index_corpus(docs, path, mode, norms_path, vocab_path, drop_empty=True)
    index, norms = tl.load_index(spark, path), tl.load_norms(spark, norms_path)
    vocab = tl.load_vocabulary(spark, vocab_path)
    assert rows(vocab, "word", "df") == [("dog", 1), ("red", 2)]
    assert rows(norms, "file") == [("a",), ("b",), ("d",)]
    found = tl.cosine(index, "red dog", norms=norms, vocab=vocab)
    scores = dict(rows(found, "file", "score"))
    assert scores["b"] is None and scores["a"] > 0
    scans = [line for line in plan(found).splitlines() if "FileScan orc" in line]
    assert scans and all("In(word" in line for line in scans)


def test_files_hold_ranges_of_words(spark, real_docs, real_index, tmp_path):
    path = str(tmp_path / "index")
    tl.index_corpus(real_docs, path, file_rows=2000)
    index = tl.load_index(spark, path, file_type="bigint")
    assert rows(index) == rows(real_index)
    files = [
        (row["collection"], row["lo"].encode(), row["hi"].encode(), row["n"])
        for row in spark.read.orc(path)
        .groupBy("collection", F.input_file_name().alias("f"))
        .agg(F.min("word").alias("lo"), F.max("word").alias("hi"), F.count("*").alias("n"))
        .collect()
    ]
    assert len(files) > 10 and max(n for *_, n in files) < 4000
    for one, other in zip(sorted(files), sorted(files)[1:], strict=False):
        assert one[0] != other[0] or one[2] <= other[1]
    holding = spark.read.orc(path).where("word = 'Ende' OR word = 'the'").select(F.input_file_name())
    reached = [f for f in files if f[1] <= b"the" <= f[2]]
    assert holding.distinct().count() <= len(reached) <= 8


def test_search_on_the_store_prunes_and_pushes_down(spark, real_index, tmp_path):
    path = str(tmp_path / "index")
    tl.write_index(real_index, path)
    stored = tl.load_index(spark, path, collection="en", file_type="bigint")
    searched = tl.search(stored, "the of", 5)
    assert rows(searched) == rows(tl.search(real_index, "the of", 5, collection="en"))
    text = plan(searched)
    assert "In(word, [of,the])" in text
    assert "collection" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "TakeOrderedAndProject" in text and "Join" not in text
    assert "idf:double,tf_idf" not in text


def test_numeric_looking_collections_stay_text(spark, tmp_path):
    path = str(tmp_path / "index")
    frame = spark.createDataFrame([("007", "w", "f", 1.0, 2.0)], list(store.INDEX_COLUMNS))
    tl.write_index(frame, path)
    assert rows(tl.load_index(spark, path)) == [("007", "w", "f", 1.0, 2.0)]


def test_cached_index_is_filled_by_warming(spark, index, tmp_path):
    path = str(tmp_path / "index")
    tl.write_index(index, path)
    cached = tl.load_index(spark, path, cache=True)
    assert cached.is_cached
    assert tl.warm(cached) == index.count()
    assert "InMemoryTableScan" in plan(tl.search(cached, "dog"))
    cached.unpersist()


def test_files_are_sorted_by_word(spark, real_docs, tmp_path):
    path = str(tmp_path / "index")
    tl.index_corpus(real_docs, path)
    words = spark.read.orc(path).select(
        F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "word"
    )
    by_file: dict = {}
    for row in sorted(words.collect(), key=lambda r: (r.f, r.i)):
        by_file.setdefault(row.f, []).append(row.word.encode())
    assert all(found == sorted(found) for found in by_file.values())


def test_clean_documents(spark, docs, tmp_path):
    path = str(tmp_path / "clean")
    tl.write_clean(tl.clean_documents(docs), path)
    found = dict(rows(tl.load_clean(spark, path)))
    assert found["c1-003"] == "red_foxs dog - cat cat x"
    assert len(found) == len(CORPUS)


def test_scratch_paths_are_in_the_shared_folder(spark, tmp_path):
    own = tl.scratch_path(spark, "x")
    assert own != tl.scratch_path(spark, "x")

    class Session:
        class conf:
            get = staticmethod(lambda key, default: f"{tmp_path}/")

    assert tl.scratch_path(Session, "x").startswith(f"{tmp_path}/x-")


def test_cluster_sessions_need_a_shared_folder(tmp_path):
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="shared folder"):
        tl.scratch_path(Session, "x")
    Session.sparkContext.master = "local-cluster[3,2,1024]"
    with pytest.raises(ValueError, match="shared folder"):
        tl.scratch_path(Session, "x")
    assert tl.scratch_path(Session, "x", scratch=str(tmp_path)).startswith(str(tmp_path))
    Session.sparkContext.getCheckpointDir = staticmethod(lambda: "hdfs:///checkpoints")
    assert tl.scratch_path(Session, "x").startswith("hdfs:///checkpoints/x-")


def test_scratch_paths_can_be_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "_made", [])
    path = tl.scratch_path(spark, "x", scratch=str(tmp_path))
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    assert tl.delete_scratch(spark) == 1
    assert not os.path.exists(path)


def test_rows_without_a_key_are_no_documents(spark):
    table = spark.createDataFrame(
        [("c", 1, "a"), (None, 2, "b"), ("c", None, "d")], "k string, id long, t string"
    )
    assert rows(tl.corpus_from_table(table, "k", "id", "t")) == [("c", 1, "a")]
    empty = spark.createDataFrame([("c", 1, None)], "k string, id long, t string")
    assert rows(tl.corpus_from_table(empty, "k", "id", "t")) == [("c", 1, "")]


def test_spread_moves_small_scans_only(spark, real_docs, tmp_path):
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("lang").alias("collection"), F.col("doc_id").alias("file"), "text"
    )
    assert "Exchange" in plan(tl.spread(small))
    many = str(tmp_path / "many")
    real_docs.repartition(40).write.parquet(many)
    with_many = spark.read.option("maxPartitionBytes", "1k").parquet(many)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert "Exchange" not in plan(tl.spread(with_many.select("collection", "file", "text")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_search_opens_the_files_of_its_words_only(spark, real_docs, real_index, tmp_path):
    path, vocab_path = str(tmp_path / "index"), str(tmp_path / "vocab")
    tl.index_corpus(real_docs, path, vocab_path=vocab_path, file_rows=1000)
    every = sorted((tmp_path / "index").rglob("part-*.orc"))
    words = ["the", "ention", "nosuchword"]
    for collection in (None, "en"):
        numbers = store.word_files(spark, vocab_path, words, collection)
        holding = {f for f in every if int(f.name.split("-")[1]) in numbers}
        assert 0 < len(holding) < len(every) / 2
        found = tl.load_words(spark, path, vocab_path, words, collection, "bigint")
        assert rows(found) == rows(tl.in_collection(real_index, collection).where(F.col("word").isin(words)))
    numbers = store.word_files(spark, vocab_path, words)
    for file in every:
        if int(file.name.split("-")[1]) not in numbers:
            file.write_bytes(b"no footer that could be read")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    found = tl.load_words(spark, path, vocab_path, words, file_type="bigint")
    assert rows(tl.search(found, "the ention nosuchword", 5)) == rows(
        tl.search(real_index, "the ention nosuchword", 5)
    )
    assert tl.load_words(spark, path, vocab_path, ["nosuchword"]).count() == 0


def test_many_files_are_not_looked_up(spark, docs, index, tmp_path, monkeypatch):
    path, vocab_path = str(tmp_path / "index"), str(tmp_path / "vocab")
    tl.index_corpus(docs, path, vocab_path=vocab_path, file_rows=1)
    monkeypatch.setattr(store, "MOST_RANGES", 1)
    assert store.word_files(spark, vocab_path, ["dog"]) is None
    found = tl.load_words(spark, path, vocab_path, ["dog"])
    assert rows(found) == rows(index.where("word = 'dog'"))


def test_corpus_files_are_one_a_document(spark, tmp_path):
    """Odd names, repeated rows, empty texts and several folders come back as they were."""
    given = [("a b", 1, "one\ntwo"), ("a b", 2, ""), ("c%d", 3, "drei é"), ("", 4, "x"), ("a b", 5, "y"), ("a b", 5, "y")]
    docs = spark.createDataFrame(given, "collection string, file long, text string")
    tl.write_corpus(docs, str(tmp_path / "files"))
    written = sorted((tmp_path / "files").rglob("*.txt"))
    assert len(written) == 5 and not [p for p in (tmp_path / "files").rglob(".*")]
    found = tl.read_corpus(spark, str(tmp_path / "files"), source="binaryFile")
    number = F.regexp_extract("file", r"/file=(\d+)[/.]", 1).cast("long")
    assert rows(found.select("collection", number, "text")) == sorted(
        [
            ("collection=a b", 1, "one\ntwo\n"),
            ("collection=a b", 2, "\n"),
            ("collection=a b", 5, "y\ny\n"),
            ("collection=c%25d", 3, "drei é\n"),
            ("collection=__HIVE_DEFAULT_PARTITION__", 4, "x\n"),
        ],
        key=repr,
    )


def test_small_files_are_read_by_few_tasks(spark, tmp_path):
    (tmp_path / "c").mkdir()
    for i in range(2000):
        (tmp_path / "c" / f"{i}.txt").write_text("some words")
    for source in ("text", "binaryFile"):
        found = tl.read_corpus(spark, str(tmp_path), source=source)
        assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert found.where("text = 'some words'").count() == 2000


def test_local_files_are_listed_by_tasks(spark, tmp_path):
    """The driver holds no file; the rows are those of the reader by text."""
    names = ("a/1.txt", "a/b/c/2 +%20.txt", "a/_no.txt", "a/.no.txt", "a/_x=1/3.txt", "a/n.md", "top.txt", "d/é.txt")
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    for given in ({}, {"collection": "a"}, {"suffix": ".md"}, {"prefix": f"file:{tmp_path}/"}):
        found = tl.read_corpus(spark, str(tmp_path), source="binaryFile", **given)
        assert "FileScan" not in plan(found) and not found.inputFiles()
        assert rows(found) == rows(tl.read_corpus(spark, str(tmp_path), **given))
    assert len(rows(tl.read_corpus(spark, str(tmp_path), source="binaryFile"))) == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tl.read_corpus(spark, str(tmp_path / "none"), source="binaryFile")
