"""Documents added bit by bit weigh as those of one build."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import termlode as tl
from helpers import make_docs, plan, rows
from termlode.plans import growing


@pytest.fixture
def three_parts(real_docs):
    return [real_docs.where(F.col("file") % 3 == i) for i in range(3)]


def test_three_additions_equal_one_build(spark, real_docs, real_index, three_parts, tmp_path):
    path = str(tmp_path / "store")
    for part in three_parts:
        tl.add_documents(part, path)
    found = tl.load_growing(spark, path, file_type="bigint")
    assert rows(found) == rows(real_index)
    whole = tl.vocabulary(real_docs)
    columns = ("collection", "word", "df", "cf", "n_docs", "idf")
    assert rows(tl.growing_vocabulary(spark, path), *columns) == rows(whole, *columns)
    assert tl.documents_added(spark, path, "bigint").count() == real_docs.count()
    query = "the ention of onthe and"
    words = tl.query_words(query)
    some = tl.load_growing(spark, path, "en", words, file_type="bigint")
    assert rows(tl.search(some, query, 5)) == rows(tl.search(real_index, query, 5, "en"))


def test_an_addition_writes_new_files_only(spark, three_parts, tmp_path):
    path = tmp_path / "store"
    tl.add_documents(three_parts[0], str(path))
    before = {file: file.stat().st_mtime_ns for file in path.rglob("part-*")}
    name = tl.add_documents(three_parts[1], str(path))
    after = {file: file.stat().st_mtime_ns for file in path.rglob("part-*")}
    assert before.items() <= after.items()
    assert all(f"addition={name}" in str(file) for file in after.keys() - before.keys())


def test_repeated_documents_and_nameless_collections_are_refused(spark, tmp_path):
    path = str(tmp_path / "store")
    one = make_docs(spark, [("a", "c1", "red dog"), ("b", "c1", "")])
    tl.add_documents(one, path)
    with pytest.raises(ValueError, match="already in"):
        tl.add_documents(make_docs(spark, [("c", "c1", "x"), ("a", "c1", "y")]), path)
    with pytest.raises(ValueError, match="already in"):
        tl.add_documents(make_docs(spark, [("d", "c1", "x"), ("d", "c1", "x")]), path)
    with pytest.raises(ValueError, match="without a name"):
        tl.add_documents(make_docs(spark, [("d", None, "x")]), path)
    tl.add_documents(make_docs(spark, [("a", "c2", "red"), ("e", "c1", None)]), path)
    assert len(tl.additions(spark, path)) == 2
    assert rows(tl.growing_vocabulary(spark, path, "c1", ["red"]), "df", "n_docs") == [(1, 3)]


def test_a_broken_addition_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    tl.add_documents(make_docs(spark, [("a", "c1", "red dog"), ("b", "c1", "blue")]), path)
    before = rows(tl.load_growing(spark, path))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(growing, "frequencies", fail)
        with pytest.raises(RuntimeError):
            tl.add_documents(make_docs(spark, [("c", "c1", "red")]), path)
    assert rows(tl.load_growing(spark, path)) == before
    tl.add_documents(make_docs(spark, [("c", "c1", "red")]), path)
    assert len(tl.documents_added(spark, path).collect()) == 3


@pytest.mark.parametrize("options", [{}, {"normalizer": "punct_lines", "tf": "raw"}, {"drop_empty": True}])
def test_norms_follow_each_addition(spark, tmp_path, options):
    path = str(tmp_path / "store")
    texts = ["red dog red", "blue cat", "", "green green bird", "red fish", "every one of them", None]
    added = []
    for i, text in enumerate(texts):
        added.append((f"{i}", "c1" if i % 3 else "c2", text))
        tl.add_documents(make_docs(spark, added[-1:]), path, **options)
        if i not in (0, 4, 6):
            continue
        docs = make_docs(spark, added)
        whole = docs.select("collection", "file").join(
            tl.doc_norms(tl.build_index(docs, **options)), ["collection", "file"], "left"
        ).fillna(0.0)
        assert rows(tl.growing_norms(spark, path)) == rows(whole)
    index, query = tl.load_growing(spark, path), "red dog"
    norms, vocab = tl.growing_norms(spark, path), tl.growing_vocabulary(spark, path)
    assert rows(tl.cosine(index, query, norms=norms, vocab=vocab)) == rows(
        tl.cosine(tl.build_index(make_docs(spark, added), **options), query, norms=norms)
    )


def test_only_documents_with_words_of_the_addition_are_summed_anew(spark, tmp_path):
    path = str(tmp_path / "store")
    tl.add_documents(make_docs(spark, [(f"{i}", "c", f"word{i} dog{i % 2}") for i in range(10)]), path)
    assert growing.update_norm_parts(spark, path)[1] == 0
    tl.add_documents(make_docs(spark, [("new", "c", "dog1 other")]), path)
    assert growing.update_norm_parts(spark, path)[1] == 5
    assert growing.update_norm_parts(spark, path)[1] == 0


def test_an_addition_splits_its_texts_once(spark, tmp_path, monkeypatch):
    """Ranges of words are cut after a look at the entries, which must not read the texts again."""
    (tmp_path / "corpus" / "c").mkdir(parents=True)
    for i in range(3):
        (tmp_path / "corpus" / "c" / f"{i}.txt").write_text(f"red dog {i}")
    split = []

    def watched(name):
        written = getattr(DataFrameWriter, name)

        def write(self, path, *rest, **options):
            text = plan(self._df)
            split.append("FileScan text" in text and "Generate" in text)
            return written(self, path, *rest, **options)

        monkeypatch.setattr(DataFrameWriter, name, write)

    watched("parquet")
    watched("orc")
    tl.add_documents(tl.read_corpus(spark, str(tmp_path / "corpus")), str(tmp_path / "store"))
    assert sum(split) == 1
    found = tl.load_growing(spark, str(tmp_path / "store"))
    assert found.count() == 9
