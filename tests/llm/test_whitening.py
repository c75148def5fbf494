"""Whitening against numpy over the whole table, and odd rows."""

import math

import numpy as np
import pytest

from termlode.llm import whitening
from termlode.llm.queries import op12_embedding_whitening

SF_DIR = "/root/testdata/sf0.001"


def expected(vectors):
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    y = x * n - sums
    centred = (y / n).astype(float)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:8]
    return (y**2).sum(axis=1), centred @ basis[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def rows_of(frame):
    found = {}
    for row in frame.collect():
        found.setdefault(row["vec_id"], {})[row["component"]] = row
    return found


def test_whole_table_against_numpy(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, white, explained = expected([row["embedding"] for row in table])
    found = rows_of(op12_embedding_whitening(spark, SF_DIR))
    assert len(found) == len(table)
    got = np.array([[found[row["vec_id"]][k]["whitened"] for k in range(1, 9)] for row in table])
    signs = np.sign((got * white).sum(axis=0))
    assert np.allclose(got * signs, white, atol=1e-9)
    for at, row in enumerate(table):
        for k, one in found[row["vec_id"]].items():
            assert one["n"] == len(table) and one["deviation"] == deviation[at]
            assert one["explained"] == pytest.approx(explained[k - 1], rel=1e-9)
            assert one["identity_error"] < 1e-9


def test_several_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 2)
    monkeypatch.setattr(whitening, "GROUP_BLOCKS", 2)
    vectors = np.random.default_rng(3).normal(size=(40, 5)).round(3).tolist()
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    _, white, _ = expected(vectors)
    found = rows_of(whitening.whiten(table.repartition(3)))
    got = np.array([[found[i][k]["whitened"] for k in range(1, 6)] for i in range(40)])
    assert np.allclose(got * np.sign((got * white).sum(axis=0)), white, atol=1e-9)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [0.0, 2.0]), (2, [0.0, 2.0]), (None, [3.0, 3.0]), (5, None), (6, []),
        (7, [1.0, None]), (8, [nan, 1.0]), (9, [1.0, -inf]), (10, [1.0]), (11, [1e300, 0.0]),
    ]
    schema = "vec_id long, embedding array<double>, index int, x int, n int, vector int"
    table = spark.createDataFrame([(*row, 1, 1, 1, 1) for row in rows], schema)
    found = whitening.whiten(table).collect()
    assert sorted(row["vec_id"] or 0 for row in found) == [0, 0, 1, 1, 2, 2, 2, 2]
    assert {row["n"] for row in found} == {4}
    assert max(row["identity_error"] for row in found) < 1e-9
    assert whitening.whiten(table.where("vec_id in (5, 7)")).count() == 0
    same = whitening.whiten(table.where("vec_id = 2")).collect()
    assert [(row["whitened"], row["explained"], row["deviation"]) for row in same] == [(None, None, 0)] * 4
    flat = table.where("vec_id = 1").union(table.where("vec_id = 10").selectExpr("vec_id", "array(2D, 0D)", "1", "1", "1", "1"))
    found = whitening.whiten(flat).collect()
    assert [row["whitened"] is None for row in sorted(found, key=lambda r: r["component"])] == [False, False, True, True]
