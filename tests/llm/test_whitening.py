"""Whitened rows against numpy on the whole table, and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattframe.llm import queries as Q
from wattframe.llm import whitening

SF = "/root/testdata/sf0.001"
KINDS = "vec_id long, embedding array<float>, v int, row string"


def plain(vectors, most=32):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return centred @ axes / np.sqrt(values), values / np.trace(v), ((n * x - sums) ** 2).sum(axis=1)


def same(rows, ids, vectors, most=32):
    projected, explained, deviations = plain(vectors, most)
    k = len(explained)
    assert len(rows) == len(ids) * k
    found = {(r.vec_id, r.component): r for r in rows}
    got = np.array([[found[i, c + 1].whitened for c in range(k)] for i in ids])
    sign = np.sign((got * projected).sum(axis=0))
    assert np.abs(got * sign - projected).max() < 1e-9
    for place, i in enumerate(ids):
        for c in range(k):
            r = found[i, c + 1]
            assert r.n == len(ids) and r.deviation == deviations[place]
            assert abs(r.explained - explained[c]) <= 1e-4 * explained[c] and r.identity_error <= 1e-4


def test_whole_table_equals_numpy(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    same(Q.QUERIES["op13_whitening"](spark, SF).collect(), [r.vec_id for r in given], [r.embedding for r in given])


@pytest.mark.parametrize("values, columns", [(40, 3), (7, 2), (1 << 18, 1024)])
def test_blocks_of_any_shape_give_the_same(spark, monkeypatch, values, columns):
    chance = np.random.default_rng(5)
    vectors = chance.normal(size=(90, 7)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                                  "vec_id long, embedding array<float>").repartition(3)
    monkeypatch.setattr(whitening, "BLOCK_VALUES", values)
    monkeypatch.setattr(whitening, "MOST_COLUMNS", columns)
    monkeypatch.setattr(whitening, "BLOCKS_IN_TASK", 2)
    same(whitening.whitened(table).collect(), list(range(90)), vectors)


def test_odd_vectors_are_left_out_and_repeated_rows_count(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [1.0, 2.0]), (2, [3.0, -1.5]), (3, [0.25, 0.5]), (None, [2.0, 2.0]), (1, [1.0, 2.0])]
    odd = [(4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, [1.0, 2.0, 3.0]), (10, [3e38, 1.0])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in good + odd], KINDS)
    rows = whitening.whitened(table).collect()
    projected, explained, deviations = plain([v for _, v in good])
    assert sorted((r.component, r.deviation) for r in rows if r.vec_id == 1) == sorted(
        [(c, deviations[0]) for c in (1, 2)] * 2)
    assert sorted(abs(r.whitened) for r in rows if r.vec_id is None) == pytest.approx(sorted(abs(projected[3])))
    assert {r.vec_id for r in rows} == {1, 2, 3, None} and {r.n for r in rows} == {5}


def test_rows_without_variance_have_no_components(spark):
    table = spark.createDataFrame([(i, [1.0, 2.0], 1, "") for i in range(3)], KINDS)
    assert whitening.whitened(table).count() == 0
    assert whitening.whitened(table.limit(0)).count() == 0
    assert whitening.whitened(table.withColumn("embedding", F.lit(None).cast("array<float>"))).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], 1, "") for i in range(5)], KINDS)
    rows = whitening.whitened(line).collect()
    assert {r.component for r in rows} == {1} and rows[0].identity_error < 1e-9


def test_deviations_beyond_a_long_are_null(spark):
    big = float(1 << 36)
    rows = whitening.whitened(spark.createDataFrame([(1, [big, 0.0], 1, ""), (2, [-big, 1.0], 1, "")], KINDS)).collect()
    assert rows and all(r.deviation is None for r in rows)
