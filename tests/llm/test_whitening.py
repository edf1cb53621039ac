from __future__ import annotations

import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedquality.llm import whitening
from tests.llm.common import CLASHING

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=4):
    """From the definition, with the library's eigenvectors: key -> [(component, deviation, whitened, explained)]."""
    kept = [(k, [math.floor(256 * float(c)) for c in v]) for k, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = Counter(len(x) for _, x in kept)
    size = max(sizes, key=lambda s: (sizes[s], s), default=0)
    kept = [(k, x) for k, x in kept if len(x) == size]
    distinct = [list(x) for x in {tuple(x) for _, x in kept}]
    n = len(distinct)
    if n < 2:
        return 0, []
    sums = [sum(c) for c in zip(*distinct, strict=True)]
    mean = np.array(sums) / n
    centred = np.array(distinct) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    found = []
    for k, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for c in range(min(components, int((values > 1e-9 * values[0]).sum()))):
            w = (np.array(x) - mean) @ vectors[:, c] / math.sqrt(values[c])
            found.append((k, c + 1, deviation, w, values[c] / values.sum()))
    return n, found


def compare(got, rows):
    n, expected = brute(rows)
    assert len(got) == len(expected)
    assert all(r["n"] == n and r["identity_error"] < 1e-9 for r in got)
    # either sign, the same for all rows of a component
    got = [(r[0], r["component"], r["deviation"], r["whitened"], r["explained"]) for r in got]
    for c in {e[1] for e in expected}:
        def order(r):
            return (r[0] is not None, r[0] or 0, r[2])
        a = sorted((r for r in got if r[1] == c), key=order)
        b = sorted((r for r in expected if r[1] == c), key=order)
        assert [r[:3] for r in a] == [r[:3] for r in b]
        x, y = np.array([r[3] for r in a]), np.array([r[3] for r in b])
        assert min(np.abs(x - y).max(), np.abs(x + y).max()) < 1e-8
        assert np.allclose([r[4] for r in a], [r[4] for r in b], rtol=1e-9)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA).repartition(5).withColumns(
        {c: F.lit(7) for c in (*CLASHING, "x", "key", "component", "whitened", "sum")})


def vectors(n, size, seed, scale=None):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, size)) * (scale if scale is not None else np.linspace(2, 0.1, size)) @ rng.normal(size=(size, size))
    return [(i, v) for i, v in enumerate(mixed.astype(np.float32).astype(float).tolist())]


def test_query_against_the_definition(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    df = whitening.op12_whitening(spark, SF)
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(df.collect(), rows)


@pytest.mark.parametrize(("n", "size"), [(300, 9), (40, 2), (50, 1), (7, 12)])
def test_random_vectors(spark, n, size):
    rows = vectors(n, size, n)
    compare(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_awkward_rows(spark):
    good = vectors(30, 3, 1)
    rows = [*good, *good[:12], *[(99, good[4][1])] * 40, (None, good[5][1]), (None, None), (100, None), (101, []),
            (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 0.0]),
            (105, [1.0, 2.0]), (106, [1.0, 2.0, 3.0, 4.0]), (107, [-0.0, 0.0, -0.001])]
    got = whitening.whiten(frame(spark, rows)).collect()
    compare(got, rows)
    assert sum(r["vec_id"] == 99 for r in got) == 120


def test_too_large_for_the_grid_is_left_out(spark):
    rows = vectors(20, 3, 2)
    got = whitening.whiten(frame(spark, [*rows, (50, [1e30, 0.0, 0.0])])).collect()
    compare(got, rows)


def test_large_entries_are_exact_or_null(spark):
    rows = [(0, [70000.0, 1.0]), (1, [-90000.0, 2.0]), (2, [12345.0, 8.0])]
    compare(whitening.whiten(frame(spark, rows)).collect(), rows)
    rows = [(0, [3e10, 1.0]), (1, [-2e10, 2.0]), (2, [0.0, 8.0])]
    assert {r["deviation"] for r in whitening.whiten(frame(spark, rows)).collect()} == {None}


def test_nothing_varies(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 3):
        df = whitening.whiten(frame(spark, rows))
        assert df.collect() == [] and df.columns[0] == "vec_id"


def test_other_names_and_doubles(spark):
    rows = vectors(25, 4, 8)
    df = spark.createDataFrame([(str(k), v) for k, v in rows], "name string, v array<double>")
    got = whitening.whiten(df, vector="v", key="name", components=2).collect()
    assert len(got) == 50 and {r["component"] for r in got} == {1, 2} and {r["name"] for r in got} == {str(k) for k, _ in rows}


@pytest.mark.parametrize("size", [1, 2, 5, 33, 64])
def test_factor_and_rotation(size):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(size, 3 * size)) * np.geomspace(1, 1e-3, size)[:, None]
    a = a @ a.T
    factor = whitening.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a, rtol=1e-12, atol=1e-14 * a.max())
    # some order of its rows makes it triangular
    assert sorted((row != 0).sum() for row in factor) == list(range(1, size + 1))
    values, vectors_ = whitening.one_sided_jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-9)
    assert np.allclose(vectors_.T @ vectors_, np.eye(size), atol=1e-12)
    assert np.allclose(a @ vectors_, vectors_ * values, atol=1e-12 * values[0])


def test_missing_rank():
    rng = np.random.default_rng(1)
    b = rng.integers(-9, 9, size=(6, 3)).astype(float)
    factor = whitening.pivoted_cholesky(b @ b.T)
    assert factor.shape == (6, 3)
    assert np.allclose(factor @ factor.T, b @ b.T)
    assert whitening.pivoted_cholesky(np.zeros((4, 4))).shape == (4, 0)
