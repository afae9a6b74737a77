"""Whitening against plain covariance and eigenvectors."""

import math

import numpy as np
import pytest

from newsloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, most=8):
    """{(vec_id, component): (n, deviation, whitened up to sign, explained)} and the number of usable rows."""
    good = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    sums = [sum(row[k] for row in x) for k in range(d)]
    centred = np.array([[(n * row[k] - sums[k]) / n for k in range(d)] for row in x])
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)
    out = []
    for (i, _), row, c in zip(good, x, centred, strict=True):
        deviation = sum((n * row[k] - sums[k]) ** 2 for k in range(d))
        for k, at in enumerate(order[:most]):
            out.append((i, k + 1, n, deviation, float(c @ vectors[:, at] / math.sqrt(e[at])), float(e[at] / e.sum())))
    return out


def matches(found, expected):
    assert len(found) == len(expected)
    key = lambda r: (r[0] is not None, r[0], r[1], r[3], abs(r[4]))
    signs = {}
    for f, x in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert tuple(f[:4]) == x[:4]
        assert abs(abs(f[4]) - abs(x[4])) < 1e-6 and abs(f[5] - x[5]) < 1e-9 and f[6] < 1e-9
        if abs(x[4]) > 1e-6:
            signs.setdefault(f[1], set()).add(f[4] * x[4] > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    matches(whitening.whitened(table).collect(), plain(table.select("vec_id", "embedding").collect()))


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [4, 1, 1e-1, 3, 2]], 1) for i in range(60)]
    rows += [rows[3]] * 40 + [(None, rows[4][1], None), (7, None, 1), (8, [1.0, None, 2.0, 3.0, 4.0], 1), (9, [float("nan")] * 5, 1),
                             (10, [1.0, float("inf"), 0.0, 0.0, 0.0], 2)]
    return rows


def test_odd_rows(spark, odd):
    for n, columns in ((1, []), (7, ["'own' AS x", "'own' AS ids", "'own' AS n", "'own' AS v", "'own' AS part"])):
        table = spark.createDataFrame(odd, SCHEMA).repartition(n).selectExpr("*", *columns)
        matches(whitening.whitened(table).collect(), plain(odd))


def test_other_lengths_and_huge_entries_are_left_out(spark, odd):
    more = [*odd, (70, [], 1), (71, [1.0], 1), (72, [1e30, 0.0, 0.0, 0.0, 0.0], 1)]
    matches(whitening.whitened(spark.createDataFrame(more, SCHEMA)).collect(), plain(odd))


def test_dependent_columns_have_no_component(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-5, 5, (80, 2)) / 8
    rows = [(i, [float(a), float(b), float(a + b), 1.0], 0) for i, (a, b) in enumerate(base)]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    matches(found, plain(rows, 2))


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(k, [3.0, 4.0], 0) for k in range(9)], [(1, None, 0)]])
def test_no_variance_gives_no_rows(spark, rows):
    assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_many_parts_are_added_in_steps(spark, odd):
    table = spark.createDataFrame(odd, SCHEMA).repartition(40)
    made, dims = whitening.blocks(table, "vec_id", "embedding")
    n, sums, largest = whitening.totals(made)
    centre = whitening.Centre(n, sums, largest)
    gram = whitening.added(made.repartition(40), lambda x: centre.rows(x).T @ centre.rows(x), (dims, dims))
    factor = whitening.factored(made, centre)
    assert np.allclose(factor.T @ factor, gram, rtol=1e-12)


def test_wide_sums_stay_exact():
    x = np.array([[1 << 50, 3], [-(1 << 50), 4], [5, 5]])
    sums = [int(v) for v in x.sum(axis=0)]
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    small = whitening.Centre(3, sums, 1 << 50).deviations(x.tobytes())
    assert small == [v if v < 1 << 63 else None for v in exact]
    wide = whitening.Centre(3 << 20, [s << 20 for s in sums], 1 << 50)
    assert not wide.narrow and np.allclose(wide.rows(x.tobytes()), x - np.array(sums) / 3)
