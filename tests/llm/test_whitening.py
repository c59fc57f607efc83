"""Whitening against exact rational arithmetic and a plain eigendecomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest
from llm.conftest import SF

from lakemart.llm import whitening
from lakemart.llm.common import read
from lakemart.llm.queries import op13_whitening

VECTORS = "vec_id long, embedding array<float>"


def by_hand(rows):
    """x vectors of the usable rows, their exact covariance and deviations."""
    used = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows]
    n, d = len(used), len(used[0][1])
    sums = [sum(x[k] for _, x in used) for k in range(d)]
    centred = [[n * x[k] - sums[k] for k in range(d)] for _, x in used]
    cov = [[Fraction(sum(y[a] * y[b] for y in centred), n**3) for b in range(d)] for a in range(d)]
    return used, sums, np.array([[float(c) for c in row] for row in cov]), [sum(v * v for v in y) for y in centred]


def check(spark, rows, usable, components=8):
    df = spark.createDataFrame(rows, VECTORS).repartition(4).selectExpr("*", "'clash' AS x", "1 AS whitened")
    found = whitening.whiten(df, components).collect()
    used, sums, cov, deviations = by_hand(usable)
    n, k = len(used), min(components, len(sums))
    assert len(found) == n * k
    values, axes = np.linalg.eigh(cov)
    axes, values = axes[:, ::-1][:, :k], values[::-1][:k]
    want = {(i, c + 1): (w, dev) for (i, x), dev in zip(used, deviations) for c, w in enumerate((np.array(x) - np.array(sums) / n) @ axes / np.sqrt(values))}
    signs = {}
    for r in found:
        w, dev = want[r["vec_id"], r["component"]]
        assert r["n"] == n and r["deviation"] == dev
        assert abs(abs(r["whitened"]) - abs(w)) < 1e-6
        if abs(w) > 1e-3:
            signs.setdefault(r["component"], set()).add(math.copysign(1, w * r["whitened"]))
        assert abs(r["explained"] - values[r["component"] - 1] / cov.trace()) < 1e-9
        assert r["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def vectors(seed, n, d=10, scale=0.2):
    made = np.random.default_rng(seed).normal(size=(n, d)) * np.linspace(1, 3, d) * scale
    return [(i, [float(c) for c in row]) for i, row in enumerate(made)]


def test_against_exact_arithmetic(spark):
    rows = vectors(1, 300)
    check(spark, rows, rows)
    check(spark, rows, rows, components=3)


def test_few_dimensions_and_far_from_zero(spark):
    rows = [(i, [c + 5000 for c in v]) for i, v in vectors(2, 80, d=3)]
    check(spark, rows, rows)


def test_awkward_rows(spark):
    good = vectors(3, 60, d=4)
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0]), (903, [float("nan")] * 4), (904, [float("-inf"), 0.0, 0.0, 0.0]), (905, [1.0])]
    check(spark, good + bad, good)
    repeated = whitening.whiten(spark.createDataFrame(good + good[:5] + [(None, good[0][1])], VECTORS))
    assert repeated.count() == 66 * 4 and repeated.where("vec_id IS NULL").count() == 4
    assert repeated.first()["n"] == 66


def test_empty_and_without_variance(spark):
    empty = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert empty.count() == 0 and empty.columns[0] == "vec_id"
    assert whitening.whiten(spark.createDataFrame([(1, None)], VECTORS)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], VECTORS)).collect()
    assert len(same) == 10 and all(r["whitened"] is None and r["deviation"] == 0 for r in same)
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0]) for i in range(5)], VECTORS)).collect()
    assert {(r["component"], r["whitened"] is None) for r in flat} == {(1, False), (2, True)}


def test_sums_beyond_64_bits(spark):
    rows = [(i, [float(2**40 * (i % 7 + 1)), float(2**38 * (i % 5))]) for i in range(40)]
    df = whitening.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    model = whitening.fit(df)
    used = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(x[k] for x in used) for k in (0, 1)]
    found = {r["vec_id"]: int(r["deviation"]) for r in whitening.project(df, model).collect()}
    want = {i: sum((40 * x[k] - sums[k]) ** 2 for k in (0, 1)) for i, x in enumerate(used)}
    assert found == want
    trace = Fraction(sum(want.values()), 40**3)
    assert model.trace == pytest.approx(float(trace), rel=1e-14)


def test_too_large_entries_raise(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(df).collect()


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read(spark, SF, "embeddings").collect()]
    found = op13_whitening(spark, SF)
    assert found.count() == 8 * len(rows)
    assert found.first()["identity_error"] < 1e-4
    used, _, cov, deviations = by_hand(rows)
    assert {r["vec_id"]: r["deviation"] for r in found.collect()} == {i: d for (i, _), d in zip(used, deviations)}
    top = np.sort(np.linalg.eigvalsh(cov))[::-1][:8] / cov.trace()
    assert [r[0] for r in found.select("explained", "component").distinct().orderBy("component").collect()] == pytest.approx(list(top))
