"""Layouts, ranks of distances and quantiles by selection, against their definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions.quantiles import exact_quantiles
from weftline.operators import layout, vectors


def trustworthiness(x, y, k=10):
    n = len(x)
    far, near = 1 - x @ x.T, ((y[:, None] - y[None]) ** 2).sum(2)
    np.fill_diagonal(far, np.inf)
    np.fill_diagonal(near, np.inf)
    rank = np.argsort(np.argsort(far, 1, kind="stable"), 1) + 1
    over = np.take_along_axis(rank, np.argsort(near, 1, kind="stable")[:, :k], 1) - k
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * over[over > 0].sum()


def test_manifold_keeps_neighbours_better_than_a_linear_layout_and_repeats(spark, sf_dir):
    rows = vectors.unit_rows(vectors.table(spark, sf_dir, "embeddings"))
    x = np.array([r.v for r in rows.orderBy("id").collect()])
    at = lambda df: df.orderBy("id").toPandas()[["x", "y"]].to_numpy()
    plain, made = at(layout.linear_layout(rows)), at(layout.manifold_layout(rows, block=200))
    assert trustworthiness(x, made) > trustworthiness(x, plain) + 0.05
    few = rows.where("id < 120")
    one, two = (at(layout.manifold_layout(r, rounds=2, block=50)) for r in (few, few.orderBy(F.desc("id")).repartition(3)))
    assert np.allclose(one, two, atol=1e-6)


def test_fuzzy_edges_are_symmetric_and_sum_to_log_k(spark, sf_dir):
    rows = vectors.unit_rows(vectors.table(spark, sf_dir, "embeddings")).where("id < 100")
    near = vectors.neighbours(rows, 8)
    edges = {(r.src, r.dst): r.w for r in layout.fuzzy_edges(near).collect()}
    assert all(edges[b, a] == pytest.approx(w) and 0 < w <= 1 for (a, b), w in edges.items())
    far = {}
    for r in near.collect():
        far.setdefault(r.src, []).append((r["rank"], r.dst))
    assert all(edges[s, min(f)[1]] == pytest.approx(1) for s, f in far.items())


def mean_ranks(v):
    order = np.argsort(v, kind="stable")
    _, where, n = np.unique(v[order], return_inverse=True, return_counts=True)
    ends = np.cumsum(n)
    out = np.empty(len(v))
    out[order] = ((ends - n + 1 + ends) / 2)[where]
    return out


@pytest.mark.parametrize("shares", [16, 1 << 14])
def test_spearman_is_that_of_all_ranks(spark, sf_dir, shares):
    rows = [(i, 0, [float(np.cos(i % 7)), float(np.sin(i % 7)), 0.1 * (i % 5)]) for i in range(60)]
    frame = vectors.unit_rows(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"))
    v = np.array([r.v for r in frame.orderBy("id").collect()])
    unit, flat = v / np.linalg.norm(v, axis=1, keepdims=True), vectors.in_plane(v)
    i, j = np.triu_indices(60, 1)
    d1 = np.round(1 - (unit @ unit.T)[i, j], 8)
    d2 = np.round(np.sqrt(((flat[i] - flat[j]) ** 2).sum(1)), 8)
    want = np.corrcoef(mean_ranks(d1), mean_ranks(d2))[0, 1]
    got = layout.distance_spearman(frame, shares).first().spearman
    # A rank is off by half a bucket at most, and as often too low as too high.
    assert got == pytest.approx(want, abs=1e-6 if shares > 16 else 2 / shares**2)
    assert layout.distance_spearman(frame.where("id = 1")).first().spearman is None


def test_quantiles_of_hot_groups(spark):
    ps = (0.0, 0.25, 0.5, 0.9, 1.0)
    rng = np.random.default_rng(4)
    groups = {"hot": np.r_[rng.lognormal(0, 4, 9000), np.full(3000, 2.5), [1e300, -1e300]], "tie": np.full(4000, 7.0), "cold": rng.normal(size=301), None: np.arange(2000.0), "one": np.array([3.0])}
    rows = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v] + [("cold", None), ("empty", None)], "g string, v double")
    for limit in (700, 100_000):
        got = {r.g: r for r in exact_quantiles(rows, "g", "v", ps, limit).collect()}
        assert set(got) == set(groups)
        for g, v in groups.items():
            assert got[g].n == len(v) and got[g].q == pytest.approx(np.quantile(v, ps).tolist(), rel=1e-12)
    assert exact_quantiles(rows.limit(0), "g", "v", ps).count() == 0
