import numpy as np
import pytest

from millrace.operators import chartdata as C


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


@pytest.mark.parametrize("seed, n", [(1, 500), (2, 37), (3, 2)])
def test_histogram_equals_numpy(spark, seed, n):
    v = np.random.default_rng(seed).gamma(2.0, 100.0, n)
    counts, edges = np.histogram(v, bins="auto")
    got = C.histogram(frame(spark, v), "v").collect()
    assert [r["n"] for r in got] == counts.tolist()
    assert np.allclose([r["left_edge"] for r in got], edges[:-1]) and got[-1]["right_edge"] == pytest.approx(edges[-1])


def test_histogram_without_spread_or_quartile_range(spark):
    same = C.histogram(frame(spark, [5.0] * 9), "v").collect()
    assert [(r["left_edge"], r["right_edge"], r["n"]) for r in same] == [(4.5, 5.5, 9)]
    v = [1.0] * 50 + [2.0, 9.0]
    got = [r["n"] for r in C.histogram(frame(spark, v), "v").collect()]
    assert got == np.histogram(v, bins="auto")[0].tolist() and got[-1] == 1
    with pytest.raises(ValueError):
        C.histogram(frame(spark, []), "v")


def test_density_equals_direct_sum(spark):
    v = np.random.default_rng(4).normal(50, 9, 800)
    h = v.std(ddof=1) * len(v) ** -0.2
    got = C.density(frame(spark, v), "v", 50).collect()
    x = np.array([r["x"] for r in got])
    want = np.exp(-(((x[:, None] - v) / h) ** 2) / 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert np.allclose(x, np.linspace(v.min(), v.max(), 50))
    assert np.abs([r["density"] for r in got] - want).max() < 1e-12 * want.max()
    with pytest.raises(ValueError):
        C.density(frame(spark, [1.0, 1.0]), "v")


def test_density_of_a_heavy_tail_meets_few_points(spark):
    """Boxes far out meet the points in their reach only: not boxes x points."""
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.standard_cauchy(3000), [1e6, -1e6]])
    h = v.std(ddof=1) * len(v) ** -0.2
    got = C.density(frame(spark, v), "v", 400).collect()
    x = np.array([r["x"] for r in got])
    want = np.exp(-(((x[:, None] - v) / h) ** 2) / 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert np.abs([r["density"] for r in got] - want).max() < 1e-12 * want.max() and len(got) == 400
    plan = C.density(frame(spark, v), "v", 400)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(cast(greatest" in plan  # points per box are bounded by its reach


def test_box_summary(spark):
    data = [("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 5.0), (None, 1.0), ("b", float("nan"))]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: tuple(r)[1:] for r in C.box_summary(df, "g", "v").collect()}
    assert got == {
        "a": (5, 2.0, 3.0, 4.0, 1.0, 4.0, 1),
        "b": (1, 5.0, 5.0, 5.0, 5.0, 5.0, 0),
        None: (1, 1.0, 1.0, 1.0, 1.0, 1.0, 0),
    }


def test_grouped_bars(spark):
    df = spark.createDataFrame([("r", "x", 1.0), ("r", "y", 2.0), ("s", "x", 4.0), ("r", "x", 0.5)], "r string, c string, v double")
    assert [tuple(r)[:3] for r in C.grouped_bars(df, "r", "c", "v").collect()] == [("r", "x", 1.5), ("s", "x", 4.0), ("r", "y", 2.0)]
    assert [tuple(r) for r in C.grouped_bars_wide(df, "r", "c", "v").collect()] == [("r", 1.5, 2.0), ("s", 4.0, None)]
