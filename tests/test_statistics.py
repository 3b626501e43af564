import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import distributions as D
from millrace.operators import correlation as C
from millrace.operators import statistics as S


def test_published_p_values():
    # Published statistics, degrees of freedom and probabilities.
    assert D.t_two_sided(0.6486, 239178 + 115354 - 2) == pytest.approx(0.51662, abs=1e-4)
    assert D.chi2_upper(74.9093, 49) == pytest.approx(0.010021, abs=1e-5)


@pytest.mark.parametrize("t, df, p", [(0.0, 5, 1.0), (2.570582, 5, 0.05), (1.959964, 1e9, 0.05), (12.7062, 1, 0.05)])
def test_t_table(t, df, p):
    assert D.t_two_sided(t, df) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("x, dof, p", [(3.841459, 1, 0.05), (18.307038, 10, 0.05), (0.0, 3, 1.0), (5.0, 0, 1.0), (124.342113, 100, 0.05)])
def test_chi2_table(x, dof, p):
    assert D.chi2_upper(x, dof) == pytest.approx(p, abs=1e-7)


def test_pooled_t(rows):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0]
    df = rows("g string, v double", [("a", v) for v in a] + [("b", v) for v in b] + [("c", 99.0), ("a", float("nan"))])
    r = S.ttest(df, "g", "a", "b", "v").first()
    pooled = (np.var(a, ddof=1) * 3 + np.var(b, ddof=1) * 2) / 5
    want = (np.mean(a) - np.mean(b)) / math.sqrt(pooled * (1 / 4 + 1 / 3))
    assert (r["n_a"], r["n_b"], r["dof"]) == (4, 3, 5) and r["t_stat"] == pytest.approx(want)
    assert 0 < r["p_value"] < 1


def test_t_special_cases(rows):
    df = rows("g string, v double", [("a", 1.0), ("b", 1.0), ("b", 3.0), ("c", 2.0), ("d", 2.0), ("d", 2.0), ("e", 2.0), ("e", 2.0)])
    assert S.ttest(df, "g", "a", "b", "v").first()["dof"] == 1
    assert S.ttest(df, "g", "a", "c", "v").first()["t_stat"] is None  # no freedom
    assert S.ttest(df, "g", "d", "e", "v").first()["p_value"] is None  # no spread
    same = rows("g string, v double", [("a", 1.0), ("a", 3.0), ("b", 1.0), ("b", 3.0)])
    assert tuple(S.ttest(same, "g", "a", "b", "v").first())[6:] == (0.0, 2, 1.0)
    with pytest.raises(ValueError):
        S.ttest(df, "g", "a", "zzz", "v")


def table(spark, counts):
    data = [(f"r{i}", f"c{j}", int(n)) for i, row in enumerate(counts) for j, n in enumerate(row)]
    df = spark.createDataFrame(data, "a string, b string, k int")
    return df.where("k > 0").select("a", "b", F.explode(F.sequence(F.lit(1), "k")))


def direct(counts, yates):
    o = np.array(counts, float)
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    d = np.abs(o - e)
    return ((d - (np.minimum(0.5, d) if yates else 0)) ** 2 / e).sum()


@pytest.mark.parametrize("counts", [[[10, 20], [30, 5]], [[8, 0], [3, 4]], [[5, 5], [5, 5]], [[3, 0], [0, 4]],
                                    [[5, 0, 7], [1, 9, 2], [0, 3, 3]], [[1, 2, 3]], [[4], [6]]])
def test_chi_square(spark, counts):
    r = S.chi2_test(table(spark, counts), "a", "b").first()
    rows_, cols = len(counts), len(counts[0])
    dof = (rows_ - 1) * (cols - 1)
    assert (r["dof"], r["n"]) == (dof, np.sum(counts))
    assert r["chi2"] == pytest.approx(0.0 if dof == 0 else direct(counts, dof == 1), abs=1e-9)
    if dof == 0:
        assert r["p_value"] == 1.0


def test_null_categories_are_left_out(rows):
    df = rows("a string, b string", [("x", "u"), ("x", "v"), ("y", "u"), ("y", "v"), (None, "u"), ("x", None)])
    assert S.chi2_test(df, "a", "b").first()["n"] == 4
    with pytest.raises(ValueError):
        S.chi2_test(df.where("a is null"), "a", "b")


def test_cramers_v_bounds(spark):
    perfect = S.cramers_v(table(spark, [[9, 0, 0], [0, 9, 0], [0, 0, 9]]), "a", "b").first()["cramers_v"]
    none = S.cramers_v(table(spark, [[4, 4, 4], [2, 2, 2]]), "a", "b").first()["cramers_v"]
    assert perfect == pytest.approx(1.0) and none == pytest.approx(0.0, abs=1e-7)


def test_verdict(rows):
    df = rows("p double", [(0.049,), (0.05,), (None,)])
    got = [r[0] for r in df.select(S.verdict(F.col("p"), "yes", "no")).collect()]
    assert got == ["p < 0.05: yes", "p >= 0.05: no", None]


def test_correlation_pairs_and_constants(rows):
    x = [1.0, 2.0, 3.0, 4.0, None]
    y = [2.0, 1.0, float("nan"), 5.0, 1.0]
    df = rows("x double, y double, k double", [(a, b, 7.0) for a, b in zip(x, y)])
    got = {(r["x"], r["y"]): r["r"] for r in C.correlation_long(df, ["x", "y", "k"]).collect()}
    assert got["x", "y"] == got["y", "x"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 1, 5])[0, 1])
    assert got["x", "x"] == 1.0 and got["x", "k"] is None and got["k", "k"] is None and len(got) == 9


def numbers(spark, n=400):
    rng = np.random.default_rng(3)
    a = rng.normal(size=n)
    data = np.column_stack([a, a + 0.3 * rng.normal(size=n), a + 0.3 * rng.normal(size=n), rng.normal(size=n)])
    y = 2 * data[:, 1] + 0.1 * rng.normal(size=n)
    return spark.createDataFrame(np.column_stack([data, y]).tolist(), "a double, b double, c double, d double, y double"), data


def test_vif_equals_least_squares(spark):
    df, data = numbers(spark)
    got = {r["feature"]: r["vif"] for r in C.vif(df, ["a", "b", "c", "d"]).collect()}
    for i, name in enumerate("abcd"):
        others = np.column_stack([np.ones(len(data)), np.delete(data, i, 1)])
        fit = others @ np.linalg.lstsq(others, data[:, i], rcond=None)[0]
        r2 = 1 - ((data[:, i] - fit) ** 2).sum() / ((data[:, i] - data[:, i].mean()) ** 2).sum()
        assert got[name] == pytest.approx(1 / (1 - r2), rel=1e-8)
    assert all(v >= 1 for v in got.values())


def test_vif_reports_a_singular_matrix(spark):
    df, _ = numbers(spark)
    twice = df.withColumn("a2", F.col("a"))
    assert {r["vif"] for r in C.vif(twice, ["a", "a2", "d"]).collect()} == {None}


def test_drop_collinear_keeps_the_best_of_a_group(spark):
    df, _ = numbers(spark)
    out = {r["feature"]: r["kept"] for r in C.drop_collinear(df, ["a", "b", "c", "d"], "y").collect()}
    assert out["d"] and out["b"] and not out["a"]
    with pytest.raises(ValueError):
        C.drop_collinear(df.withColumn("k", F.lit(1.0)), ["a", "k"], "y")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("uvw")), min_size=1, max_size=30))
def test_v_is_between_0_and_1(spark, pairs):
    v = S.cramers_v(spark.createDataFrame(pairs, "a string, b string"), "a", "b").first()["cramers_v"]
    assert v is None or -1e-9 <= v <= 1 + 1e-9
