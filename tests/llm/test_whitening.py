"""Whitening against a full eigendecomposition, and on nulls, ties, repeats, odd lengths and empty tables."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries as _  # noqa: F401  registers the queries
from millrace.llm.registry import QUERIES
from millrace.llm.whitening import Blocks, blocks, eigenpairs, fit, fixed_point, whiten

SCHEMA = "vec_id bigint, x array<bigint>"


def plain(x, k):
    """Deviation, eigenvalues, whitened vectors (up to signs) and shares by the full covariance."""
    n, sums = len(x), [int(s) for s in x.astype(object).sum(0)]
    deviations = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    z = x - np.array([s / n for s in sums])
    v = z.T @ z / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return deviations, values, z @ vectors / np.sqrt(values), values / np.trace(v)


def same_up_to_sign(a, b, tolerance):
    sign = np.sign((a * b).sum(0))
    return np.abs(a - b * sign).max() <= tolerance


def frame(rows, x):
    return rows(SCHEMA, [(i, [int(c) for c in row]) for i, row in enumerate(x)])


def spread(n, dim, seed, falling=0.97):
    rng = np.random.default_rng(seed)
    z = rng.standard_normal((n, dim)) * falling ** np.arange(dim) * 500
    return np.floor(z @ np.linalg.qr(rng.standard_normal((dim, dim)))[0]).astype(np.int64) + 1_000_000


@pytest.mark.parametrize("n, dim, k", [(400, 40, 12), (300, 7, 32), (900, 64, 32)])
def test_equals_the_full_decomposition(rows, n, dim, k):
    x = spread(n, dim, n)
    got = sorted(whiten(frame(rows, x), "x", "vec_id", k).collect(), key=lambda r: r["id"])
    deviations, values, whitened, shares = plain(x, k)
    assert [r["id"] for r in got] == list(range(n)) and {r["n"] for r in got} == {n}
    assert [int(r["deviation"]) for r in got] == deviations
    assert same_up_to_sign(np.array([r["whitened"] for r in got]), whitened, 1e-8)
    assert np.allclose(got[0]["explained"], shares, rtol=1e-10) and got[0]["identity_error"] < 1e-9


def test_iteration_needs_few_passes_and_misses_nothing():
    rng = np.random.default_rng(4)
    basis = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    spectrum = 0.98 ** np.arange(300)
    spectrum[:6] = [3, 3, 3, 2, 2, 1.5]  # equal eigenvalues too
    v = basis * spectrum @ basis.T
    passes = []

    def times(q):
        passes.append(q.shape[1])
        return v @ q

    values, q = eigenpairs(times, 300, 20)
    assert np.allclose(values, np.sort(spectrum)[::-1][:20], rtol=1e-12)
    assert np.abs(v @ q - q * values).max() < 1e-11 and np.abs(q.T @ q - np.eye(20)).max() < 1e-12
    assert len(passes) < 150 and max(passes) < 60


def test_a_flat_spectrum_ends():
    values, q = eigenpairs(lambda q: q * 2.0, 50, 8)
    assert np.allclose(values, 2.0) and q.shape == (50, 8)
    steps = np.diag(1 + 1e-9 * np.arange(60))
    values, q = eigenpairs(lambda q: steps @ q, 60, 8)
    assert np.allclose(values, 1 + 1e-9 * np.arange(59, 51, -1), atol=1e-12)


def test_matrices_of_many_tasks_are_added_on_executors(rows):
    x = spread(600, 6, 3)
    data = blocks(frame(rows, x).repartition(90), "x", "vec_id")
    assert data.partitions <= 90
    many = Blocks(data.frame.repartition(80), data.dim, 80)
    total = many.each(lambda part: part.astype(float).sum(0))
    assert total.tolist() == x.sum(0).tolist() and many.exact(lambda part: part.sum(0).tolist()) == x.sum(0).tolist()
    assert np.allclose(fit(many, 3).values, fit(data, 3).values, rtol=1e-12)


def test_edges(spark, rows):
    good = [(i, [i * i % 11, i % 5, 3]) for i in range(20)]
    data = [*good, (20, None), (21, [1, None, 2]), (22, []), (23, [1, 2]), (None, [4, 4, 3]), (5, [25 % 11, 0, 3]), (5, [25 % 11, 0, 3])]
    df = rows(SCHEMA, data).withColumns({c: F.lit(1) for c in ("id", "n", "whitened", "ids", "part", "j")})
    got = whiten(df, "x", "vec_id", 32).collect()
    assert sorted((r["id"] for r in got), key=repr) == sorted([*range(20), None, 5, 5], key=repr) and {r["n"] for r in got} == {23}
    assert {len(r["whitened"]) for r in got} == {2}  # the third dimension has no variance
    used = np.array([x for _, x in data if x and len(x) == 3 and None not in x])
    deviations, values, whitened, _ = plain(used, 2)
    assert sorted(int(r["deviation"]) for r in got) == sorted(deviations) and got[0]["identity_error"] < 1e-9
    repeated = [r["whitened"] for r in got if r["id"] == 5]
    assert len(repeated) == 3 and repeated[0] == repeated[1] == repeated[2]
    for alike in ([(1, [7, 8])], [(1, [7, 8]), (2, [7, 8])]):
        found = whiten(rows(SCHEMA, alike), "x", "vec_id").collect()
        assert [(r["whitened"], r["explained"], int(r["deviation"])) for r in found] == [([], [], 0)] * len(alike)
    for none in ([], [(1, None), (2, [])]):
        nothing = whiten(rows(SCHEMA, none), "x", "vec_id")
        assert nothing.count() == 0 and nothing.columns == got[0].__fields__


def test_great_numbers_stay_exact(rows):
    x = np.array([[(1 << 60) + 3, -5], [-(1 << 60), 7], [12, (1 << 40)]])
    got = sorted(whiten(frame(rows, x), "x", "vec_id", 1).collect(), key=lambda r: r["id"])
    sums = [int(s) for s in x.astype(object).sum(0)]
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert [r["deviation"] for r in got] == [Decimal(w) if w < 10**38 else None for w in want]


def test_fixed_point(rows):
    inf, nan = float("inf"), float("nan")
    vectors = [[0.1, -0.1], [1.0, None], [inf, 0.0], [nan, 0.0], None, [1e30, 0.0], []]
    df = rows("v array<float>", [(v,) for v in vectors])
    assert [r[0] for r in df.select(fixed_point(F.col("v"), 64, 1000)).collect()] == [[1006, 993], None, None, None, None, None, []]


def test_query(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    kept = [r for r in table if r["embedding"] is not None and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    x = np.array([[int(np.floor(64.0 * float(c))) + 1_000_000 for c in r["embedding"]] for r in kept])
    deviations, _, whitened, shares = plain(x, 32)
    found = QUERIES["op12_whitening"](spark, sf).collect()
    assert len(found) == 32 * len(kept)
    place = {r["vec_id"]: i for i, r in enumerate(kept)}
    got = np.zeros((len(kept), 32))
    for r in found:
        i = place[r["vec_id"]]
        got[i, r["component"] - 1] = r["whitened"]
        assert r["n"] == len(kept) and r["deviation"] == deviations[i] and r["identity_error"] < 1e-8
        assert abs(r["explained"] / shares[r["component"] - 1] - 1) < 1e-9
    assert same_up_to_sign(got, whitened, 1e-7)
