import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from millrace.operators import metrics as M
from millrace.operators import modeling as B
from millrace.operators import quantiles as Q
from millrace.operators.splits import allocate, stratified_split
from millrace.sources.sinks import save_model


def both(df, **kw):
    train, test = stratified_split(df, "y", **kw)
    return [sorted(map(tuple, side.collect()), key=repr) for side in (train, test)]


def test_split_is_exact_disjoint_and_stable(spark):
    df = spark.range(500).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    train, test = both(df)
    assert len(test) == 100 and not set(train) & set(test) and len(train) == 400
    assert sum(y for _, y in test) == round(167 * 0.2)
    assert both(df.repartition(7)) == [train, test]
    assert both(df, seed=7)[1] != test


def test_split_with_copies(spark):
    """One row makes up most of the table; copies are shared out exactly."""
    df = spark.range(300).select(F.when(F.col("id") < 250, 0).otherwise(F.col("id")).alias("v"), F.lit(1).alias("y"))
    train, test = both(df)
    assert len(test) == 60 and sorted(train + test) == sorted(map(tuple, df.collect()))
    assert both(df.repartition(5)) == [train, test]


def test_split_by_several_passes(spark, monkeypatch):
    monkeypatch.setattr(Q, "CELLS", 4)
    df = spark.range(2000).select("id", (F.col("id") % 2).cast("int").alias("y"))
    train, test = both(df)
    assert len(test) == 400 and len(set(train) | set(test)) == 2000


def test_allocation():
    # Published class sizes and the sizes of their split.
    assert allocate({0: 639490, 1: 337650}, 0.2) == {0: 127898, 1: 67530}
    assert allocate({"a": 1, "b": 1, "c": 1}, 0.5) == {"a": 1, "b": 1, "c": 0}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 1)), min_size=2, max_size=30))
def test_split_keeps_every_row(spark, data):
    df = spark.createDataFrame(data, "v bigint, y int")
    train, test = both(df)
    assert sorted(train + test) == sorted(data) and len(test) == math.ceil(0.2 * len(data))


def test_label_is_strictly_above_mean(rows):
    df = rows("v double", [(1.0,), (2.0,), (3.0,)])
    assert [r["y"] for r in B.label_above_mean(df, "v", "y").collect()] == [0, 0, 1]


def test_standardize_uses_population_deviation(rows):
    v = [1.0, 2.0, 4.0, 9.0]
    got = [r["v_std"] for r in B.standardize(rows("v double", [(x,) for x in v]), ["v"]).collect()]
    assert np.allclose(got, (np.array(v) - np.mean(v)) / np.std(v))


def test_unseen_and_null_categories_are_all_zero(rows):
    train = rows("n double, c string", [(1.0, "a"), (2.0, "b"), (3.0, "b")])
    model = Pipeline(stages=B.feature_stages(train, ["n"], ["c"])).fit(train)
    score = rows("n double, c string", [(2.0, "a"), (2.0, "b"), (2.0, "zz"), (2.0, None)])
    got = [r["features"].toArray().tolist() for r in model.transform(score).collect()]
    assert got == [[0, 1, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0]]
    dense = [tuple(r) for r in score.select(*B.one_hot("c", ["a", "b"])).collect()]
    assert dense == [(1, 0), (0, 1), (0, 0), (0, 0)]


def test_null_as_its_own_category(rows):
    train = rows("c string", [("a",), (None,)])
    model = Pipeline(stages=B.feature_stages(train, [], ["c"], null_category="__null__")).fit(train)
    got = [r["features"].toArray().tolist() for r in model.transform(train).collect()]
    assert got == [[0, 1], [1, 0]]


@pytest.fixture(scope="module")
def leaky(spark):
    df = spark.range(1500).select(
        (F.xxhash64("id") % 100).cast("double").alias("x"), (F.col("id") % 50).cast("double").alias("noise"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"),
    )
    return df.withColumn("y", (F.col("x") > 20).cast("int"))


def test_forest_trains_saves_and_loads(spark, leaky, tmp_path):
    model = B.forest_pipeline(leaky, ["x"], ["c"], "y", trees=5, depth=4).fit(leaky)
    scored = B.predictions(model, leaky, "y")
    assert M.accuracy(scored, "y", "prediction").first()[0] > 0.98
    path = save_model(model, str(tmp_path / "m"))
    again = B.predictions(PipelineModel.load(path), leaky, "y")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))
    blocker = tmp_path / "file"
    blocker.write_text("x")
    with pytest.raises(OSError):
        save_model(model, str(blocker / "below"))


def test_defaults_bound_the_forest(leaky):
    forest = B.forest_pipeline(leaky, ["x"], [], "y").getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (100, 15, 50, 42)


def test_leak_shows_in_feature_sets(leaky):
    sets = {"with x": (["x"], []), "without": (["noise"], ["c"])}
    got = {r[0]: r[1] for r in B.compare_feature_sets(leaky, leaky, "y", sets, trees=5, depth=4).collect()}
    assert got["with x"] > 0.98 > got["without"] + 0.1


def test_regressions(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    df = df.withColumn("y", 3 * F.col("a") + F.col("b"))
    got = {r[0]: r[1] for r in B.compare_regressions(df, df, "y", {"ab": (["a", "b"], []), "b": (["b"], [])}).collect()}
    assert got["ab"] == pytest.approx(1.0, abs=1e-6) and got["b"] < 0.1


def test_class_report_of_a_class_never_predicted(rows):
    counts = rows("y int, p int, n bigint", [(0, 0, 127898), (1, 0, 67530)])
    got = {r["class"]: r for r in M.class_report(counts, "y", "p").collect()}
    shown = lambda r: tuple(round(r[c], 2) for c in ("precision", "recall", "f1"))
    assert shown(got["0"]) == (0.65, 1.0, 0.79) and shown(got["1"]) == (0.0, 0.0, 0.0)
    assert got["accuracy"]["f1"] == 127898 / 195428
    assert shown(got["macro avg"]) == (0.33, 0.5, 0.4) and shown(got["weighted avg"]) == (0.43, 0.65, 0.52)
    assert got["weighted avg"]["support"] == 195428


def test_scores(rows):
    df = rows("y int, p int", [(1, 1), (1, 0), (0, 0), (0, 1), (1, 1)])
    assert M.accuracy(df, "y", "p").first()[0] == 0.6
    assert M.f1_score(df, "y", "p").first()[0] == pytest.approx(4 / 6)
    assert M.f1_score(df.where("y = 0 and p = 0"), "y", "p").first()[0] == 0.0
    assert M.majority_baseline(df, "y").first()[0] == 0.6
    assert M.rule_baseline(df, "y", F.col("p") == 1).first()[0] == 0.6
    assert M.positive_ratio(df, "y").first()[0] == 0.6
    reg = rows("y double, p double", [(1.0, 1.0), (2.0, 2.5), (3.0, 3.0)])
    assert M.r_squared(reg, "y", "p").first()[0] == pytest.approx(1 - 0.25 / 2)


def test_forest_counts_equal_rows(spark, leaky):
    """Trees are grown over distinct rows; copies count as often as they occur, and give the same sizes of leaves."""
    few = leaky.select((F.col("x") % 5).alias("x"), "y").unionAll(leaky.select((F.col("x") % 5).alias("x"), "y"))
    features = B.feature_stages(few, ["x"], [])
    forest = B.forest_pipeline(few, ["x"], [], "y", trees=6, depth=3, min_leaf=20).getStages()[-1]
    bags = forest._bags(Pipeline(stages=features).fit(few).transform(few))
    names = [f"n{i}" for i in range(6)]
    row = bags.agg(F.count("*").alias("rows"), F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).first()
    assert row["rows"] <= 20 and row["n"] == 3000
    assert all(abs(row[c] - 3000) < 6 * 3000**0.5 for c in names) and len({row[c] for c in names}) > 1
    model = B.forest_pipeline(few, ["x"], [], "y", trees=6, depth=3, min_leaf=20).fit(few)
    assert model.stages[-1].getNumTrees == 6 and model.stages[-1].numClasses == 2
    stump = B.forest_pipeline(few, ["x"], [], "y", trees=1, min_leaf=1700).fit(few).stages[-1]
    assert stump.totalNumNodes == 1 < model.stages[-1].totalNumNodes / 6  # no split leaves 1700 on both sides


def test_bootstrap_counts_do_not_depend_on_neighbours():
    import pandas as pd

    both = B.bootstrap_counts(pd.Series([5, -7]), pd.Series([1000, 2]), 400)
    alone = B.bootstrap_counts(pd.Series([-7]), pd.Series([2]), 400)
    assert both[1].tolist() == alone[0].tolist()
    assert abs(both[0].mean() - 1000) < 10 and 700 < both[0].var() < 1300


def test_one_file_is_dealt_over_all_cores(spark, tmp_path):
    from millrace.session import spread

    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    few = spark.read.parquet(str(tmp_path / "one"))
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
