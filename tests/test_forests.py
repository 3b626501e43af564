import uuid

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from millrace.operators import forests, modeling


def vectors(df, *columns):
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


@pytest.fixture(scope="module")
def mixed(spark):
    h = lambda i, n: F.pmod(F.xxhash64(F.col("id"), F.lit(i)), F.lit(n))
    df = spark.range(6000).select(
        "id", h(1, 20).cast("double").alias("a"), h(2, 7).cast("double").alias("b"), h(3, 4).alias("c"), h(4, 1000).cast("double").alias("r"),
        *[(h(3, 4) == k).cast("double").alias(f"c{k}") for k in range(3)], (h(5, 3) == 0).cast("double").alias("d0"), (h(5, 3) == 1).cast("double").alias("d1"),
    )
    y = (F.col("a") * 3 + F.col("b") * 2 + F.col("c") * 5 > 45) != (F.col("r") < 30)
    return df.withColumn("y", y.cast("int")).cache()


NAMES = ["a", "b", "c0", "c1", "c2", "d0", "d1"]


def words_of(cells):
    rows = cells.blobs.collect()
    *words, n = [np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in cells.blobs.columns]
    return [w.view(np.uint64) for w in words], n


def tree_of(spark, cells, growth):
    """One tree over all rows, each as often as it occurs, as Spark's model."""
    words, n = words_of(cells)
    sample = forests.drawn_sample(cells.layout, words, n, lambda counts: counts.astype(np.uint64))
    batch = forests.grow(sample, forests.Splits(cells.layout), np.random.default_rng(1), growth)
    nodes = spark.createDataFrame([(0, r["nodeData"]) for r in batch.to_pylist()], forests.NODE)
    return RandomForestClassificationModel.load(forests.saved_forest(spark, nodes, [0], cells.layout.features, cells.layout.classes))


def test_a_forest_takes_few_jobs(spark, mixed):
    """Each tree is grown within one task. Trees that are scanned for level by level take several jobs each."""
    group, sc = uuid.uuid4().hex, spark.sparkContext
    sc.setJobGroup(group, "forest")
    try:
        model = modeling.forest_pipeline(mixed, ["a", "b"], ["c"], "y", trees=30, depth=6, min_leaf=5).fit(mixed)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert model.stages[-1].getNumTrees == 30
    assert len(sc.statusTracker().getJobIdsForGroup(group)) < 60


def test_cells_hold_every_row(spark, mixed):
    cells = forests.cells_of(vectors(mixed, *NAMES), "features", "y", F.lit(1), 32)
    assert [g.features for g in cells.layout.groups] == [[0], [1], [2, 3, 4], [5, 6]]
    words, n = words_of(cells)
    distinct = mixed.select(*NAMES, "y").distinct().count()
    assert (cells.rows, len(words[0]), n.sum()) == (distinct, distinct, 6000)


def test_a_tree_is_that_of_spark(spark, mixed):
    df = vectors(mixed, *NAMES)
    ours = tree_of(spark, forests.cells_of(df, "features", "y", F.lit(1), 32), forests.Growth(7, 10, len(NAMES)))
    theirs = DecisionTreeClassifier(labelCol="y", maxDepth=7, minInstancesPerNode=10).fit(df)
    both = theirs.transform(df).select("features", F.col("prediction").alias("theirs"))
    assert ours.transform(both).where("prediction != theirs").count() == 0
    assert ours.trees[0].numNodes == theirs.numNodes > 20


def test_columns_with_ones_in_the_same_row_stay_apart(spark, mixed):
    df = vectors(mixed.withColumn("e", F.greatest("c1", "d0")), "c0", "c1", "e", "d1")
    groups = forests.cells_of(df, "features", "y", F.lit(1), 32).layout.groups
    ones = {j: i for i, g in enumerate(groups) for j in g.features}
    assert len(ones) == 4 and ones[0] == ones[1] != ones[2]


def test_many_features_take_several_words(spark, mixed):
    """The same column many times over: the tree is that of one column each."""
    df = vectors(mixed, *NAMES)
    wide = VectorAssembler(inputCols=["features"] * 8, outputCol="wide").transform(df)
    one = tree_of(spark, forests.cells_of(df, "features", "y", F.lit(1), 32), forests.Growth(6, 10, 7))
    cells = forests.cells_of(wide, "wide", "y", F.lit(1), 32)
    assert len(cells.layout.used) > 1
    many = tree_of(spark, cells, forests.Growth(6, 10, 56))
    predicted = one.transform(wide).select("wide", F.col("prediction").alias("one"))
    assert many.setFeaturesCol("wide").transform(predicted).where("prediction != one").count() == 0
    assert many.trees[0].numNodes == one.trees[0].numNodes


def test_thresholds_share_out_the_rows(spark):
    df = vectors(spark.range(100_000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).alias("y")), "x")
    (group,) = forests.cells_of(df, "features", "y", F.lit(1), 32).layout.groups
    assert len(group.thresholds) == 31
    assert np.abs(np.diff([0, *group.thresholds, 100_000]) - 3125).max() <= 1


def test_counted_rows_give_the_same_forest(spark, mixed):
    few = mixed.select("b", "c", "y")
    counted = few.groupBy("b", "c", "y").agg(F.count("*").alias("n"))
    make = lambda: modeling.forest_pipeline(few, ["b"], ["c"], "y", trees=4, depth=4, min_leaf=20)
    rows = make().fit(few.repartition(3))
    pipeline = make()
    pipeline.getStages()[-1].setWeightCol("n")
    assert pipeline.fit(counted).stages[-1].toDebugString.split("\n", 1)[1] == rows.stages[-1].toDebugString.split("\n", 1)[1]


def test_a_label_without_class_is_refused(spark, mixed):
    for bad in (F.lit(None).cast("int"), F.lit(-1), F.lit(0.5)):
        df = vectors(mixed.limit(10).withColumn("y", bad), "a")
        with pytest.raises(Exception, match="class"):
            modeling.CountedForest(labelCol="y", numTrees=2).fit(df)
    with pytest.raises(ValueError):
        modeling.CountedForest(labelCol="y", numTrees=2).fit(vectors(mixed.limit(0), "a"))


def test_without_room_in_a_task_trees_grow_by_levels(spark, mixed, monkeypatch):
    df = vectors(mixed, "a", "b")
    forest = modeling.CountedForest(labelCol="y", numTrees=3, maxDepth=4, minInstancesPerNode=20, seed=1)
    inside = forest.fit(df)
    monkeypatch.setattr(modeling, "TASK_BYTES", 0)
    outside = forest.fit(df)
    assert inside.getNumTrees == outside.getNumTrees == 3
    wrong = [m.transform(df).where("prediction != y").count() for m in (inside, outside)]
    assert abs(wrong[0] - wrong[1]) < 0.05 * 6000


def test_scores_are_those_of_spark(spark, mixed):
    """Rows beyond the trained ones, with levels not seen there, too."""
    model = modeling.forest_pipeline(mixed, ["a", "r"], ["c"], "y", trees=9, depth=6, min_leaf=20).fit(mixed)
    rows = mixed.withColumn("a", F.col("a") * 1.5 - 4).withColumn("c", F.when(F.col("id") % 9 > 0, F.col("c") + 1))
    assert model.stages[-1].walk is not None
    both = modeling.scored(model, model.transform(rows).select("a", "r", "c", F.col("prediction").alias("theirs")), "ours")
    assert both.where("ours = theirs").count() == both.count() == 6000
    assert both.select("ours").distinct().count() == 2


def test_alike_rows_are_counted(spark, mixed):
    few, all_ = modeling.alike_counted(mixed, [["c", "y"], ["id", "y"]])
    assert few.count() <= 8 and all_.count() == 6000
    assert [df.agg(F.sum(modeling.ROWS)).first()[0] for df in (few, all_)] == [6000, 6000]


def test_bootstrap_draws_are_poisson():
    draw = forests.Bootstrap(np.random.default_rng(3))
    for mean in (1, 2, 7, 32, 33, 5000):
        got = draw(np.full(200_000, mean)).astype(float)
        assert abs(got.mean() - mean) < 5 * (mean / 200_000) ** 0.5 and 0.97 < got.var() / mean < 1.03
    ones = np.bincount(draw(np.full(200_000, 1)).astype(int), minlength=4)[:4] / 200_000
    assert np.abs(ones - np.exp(-1) / np.array([1, 1, 2, 6])).max() < 0.005
