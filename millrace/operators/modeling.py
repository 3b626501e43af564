"""Features, classifiers and regressions on Spark ML pipelines."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import DECIMALS, mean
from millrace.operators import forests
from millrace.operators.cleaning import drop_missing
from millrace.operators.metrics import accuracy
from millrace.operators.subsets import Design, r_squared_on
from millrace.session import spread, stage

#: Distinct rows that the trees grown at one time read together; a tree takes 150 to 200 bytes of executors for each.
ROWS_AT_ONCE = 16_000_000
#: Memory that a task may take for the cells of a table and the sample of a tree: some 36 million cells of one word.
TASK_BYTES = 1 << 30
#: How many rows a counted row stands for.
ROWS = "_rows"


def label_above_mean(df: DataFrame, value: str, label: str, scale: int | None = DECIMALS) -> DataFrame:
    """1 where ``value`` is strictly above its mean over ``df``, else 0."""
    threshold = df.agg(mean(F.col(value), scale)).scalar()
    return df.withColumn(label, (F.col(value) > threshold).cast("int"))


def high_value_features(
    df: DataFrame, required: Sequence[str], value: str, features: Sequence[str], label: str
) -> DataFrame:
    """Label and features of rows that have all required columns; outliers stay in."""
    return label_above_mean(drop_missing(df, list(required)), value, label).select(*features, label)


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, in one aggregation."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_std``: mean 0, population standard deviation 1."""
    stats = moments(df, columns)
    return df.withColumns(
        {f"{c}_std": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()}
    )


def one_hot(column: str, categories: Sequence[str]) -> list[Column]:
    """Dense 0/1 columns; all zero for unseen values and null."""
    return [F.coalesce((F.col(column) == c).cast("int"), F.lit(0)).alias(f"{column}_{c}") for c in categories]


def feature_stages(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], null_category: str | None = None
) -> list:
    """Scaling, one-hot encoding and assembly. Numeric columns use the population
    deviation of ``train``. Unseen categories become all zeros; so do nulls, unless
    ``null_category`` makes them a category of their own."""
    cols = ["*"]
    for c, (m, s) in moments(train, numeric).items() if numeric else ():
        cols.append(f"(`{c}` - {m!r}D) / {s!r}D AS `{c}_std`")
    sources = list(categorical)
    if null_category is not None:
        cols += [f"coalesce(`{c}`, '{null_category}') AS `{c}_filled`" for c in categorical]
        sources = [f"{c}_filled" for c in categorical]
    stages: list = [SQLTransformer(statement=f"SELECT {', '.join(cols)} FROM __THIS__")]
    if categorical:
        stages += [
            StringIndexer(
                inputCols=sources,
                outputCols=[f"{c}_idx" for c in categorical],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"{c}_idx" for c in categorical],
                outputCols=[f"{c}_vec" for c in categorical],
                dropLast=True,
            ),
        ]
    inputs = [f"{c}_std" for c in numeric] + [f"{c}_vec" for c in categorical]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def bootstrap_counts(seeds: pd.Series, n: pd.Series, trees: int) -> pd.Series:
    """How often each of ``trees`` bootstrap samples holds a row that occurs ``n`` times: Poisson(n),
    the sum of the Poisson(1) draws of its copies. A row's draws depend on its own seed alone."""
    draws = [np.random.Generator(np.random.Philox(key=int(s) % (1 << 64))).poisson(k, trees) for s, k in zip(seeds, n)]
    return pd.Series([d.astype(np.int64) for d in draws])


class CountedForest(RandomForestClassifier):
    """Random forest grown over counted cells: rows that lie in the same bins of every feature, with the same label.

    Spark's forest draws a bootstrap count for every row and tree and walks all trees with every row, level
    by level. Here the features of the table are cut into bins once, as Spark does, equal rows are counted, each
    tree draws the number of a cell's rows at once, from the same distribution, and is grown by one task over all cells
    (``forests``). Cells that do not fit a task's memory are left to Spark's own trees, each grown over the distinct rows of
    (features, label), weighted. Nothing is left out: a table without equal rows has every row among the cells.
    A column of counts, where the rows are counted already, is given as ``weightCol``.
    """

    def _count(self) -> Column:
        return F.col(self.getWeightCol()) if self.isSet("weightCol") else F.lit(1)

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        cells = forests.cells_of(dataset, self.getFeaturesCol(), self.getLabelCol(), self._count(), self.getMaxBins())
        if cells is None:
            raise ValueError("no rows to grow a forest on")
        if cells.task_bytes > TASK_BYTES:
            forest, walk = self._by_levels(dataset), None
        else:
            forest, walk = self._grown(cells)
        forest = self._copyValues(forest)
        forest._transfer_params_to_java()
        forest.walk = walk
        return forest

    def _grown(self, cells: forests.Cells) -> tuple[RandomForestClassificationModel, forests.Walk]:
        """The trees dealt over all cores, each grown by one task: Spark's model of them, and what scores the same in NumPy."""
        blobs, layout, trees = cells.blobs, cells.layout, self.getNumTrees()
        spark = blobs.sparkSession
        per_node = math.ceil(math.sqrt(layout.features)) if trees > 1 else layout.features
        growth = forests.Growth(self.getMaxDepth(), self.getMinInstancesPerNode(), per_node)

        def grow(numbers: np.ndarray) -> DataFrame:
            task = forests.grow_trees(layout, numbers.tolist(), self.getSeed(), growth)
            return stage(blobs.coalesce(1).mapInArrow(task, forests.NODE), "trees")

        def load(numbers: np.ndarray) -> RandomForestClassificationModel:
            path = forests.saved_forest(spark, nodes, numbers.tolist(), layout.features, layout.classes)
            return RandomForestClassificationModel.load(path)

        tasks = min(trees, spark.sparkContext.defaultParallelism)
        with ThreadPool(tasks) as pool:
            grown = pool.map(inheritable_thread_target(spark)(grow), np.array_split(np.arange(trees), tasks), chunksize=1)
        nodes = reduce(DataFrame.unionByName, grown)
        pieces = min(trees, 1 + nodes.count() // forests.NODES_AT_ONCE)
        return together([load(numbers) for numbers in np.array_split(np.arange(trees), pieces)], layout.classes), forests.Walk.of(nodes)

    def _bags(self, dataset: DataFrame) -> DataFrame:
        """features, label, and per tree the number of times its sample holds the row."""
        trees, label = self.getNumTrees(), self.getLabelCol()
        counted = dataset.groupBy("features", label).agg(F.sum(self._count()).cast("bigint").alias("n"))
        draw = F.pandas_udf(lambda seeds, n: bootstrap_counts(seeds, n, trees), "array<bigint>")
        drawn = counted.withColumn("drawn", draw(F.xxhash64(F.lit(self.getSeed()), "features", label), "n"))
        return stage(drawn.select("features", label, "n", *[F.col("drawn")[i].alias(f"n{i}") for i in range(trees)]), "bags")

    def _by_levels(self, dataset: DataFrame) -> RandomForestClassificationModel:
        """Spark's own trees, several at a time, over distinct weighted rows."""
        spark, trees, label = dataset.sparkSession, self.getNumTrees(), self.getLabelCol()
        bags, names = self._bags(dataset), [f"n{i}" for i in range(trees)]
        found = bags.agg(F.count(F.lit(1)).alias("rows"), F.max(label).alias("top"), *[F.sum(c).alias(c) for c in ["n", *names]]).first()
        classes = max(int(found["top"] or 0) + 1, 2)
        # the sample of a tree may miss a class: all trees know the classes of the table
        known = F.col(label).cast("double").alias(label, metadata={"ml_attr": {"type": "nominal", "num_vals": classes}})

        def grow(i: int) -> RandomForestClassificationModel:
            name = names[i] if found[names[i]] else "n"  # a sample of a few rows can be empty
            size, least = found[name], self.getMinInstancesPerNode()
            tree = RandomForestClassifier(
                labelCol=label, weightCol="n", numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt" if trees > 1 else "all",
                maxDepth=self.getMaxDepth() if size >= 2 * least else 0, seed=self.getSeed() + i,
                # counts are whole numbers: half a row less keeps rounding out of the comparison
                minInstancesPerNode=1, minWeightFractionPerNode=min((least - 0.5) / size, 0.4999),
            )
            return tree.fit(bags.where(F.col(name) > 0).select("features", known, F.col(name).cast("double").alias("n")))

        at_once = min(trees, spark.sparkContext.defaultParallelism, ROWS_AT_ONCE // found["rows"])
        with ThreadPool(max(1, at_once)) as pool:
            grown = pool.map(inheritable_thread_target(spark)(grow), range(trees), chunksize=1)
        return together(grown, classes)


def together(grown: Sequence[RandomForestClassificationModel], classes: int) -> RandomForestClassificationModel:
    """One forest of the trees of several."""
    sc = SparkContext.getOrCreate()
    ml, first = sc._jvm.org.apache.spark.ml.classification, grown[0]._java_obj
    all_trees = [tree for model in grown for tree in model._java_obj.trees()]
    trees = sc._gateway.new_array(ml.DecisionTreeClassificationModel, len(all_trees))
    for i, tree in enumerate(all_trees):
        trees[i] = tree
    return RandomForestClassificationModel(ml.RandomForestClassificationModel(first.uid(), trees, first.numFeatures(), classes))


def forest_pipeline(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    trees: int = 100,
    depth: int = 15,
    min_leaf: int = 50,
    seed: int = 42,
    null_category: str | None = None,
) -> Pipeline:
    """Unfitted pipeline: preprocessing and a random forest of bounded size."""
    forest = CountedForest(
        labelCol=label,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        seed=seed,
    )
    return Pipeline(stages=[*feature_stages(train, numeric, categorical, null_category), forest])


def linear_pipeline(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str) -> Pipeline:
    """Unfitted pipeline: preprocessing and a linear regression."""
    model = LinearRegression(labelCol=target, featuresCol="features")
    return Pipeline(stages=[*feature_stages(train, numeric, categorical), model])


def _classified(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with a column ``prediction``. A forest just grown walks many rows through a tree at a time, others score
    row by row; the classes are the same."""
    last = model.stages[-1]
    walk = getattr(last, "walk", None)
    if walk is None or last.isDefined("thresholds"):
        return model.transform(df)
    return PipelineModel(model.stages[:-1]).transform(df).withColumn("prediction", walk.column(last.getFeaturesCol()))


def predictions(model: PipelineModel, df: DataFrame, label: str, *more: str) -> DataFrame:
    """Label and predicted class, and further columns."""
    return _classified(model, spread(df)).select(label, F.col("prediction").cast("int").alias("prediction"), *more)


def scored(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """The rows with the predicted class in a column of that name."""
    return _classified(model, spread(df)).select(*df.columns, F.col("prediction").cast("int").alias(name))


def alike_counted(df: DataFrame, sets: Sequence[Sequence[str]]) -> Iterator[DataFrame]:
    """For each set of columns the rows of these, with a column of counts. Where at least half of the rows repeat others,
    alike rows are counted and staged; else every row is its own and counts 1."""
    sizes = [F.approx_count_distinct(F.xxhash64(*[F.col(c) for c in columns])).alias(f"d{i}") for i, columns in enumerate(sets)]
    found = df.agg(F.count(F.lit(1)).alias("rows"), *sizes).first()
    for i, columns in enumerate(sets):
        if 2 * found[f"d{i}"] <= found["rows"]:
            yield stage(df.groupBy(*columns).agg(F.count(F.lit(1)).alias(ROWS)), "alike")
        else:
            yield df.select(*columns, F.lit(1).cast("bigint").alias(ROWS))


def compare_feature_sets(
    train: DataFrame,
    test: DataFrame,
    label: str,
    sets: dict[str, tuple[Sequence[str], Sequence[str]]],
    **forest: int,
) -> DataFrame:
    """Test accuracy of one forest per (numeric, categorical) feature set. A set that
    scores far above the others points to leakage. Rows alike in a set are encoded and scored once."""
    rows = []
    wanted = [[*dict.fromkeys([*numeric, *categorical, label])] for numeric, categorical in sets.values()]
    sides = zip(alike_counted(train, wanted), alike_counted(test, wanted))
    for (name, (numeric, categorical)), (fitted, judged) in zip(sets.items(), sides):
        pipeline = forest_pipeline(train, numeric, categorical, label, **forest)
        pipeline.getStages()[-1].setWeightCol(ROWS)
        scored = predictions(pipeline.fit(fitted), judged, label, ROWS)
        rows.append((name, accuracy(scored, label, "prediction", ROWS).first()[0]))
    return train.sparkSession.createDataFrame(rows, "feature_set string, accuracy double")


def compare_regressions(
    train: DataFrame, test: DataFrame, target: str, sets: dict[str, tuple[Sequence[str], Sequence[str]]]
) -> DataFrame:
    """Test R squared of a linear regression per (numeric, categorical) feature set.

    Each side is scanned once for all sets together. Levels are those of ``train``; others
    count as the first one. Rows with a missing number or target are left out.
    """
    numeric = list(dict.fromkeys(c for n, _ in sets.values() for c in n))
    categorical = list(dict.fromkeys(c for _, cs in sets.values() for c in cs))
    design = Design.of(train, target, numeric, categorical)
    fitted, judged = design.moments(train), design.moments(test)
    rows = []
    for name, (n, cs) in sets.items():
        columns = [k for c in (*n, *cs) for k in design.parts[c]]
        rows.append((name, r_squared_on(fitted, judged, columns)))
    return train.sparkSession.createDataFrame(rows, "feature_set string, r2 double")
