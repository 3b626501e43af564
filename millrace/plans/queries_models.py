"""Queries: features, splits, models, scores.

Models train on whole tables with the library's defaults. What SQL cannot compute, the trees
of a forest, is compared by what must hold of any correct model.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import metrics, modeling
from millrace.operators.cleaning import drop_missing
from millrace.operators.splits import stratified_split
from millrace.operators.subsets import all_subsets
from millrace.plans.registry import CLEAN_SQL, LABELED_SQL, SALES_SQL, query
from millrace.plans.sales import REQUIRED, cleaned_sales, sales, staged_sales
from millrace.session import scratch_path, spread, stage
from millrace.sources.sinks import save_model

LABEL = "high_value"
NUMERIC = ["customer_age"]
CATEGORICAL = ["region", "category", "payment_method"]
FACTORS = ["quantity", "unit_price"]
KEY = "order_id"


def features(spark, sf, extra=()):
    return modeling.high_value_features(
        staged_sales(spark, sf), REQUIRED, "amount", [*NUMERIC, *CATEGORICAL, *extra], LABEL
    )


def split(spark, sf, extra=()):
    """Train and test side, staged: each is scanned once per tree level."""
    train, test = stratified_split(stage(features(spark, sf, [*extra, KEY]), "features"), LABEL, key=[KEY])
    return stage(spread(train), "train"), stage(spread(test), "test")


@query("ml1_features_and_label", f"""with {LABELED_SQL}
select customer_age, region, category, payment_method, high_value from labeled""")
def ml1(spark, sf):
    return features(spark, sf)


@query("ml2_standardize", f"""with {SALES_SQL},
s as (select avg(customer_age) as m, stddev_pop(customer_age) as sd from sales)
select customer_age, round((customer_age-m)/sd,9) as customer_age_std, count(*) as n from sales, s group by 1, 2""")
def ml2(spark, sf):
    out = modeling.standardize(staged_sales(spark, sf), ["customer_age"])
    return out.groupBy("customer_age", F.round("customer_age_std", 9).alias("customer_age_std")).agg(
        F.count("*").alias("n")
    )


KNOWN = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]  # STANDARD plays the unseen category


@query("ml3_one_hot", f"with {SALES_SQL} select category, " + ", ".join(
    f"cast(coalesce(max(case when category='{t}' then 1 else 0 end),0) as int) as \"category_{t}\"" for t in KNOWN)
    + ", count(*) as n from sales group by 1")
def ml3(spark, sf):
    hot = sales(spark, sf).select("category", *modeling.one_hot("category", KNOWN))
    return hot.groupBy(hot.columns).agg(F.count("*").alias("n"))


SLOTS = "region category payment_method".split()


@query("ml4_feature_vectors", f"""with {LABELED_SQL},
m as (select avg(customer_age) as mean, stddev_pop(customer_age) as sd from labeled),
""" + ", ".join(
    f"s_{c} as (select {c} as v, cast(row_number() over (order by {c})-1 as int) as slot from (select distinct {c} from labeled))"
    for c in SLOTS) + """
select high_value, round((customer_age-mean)/sd,9) as age, s_region.slot as region, s_category.slot as category,
  s_payment_method.slot as payment_method, count(*) as n
from labeled, m, s_region, s_category, s_payment_method
where labeled.region=s_region.v and labeled.category=s_category.v and labeled.payment_method=s_payment_method.v
group by 1, 2, 3, 4, 5""")
def ml4(spark, sf):
    """Assembled vectors, shown as the scaled age and the hot position of each category."""
    df = features(spark, sf)
    model = Pipeline(stages=modeling.feature_stages(df, NUMERIC, CATEGORICAL)).fit(df)
    sizes = [len(labels) for labels in model.stages[1].labelsArray]
    out = model.transform(df).select(LABEL, vector_to_array("features").alias("f"))
    cols, start = [F.round(F.col("f")[0], 9).alias("age")], 2  # array_position counts from 1
    for name, size in zip(SLOTS, sizes):
        block = F.slice("f", start, size)
        cols.append((F.array_position(block, 1.0) - 1).cast("int").alias(name))
        start += size
    return out.select(LABEL, *cols).groupBy(LABEL, "age", *SLOTS).agg(F.count("*").alias("n"))


@query("ml5_split_sizes", f"""with {LABELED_SQL},
s as (select high_value, count(*) as n from labeled group by 1),
w as (select *, ceil(0.2*sum(n) over ()) as wanted, n*ceil(0.2*sum(n) over ())/sum(n) over () as exact from s),
f as (select *, floor(exact) as got, row_number() over (order by floor(exact)-exact, cast(high_value as varchar)) as rn from w),
t as (select high_value, n, cast(got+case when rn<=wanted-sum(got) over () then 1 else 0 end as bigint) as k from f)
select 'test' as side, high_value, k as n from t union all select 'train', high_value, n-k from t""")
def ml5(spark, sf):
    train, test = stratified_split(stage(features(spark, sf, [KEY]), "features"), LABEL, key=[KEY])

    def sizes(df, side):
        return df.groupBy(LABEL).agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), LABEL, "n")

    return sizes(train, "train").unionByName(sizes(test, "test"))


TEST_SQL = """s as (select high_value, count(*) as n from labeled group by 1),
w as (select *, ceil(0.2*sum(n) over ()) as wanted, n*ceil(0.2*sum(n) over ())/sum(n) over () as exact from s),
f as (select *, floor(exact) as got, row_number() over (order by floor(exact)-exact, cast(high_value as varchar)) as rn from w),
test as (select high_value, cast(got+case when rn<=wanted-sum(got) over () then 1 else 0 end as bigint) as k from f)"""


def support(scored, *more):
    """Test rows per label: no row is lost or scored twice, whatever the model says."""
    return scored.groupBy(LABEL).agg(F.count("*").alias("n"), *more)


@query("ml6_random_forest", f"""with {LABELED_SQL}, {TEST_SQL}
select high_value, k as n, k as scored_0_or_1, true as beats_chance from test""")
def ml6(spark, sf):
    """Rows per label on the test side, whether each got a class, and whether the accuracy reaches the larger class's share."""
    train, test = split(spark, sf)
    model = modeling.forest_pipeline(train, NUMERIC, CATEGORICAL, LABEL).fit(train)
    scored = stage(modeling.predictions(model, test, LABEL), "scored")
    reached = metrics.accuracy(scored, LABEL, "prediction").first()[0] >= metrics.majority_baseline(scored, LABEL).first()[0] - 1e-3
    return support(scored, F.count_if(F.col("prediction").isin(0, 1)).alias("scored_0_or_1"), F.lit(reached).alias("beats_chance"))


RULE_SQL = """ruled as (select *, case when quantity*unit_price >
  (select cast(sum(cast(amount as decimal(18,2))) as double)/count(amount) from present) then 1 else 0 end as prediction from labeled)"""


def ruled(spark, sf):
    """Labeled rows with the prediction of the price rule."""
    present = drop_missing(staged_sales(spark, sf), REQUIRED)
    threshold = present.agg(modeling.mean(F.col("amount"))).scalar()
    labeled = modeling.label_above_mean(present, "amount", LABEL)
    return labeled.withColumn("prediction", (F.col("quantity") * F.col("unit_price") > threshold).cast("int"))


@query("ml7_accuracy", f"""with {LABELED_SQL}, {RULE_SQL}
select cast(count(*) filter (high_value=prediction) as double)/count(*) as accuracy from ruled""")
def ml7(spark, sf):
    return metrics.accuracy(ruled(spark, sf), LABEL, "prediction")


@query("ml8_class_report", f"""with {LABELED_SQL}, {RULE_SQL},
k as (select * from (values (0),(1)) v(c)),
p as (select c, count(*) filter (high_value=c) as support, count(*) filter (prediction=c) as predicted,
  count(*) filter (high_value=c and prediction=c) as hit from ruled, k group by 1),
m as (select c, support, hit, case when predicted=0 then 0 else hit::double/predicted end as precision,
  case when support=0 then 0 else hit::double/support end as recall,
  case when support+predicted=0 then 0 else 2.0*hit/(support+predicted) end as f1 from p)
select cast(c as varchar) as class, round(precision,9) as precision, round(recall,9) as recall, round(f1::double,9) as f1, support from m
union all select 'accuracy', null, null, round(sum(hit)::double/sum(support),9), cast(sum(support) as bigint) from m
union all select 'macro avg', round(avg(precision),9), round(avg(recall),9), round(avg(f1::double),9), cast(sum(support) as bigint) from m
union all select 'weighted avg', round(sum(precision*support)/sum(support),9), round(sum(recall*support)/sum(support),9),
  round(sum(f1::double*support)/sum(support),9), cast(sum(support) as bigint) from m""")
def ml8(spark, sf):
    counts = metrics.confusion(ruled(spark, sf), LABEL, "prediction")
    return metrics.class_report(counts, LABEL, "prediction").withColumns(
        {c: F.round(c, 9) for c in ("precision", "recall", "f1")}
    )


@query("ml9_saved_model", f"""with {LABELED_SQL}, {TEST_SQL}
select high_value, k as n, true as same from test""")
def ml9(spark, sf):
    train, test = split(spark, sf)
    model = modeling.forest_pipeline(train, NUMERIC, CATEGORICAL, LABEL).fit(train)
    again = PipelineModel.load(save_model(model, scratch_path(spark, "model")))
    # both models score the same rows: the loaded one adds a second prediction
    first = modeling.scored(model, test, "fitted")
    both = modeling.scored(again, first, "loaded")
    return support(both, F.bool_and(F.col("fitted") == F.col("loaded")).alias("same"))


@query("ml10_majority_baseline", f"""with {LABELED_SQL}
select cast(greatest(sum(high_value), count(*)-sum(high_value)) as double)/count(*) as accuracy from labeled""")
def ml10(spark, sf):
    return metrics.majority_baseline(features(spark, sf), LABEL)


@query("ml10_rule_baseline", f"""with {LABELED_SQL}, {RULE_SQL}
select cast(count(*) filter (high_value=prediction) as double)/count(*) as accuracy from ruled""")
def ml10_rule(spark, sf):
    df = ruled(spark, sf)
    return metrics.rule_baseline(df, LABEL, F.col("prediction") == 1)


@query("ml11_feature_sets", """select * from (values ('factors only', true), ('all', true), ('without factors', false))
  v(feature_set, leaks)""")
def ml11(spark, sf):
    """Which feature sets give the label away: accuracy far above the larger class's share."""
    train, test = split(spark, sf, FACTORS)
    found = modeling.compare_feature_sets(train, test, LABEL, {
        "factors only": (FACTORS, []),
        "all": ([*FACTORS, *NUMERIC], CATEGORICAL),
        "without factors": (NUMERIC, CATEGORICAL),
    })
    most = metrics.majority_baseline(test, LABEL).first()[0]
    return found.select("feature_set", (F.col("accuracy") > most + 0.5 * (1 - most)).alias("leaks"))


def r2_sql(names: str) -> str:
    """R squared of standardised features in closed form: one, two or three of a, b and c."""
    if len(names) == 1:
        return f"pow({names}y,2)"
    if len(names) == 2:
        x, y = names
        return f"(pow({x}y,2)+pow({y}y,2)-2*{x}y*{y}y*{names})/(1-pow({names},2))"
    return ("(pow(ay,2)*(1-bc*bc)+pow(by,2)*(1-ac*ac)+pow(cy,2)*(1-ab*ab)-2*ay*by*(ab-ac*bc)-2*ay*cy*(ac-ab*bc)"
            "-2*by*cy*(bc-ab*ac))/(1+2*ab*ac*bc-ab*ab-ac*ac-bc*bc)")


REGRESSORS = {"a": "quantity", "b": "gross", "c": "customer_age"}
SUBSETS = ["a", "b", "c", "ab", "ac", "bc", "abc"]


@query("ml12_regression", f"""with {CLEAN_SQL},
f as (select category, quantity as a, quantity*unit_price as b, customer_age as c, amount as y from cleaned),
d as (select y-(select avg(y) from f) as whole, a-avg(a) over w as a, b-avg(b) over w as b, c-avg(c) over w as c, y-avg(y) over w as y
  from f window w as (partition by category)),
r as (select corr(a,b) as ab, corr(a,c) as ac, corr(b,c) as bc, corr(a,y) as ay, corr(b,y) as "by", corr(c,y) as cy,
  sum(y*y)/sum(whole*whole) as within from d)
""" + " union all ".join(
    f"select '{'+'.join(REGRESSORS[x] for x in s)}' as feature_set, cast({len(s)} as int) as n_features, "
    f"round(1-within*(1-{r2_sql(s).replace('by', chr(34) + 'by' + chr(34))}),8) as r2 from r" for s in SUBSETS))
def ml12(spark, sf):
    """R squared with every subset of the features, before and after collinear ones are dropped, beside the category."""
    df = cleaned_sales(spark, sf).withColumn("gross", F.col("quantity") * F.col("unit_price"))
    return all_subsets(df, "amount", list(REGRESSORS.values()), ["category"]).withColumn("r2", F.round("r2", 8))


@query("ml13_classifier_f1", "select true as within_bounds, true as finds_some")
def ml13(spark, sf):
    """F1 of a forest on another feature set: a score of that name, and better than none found."""
    df = staged_sales(spark, sf).where(F.col("amount").isNotNull())
    labeled = modeling.label_above_mean(df, "amount", LABEL).select("quantity", "customer_age", "payment_method", KEY, LABEL)
    train, test = stratified_split(stage(labeled, "features"), LABEL, key=[KEY])
    train, test = stage(spread(train), "train"), stage(spread(test), "test")
    model = modeling.forest_pipeline(train, ["quantity", "customer_age"], ["payment_method"], LABEL).fit(train)
    f1 = metrics.f1_score(modeling.predictions(model, test, LABEL), LABEL, "prediction")
    return f1.select(F.col("f1").between(0, 1).alias("within_bounds"), (F.col("f1") > 0).alias("finds_some"))
