"""Queries: aggregation, sorting, top rows, duplicates, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import mean, missing
from millrace.operators import aggregates as agg
from millrace.operators import hashtree, reconcile
from millrace.operators import summary_states as states
from millrace.operators.cleaning import clean, cleaning_report, drop_missing
from millrace.operators.correlation import correlation_long
from millrace.operators.duplicates import drop_duplicates
from millrace.operators.metrics import positive_ratio
from millrace.operators.modeling import label_above_mean
from millrace.operators.quantiles import exact_quantiles
from millrace.plans.registry import AVG_SQL, CLEAN_SQL, LABELED_SQL, PRESENT_SQL, SALES_SQL, SUM_SQL, query
from millrace.plans.sales import REQUIRED, cleaned_sales, sales, staged_sales, summaries, table
from millrace.session import scratch_path

NAMED = f"{SUM_SQL} as total_amount, {AVG_SQL} as avg_amount, count(amount) as item_count"


@query("agg1_row_count", f"""with {CLEAN_SQL}
select (select count(*) from sales) as rows_total, (select count(*) from present) as rows_complete,
       (select count(*) from cleaned) as rows_clean""")
def agg1(spark, sf):
    raw = staged_sales(spark, sf)
    _, fence = clean(raw, REQUIRED, "amount")
    ok = ~missing(raw, "region") & ~missing(raw, "category") & ~missing(raw, "amount")
    return raw.agg(
        F.count("*").alias("rows_total"),
        F.count_if(ok).alias("rows_complete"),
        F.count_if(ok & F.col("amount").between(fence.lower, fence.upper)).alias("rows_clean"),
    )


@query("agg2_missing_per_column", f"""with {SALES_SQL}
select count(*) filter (region is null) as missing_region, count(*) filter (category is null) as missing_category,
       count(*) filter (amount is null) as missing_amount from sales""")
def agg2(spark, sf):
    return cleaning_report(sales(spark, sf), REQUIRED).select(*[f"missing_{c}" for c in REQUIRED])


@query("agg3_named_aggregation", f"with {CLEAN_SQL} select payment_method, {NAMED} from cleaned group by 1")
def agg3(spark, sf):
    return agg.named_agg(cleaned_sales(spark, sf), ["payment_method"])


@query("agg4_region_category", f"with {CLEAN_SQL} select region, category, {NAMED} from cleaned group by 1, 2")
def agg4(spark, sf):
    return agg.named_agg(cleaned_sales(spark, sf), ["region", "category"])


@query("agg5_payment_method",
       f"with {CLEAN_SQL} select region, category, payment_method, {NAMED} from cleaned group by 1, 2, 3")
def agg5(spark, sf):
    return agg.named_agg(cleaned_sales(spark, sf), ["region", "category", "payment_method"])


@query("agg6_monthly_trend", f"""with {CLEAN_SQL}
select substr(cast(order_date as varchar),1,7) as order_month, {NAMED} from cleaned group by 1""")
def agg6(spark, sf):
    return agg.monthly_trend(cleaned_sales(spark, sf))


@query("agg3_three_summaries", f"""with {CLEAN_SQL}
select 'region_category' as summary, region as k1, category as k2, null as k3, {NAMED} from cleaned group by 1, 2, 3
union all select 'payment_method', region, category, payment_method, {NAMED} from cleaned group by 1, 2, 3, 4
union all select 'monthly_trend', substr(cast(order_date as varchar),1,7), null, null, {NAMED} from cleaned group by 1, 2""")
def agg3_summaries(spark, sf):
    parts, _ = summaries(staged_sales(spark, sf))
    out = None
    for name, df in parts.items():
        keys = df.columns[:-3]
        padded = [F.col(keys[i]) if i < len(keys) else F.lit(None).cast("string") for i in range(3)]
        rows = df.select(F.lit(name).alias("summary"), *[c.alias(f"k{i + 1}") for i, c in enumerate(padded)], *df.columns[-3:])
        out = rows if out is None else out.unionByName(rows)
    return out


@query("agg3_landed_summaries", f"""with {PRESENT_SQL}
select region, category, {NAMED} from present group by 1, 2""")
def agg3_landed(spark, sf):
    """Three landings, one of them stored twice: the report reads their states only."""
    path = scratch_path(spark, "states")
    rows = drop_missing(staged_sales(spark, sf), REQUIRED)
    for i in (0, 1, 2, 1):
        landing = rows.where(F.col("order_id") % 3 == i)
        states.store(states.summary_state(landing, ["region", "category"], "amount"), path, f"day-{i}")
    return states.finish(states.stored(spark, path), ["region", "category"], "amount")


@query("dq6_landed_missing", f"""with {SALES_SQL}, counts as (
  select 'region' as column_name, count(*) filter (region is null) as missing_count, count(*) as n from sales
  union all select 'category', count(*) filter (category is null), count(*) from sales
  union all select 'amount', count(*) filter (amount is null), count(*) from sales)
select column_name, missing_count, round(missing_count*100.0::double/n,3) as missing_pct from counts""")
def dq6_landed(spark, sf):
    path = scratch_path(spark, "missing-states")
    rows = staged_sales(spark, sf)
    for i in (0, 1):
        states.store(states.missing_state(rows.where(F.col("order_id") % 2 == i), REQUIRED), path, f"day-{i}")
    return states.merged_missing(states.stored(spark, path))


@query("agg7_monthly_total", f"""with {CLEAN_SQL}
select substr(cast(order_date as varchar),1,7) as order_month, {SUM_SQL} as total_amount from cleaned group by 1""")
def agg7(spark, sf):
    return agg.monthly_total(cleaned_sales(spark, sf))


@query("agg8_exact_quantiles", f"""with {PRESENT_SQL}
select count(*) as n, round(quantile_cont(amount,0.25),6) as q1, round(quantile_cont(amount,0.75),6) as q3 from present""")
def agg8(spark, sf):
    present = drop_missing(staged_sales(spark, sf), REQUIRED)
    return exact_quantiles(present, "amount", {"q1": 0.25, "q3": 0.75}).select(
        "n", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3")
    )


@query("agg8_exact_quantiles_by_group", f"""with {PRESENT_SQL}
select region, count(*) as n, round(quantile_cont(amount,0.25),6) as q1, round(quantile_cont(amount,0.75),6) as q3
from present group by 1""")
def agg8_grouped(spark, sf):
    present = drop_missing(staged_sales(spark, sf), REQUIRED)
    return exact_quantiles(present, "amount", {"q1": 0.25, "q3": 0.75}, by=["region"]).select(
        "region", "n", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3")
    )


@query("agg9_global_mean", f"with {PRESENT_SQL} select {AVG_SQL} as mean_amount from present")
def agg9(spark, sf):
    return drop_missing(sales(spark, sf), REQUIRED).agg(mean(F.col("amount")).alias("mean_amount"))


@query("agg10_positive_ratio",
       f"with {LABELED_SQL} select cast(sum(high_value) as double)/count(*) as positive_ratio from labeled")
def agg10(spark, sf):
    present = drop_missing(staged_sales(spark, sf), REQUIRED)
    return positive_ratio(label_above_mean(present, "amount", "high_value"), "high_value")


@query("agg11_crosstab", f"with {CLEAN_SQL} select region, category, count(*) as n from cleaned group by 1, 2")
def agg11(spark, sf):
    return agg.crosstab(cleaned_sales(spark, sf), "region", "category")


@query("agg11_crosstab_wide", f"""with {SALES_SQL}
select region, count(*) filter (payment_method='1-URGENT') as "1-URGENT", count(*) filter (payment_method='2-HIGH') as "2-HIGH",
  count(*) filter (payment_method='3-MEDIUM') as "3-MEDIUM",
  count(*) filter (payment_method='4-NOT SPECIFIED') as "4-NOT SPECIFIED",
  count(*) filter (payment_method='5-LOW') as "5-LOW"
from sales where region is not null group by 1""")
def agg11_wide(spark, sf):
    methods = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return agg.crosstab_wide(sales(spark, sf), "region", "payment_method", methods)


@query("agg12_two_groups", f"""with {CLEAN_SQL}
select region, count(*) as n, {AVG_SQL} as mean_amount, round(stddev_samp(amount),6) as sd_amount
from cleaned where region in ('NATION_3','NATION_7') group by 1""")
def agg12(spark, sf):
    two = cleaned_sales(spark, sf).where(F.col("region").isin("NATION_3", "NATION_7"))
    return two.groupBy("region").agg(
        F.count("*").alias("n"),
        mean(F.col("amount")).alias("mean_amount"),
        F.round(F.stddev_samp("amount"), 6).alias("sd_amount"),
    )


NUMERIC = ["amount", "quantity", "unit_price", "customer_age"]


def corr_sql(source: str) -> str:
    """The matrix in long form, pair by pair."""
    return " union all ".join(
        f"select '{x}' as x, '{y}' as y, "
        + ("cast(1.0 as double) as r" if x == y else f"(select round(corr({x},{y}),9) from {source}) as r")
        for x in NUMERIC
        for y in NUMERIC
    )


@query("agg13_correlation_matrix", f"with {SALES_SQL} {corr_sql('sales')}")
def agg13(spark, sf):
    return correlation_long(sales(spark, sf), NUMERIC).withColumn("r", F.round("r", 9))


@query("agg14_grand_totals", f"""with {CLEAN_SQL},
a as (select sum(s) as t from (select {SUM_SQL} as s from cleaned group by region, category)),
b as (select sum(s) as t from (select {SUM_SQL} as s from cleaned group by order_date))
select round(a.t,2) as left_total, round(b.t,2) as right_total, abs(a.t-b.t)<=0.01 as agrees from a, b""")
def agg14(spark, sf):
    kept = cleaned_sales(spark, sf)
    left = agg.named_agg(kept, ["region", "category"], order=False)
    right = agg.named_agg(kept, ["order_date"], order=False)
    return reconcile.grand_totals(left, right, "total_amount").select(
        F.round("left_total", 2).alias("left_total"), F.round("right_total", 2).alias("right_total"), "agrees"
    )


@query("agg15_frequency", f"with {SALES_SQL} select category, count(*) as n from sales group by 1")
def agg15_frequency(spark, sf):
    return agg.frequency(sales(spark, sf), ["category"])


@query("agg15_grouped_sum", f"""with {SALES_SQL}
select region, substr(cast(order_date as varchar),1,7) as order_month, {NAMED} from sales group by 1, 2""")
def agg15_grouped(spark, sf):
    return agg.named_agg(agg.with_month(sales(spark, sf)), ["region", "order_month"])


@query("agg16_compare_groups", f"""with {SALES_SQL}
select category, count(amount) as n, {AVG_SQL} as mean, round(quantile_cont(amount,0.5),6) as median
from sales group by 1""")
def agg16(spark, sf):
    return agg.compare_groups(staged_sales(spark, sf), "category", "amount").withColumn(
        "median", F.round("median", 6)
    )


@query("srt1_descending_by_total", f"with {SALES_SQL} select category, {NAMED} from sales group by 1")
def srt1(spark, sf):
    return agg.named_agg(sales(spark, sf), ["category"])


@query("srt2_ascending_by_month", f"""with {SALES_SQL}
select substr(cast(order_date as varchar),1,7) as order_month, {NAMED} from sales group by 1""")
def srt2(spark, sf):
    return agg.monthly_trend(sales(spark, sf))


@query("top1_largest_five", f"""with {CLEAN_SQL}
select region, category, {NAMED} from cleaned group by 1, 2 order by total_amount desc, region, category limit 5""")
def top1(spark, sf):
    totals = agg.named_agg(cleaned_sales(spark, sf), ["region", "category"], order=False)
    return agg.top(totals, 5, "total_amount", ["region", "category"])


@query("top2_row_with_least", f"""with {SALES_SQL}, t as (select region, {SUM_SQL} as total_amount from sales
where region is not null group by 1)
select region, total_amount from t order by total_amount, region limit 1""")
def top2(spark, sf):
    present = sales(spark, sf).where(F.col("region").isNotNull())
    return agg.row_with_least(agg.named_agg(present, ["region"], order=False), "region", "total_amount")


EVENTS_TWICE = "(select * from events union all select * from events where event_id%10=0)"


@query("ded1_distinct_rows", f"select distinct * from {EVENTS_TWICE}")
def ded1(spark, sf):
    events = table(spark, sf, "events")
    return drop_duplicates(events.unionByName(events.where(F.col("event_id") % 10 == 0)))


@query("ded1_first_per_key", """select event_id, ts, user_id, event_type, value, props from
(select *, row_number() over (partition by user_id, event_type order by ts, event_id) as rn from events) where rn=1""")
def ded1_keyed(spark, sf):
    return drop_duplicates(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@query("rec1_by_key", f"""with {SALES_SQL},
a as (select region, {SUM_SQL} as v from sales group by 1),
b as (select region, v + case when region='NATION_5' then 5.0 else 0.0 end as v from a
      where region is null or region <> 'NATION_9'
      union all select 'NATION_X', cast(1.0 as double))
select coalesce(a.region, b.region) as region, a.v as left_value, b.v as right_value,
  round(abs(a.v-b.v),2) as abs_diff,
  case when b.v is null then 'left_only' when a.v is null then 'right_only'
       when abs(a.v-b.v)<=0.01 then 'match' else 'differs' end as status
from a full join b on a.region is not distinct from b.region""")
def rec1(spark, sf):
    left = agg.named_agg(sales(spark, sf), ["region"], order=False).select("region", "total_amount")
    shifted = F.col("total_amount") + F.when(F.col("region") == "NATION_5", 5.0).otherwise(0.0)
    right = (
        left.where(F.col("region").isNull() | (F.col("region") != "NATION_9"))
        .withColumn("total_amount", shifted)
        .unionByName(left.limit(1).select(F.lit("NATION_X").alias("region"), F.lit(1.0).alias("total_amount")))
    )
    return reconcile.by_key(left, right, ["region"], "total_amount").withColumn("abs_diff", F.round("abs_diff", 2))


@query("rec1_grand_total", f"""with {SALES_SQL}, a as (select {SUM_SQL} as t from sales)
select a.t as left_total, a.t as right_total, cast(0.0 as double) as abs_diff, true as agrees from a""")
def rec1_total(spark, sf):
    rows = sales(spark, sf)
    by_region = agg.named_agg(rows, ["region"], order=False).agg(F.round(F.sum("total_amount"), 2).alias("t"))
    all_rows = rows.agg(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("t"))
    return reconcile.grand_totals(by_region, all_rows, "t")


CHANGED_SQL = """changed as (select o_orderkey, o_custkey, o_totalprice + case when o_orderkey%2003=11 then 0.01 else 0 end as o_totalprice,
  case when o_orderkey%2503=13 then null else o_orderstatus end as o_orderstatus from orders where o_orderkey%3001<>17
  union all select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders where o_orderkey%4001=19),
given as (select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders)"""


def changed_orders(spark, sf):
    """The orders and a copy with some prices, states, missing and repeated rows changed."""
    given = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    key = F.col("o_orderkey")
    changed = given.where(key % 3001 != 17).withColumns({
        "o_totalprice": F.col("o_totalprice") + F.when(key % 2003 == 11, 0.01).otherwise(0.0),
        "o_orderstatus": F.when(key % 2503 != 13, F.col("o_orderstatus")),
    })
    return given, changed.unionByName(given.where(key % 4001 == 19))


@query("rec1_row_differences", f"""with {CHANGED_SQL},
sides as (select *, 1 as l, 0 as r from given union all select *, 0, 1 from changed)
select o_orderkey, o_custkey, o_totalprice, o_orderstatus, cast(sum(l) as bigint) as left_rows, cast(sum(r) as bigint) as right_rows
from sides group by 1, 2, 3, 4 having sum(l)<>sum(r)""")
def rec1_differences(spark, sf):
    return hashtree.row_differences(*changed_orders(spark, sf), ["o_orderkey"])


@query("rec1_tables_agree", f"""with {CHANGED_SQL},
sides as (select *, 1 as l, 0 as r from given union all select *, 0, 1 from changed),
more as (select sum(l)-sum(r) as d from sides group by o_orderkey, o_custkey, o_totalprice, o_orderstatus)
select 'changed' as pair, (select count(*) from given) as left_rows, (select count(*) from changed) as right_rows,
  cast(sum(greatest(d,0)) as bigint) as left_only, cast(sum(greatest(-d,0)) as bigint) as right_only, false as agrees from more
union all select 'same', count(*), count(*), 0, 0, true from given""")
def rec1_agree(spark, sf):
    given, changed = changed_orders(spark, sf)
    shuffled = given.repartition(7, "o_custkey")
    found = hashtree.tables_agree(given, changed, ["o_orderkey"]).select(F.lit("changed").alias("pair"), "*")
    return found.unionByName(hashtree.tables_agree(given, shuffled, ["o_orderkey"]).select(F.lit("same").alias("pair"), "*"))
