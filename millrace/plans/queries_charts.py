"""Queries: the reduced series behind charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import chartdata
from millrace.operators.aggregates import monthly_total
from millrace.operators.correlation import correlation_long
from millrace.plans.queries_aggregates import NAMED, NUMERIC, corr_sql
from millrace.plans.registry import CLEAN_SQL, SUM_SQL, query
from millrace.plans.sales import cleaned_sales


@query("ch1_histogram", f"""with {CLEAN_SQL},
s as (select count(*) as n, min(amount) as lo, max(amount) as hi, quantile_cont(amount,0.75)-quantile_cont(amount,0.25) as iqr
  from cleaned),
b as (select *, cast(ceil((hi-lo)/least(greatest(2.0*iqr*pow(n,-1.0/3.0), (hi-lo)/sqrt(n)/2.0), (hi-lo)/(log2(n)+1.0))) as bigint) as bins from s),
c as (select least(cast(floor((amount-lo)/(hi-lo)*bins) as bigint), bins-1) as bin, count(*) as n from cleaned, b group by 1)
select r.bin, round(lo+r.bin*((hi-lo)/bins),6) as left_edge, round(lo+(r.bin+1)*((hi-lo)/bins),6) as right_edge,
  coalesce(c.n,0) as n from b, (select unnest(range(bins)) as bin from b) r left join c on c.bin=r.bin""")
def ch1(spark, sf):
    return chartdata.histogram(cleaned_sales(spark, sf), "amount").withColumns(
        {e: F.round(e, 6) for e in ("left_edge", "right_edge")}
    )


@query("ch2_density", f"""with {CLEAN_SQL},
s as (select count(*) as n, stddev_samp(amount) as sd, min(amount) as lo, max(amount) as hi from cleaned),
h as (select *, sd*pow(n,-0.2) as h from s),
grid as (select i as point, lo+i*((hi-lo)/199) as x from h, range(200) g(i))
select cast(point as int) as point, round(any_value(x),6) as x,
  round(sum(exp(-pow((x-amount)/h,2)/2))/any_value(n*h*sqrt(2*pi()))*1e6,5) as density_e6 from grid, cleaned, h group by point""")
def ch2(spark, sf):
    return chartdata.density(cleaned_sales(spark, sf), "amount").select(
        "point", F.round("x", 6).alias("x"), F.round(F.col("density") * 1e6, 5).alias("density_e6")
    )


@query("ch3_box_summary", f"""with {CLEAN_SQL},
q as (select region, count(*) as n, quantile_cont(amount,0.25) as q1, quantile_cont(amount,0.5) as median,
  quantile_cont(amount,0.75) as q3 from cleaned group by 1)
select q.region, any_value(n) as n, round(any_value(q1),6) as q1, round(any_value(median),6) as median, round(any_value(q3),6) as q3,
  min(amount) filter (amount>=q1-1.5*(q3-q1)) as whisker_low, max(amount) filter (amount<=q3+1.5*(q3-q1)) as whisker_high,
  count(*) filter (amount<q1-1.5*(q3-q1) or amount>q3+1.5*(q3-q1)) as outliers
from q join cleaned on q.region=cleaned.region group by 1""")
def ch3(spark, sf):
    return chartdata.box_summary(cleaned_sales(spark, sf), "region", "amount").withColumns(
        {c: F.round(c, 6) for c in ("q1", "median", "q3")}
    )


@query("ch4_monthly_line", f"""with {CLEAN_SQL}
select substr(cast(order_date as varchar),1,7) as order_month, {SUM_SQL} as total_amount from cleaned group by 1""")
def ch4(spark, sf):
    return monthly_total(cleaned_sales(spark, sf))


@query("ch5_correlation_heatmap", f"with {CLEAN_SQL} {corr_sql('cleaned')}")
def ch5(spark, sf):
    return correlation_long(cleaned_sales(spark, sf), NUMERIC).withColumn("r", F.round("r", 9))


@query("ch6_grouped_bars", f"with {CLEAN_SQL} select region, category, {NAMED} from cleaned group by 1, 2")
def ch6(spark, sf):
    return chartdata.grouped_bars(cleaned_sales(spark, sf), "region", "category", "amount")


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("ch6_grouped_bars_wide", f"with {CLEAN_SQL} select region, " + ", ".join(
    f"cast(sum(cast(amount as decimal(18,2))) filter (category='{t}') as double) as \"{t}\"" for t in TYPES)
    + " from cleaned group by 1")
def ch6_wide(spark, sf):
    return chartdata.grouped_bars_wide(cleaned_sales(spark, sf), "region", "category", "amount", TYPES)
