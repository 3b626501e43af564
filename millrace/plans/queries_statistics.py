"""Queries: tests, association, collinearity."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import association, correlation, statistics
from millrace.plans.queries_aggregates import NUMERIC, corr_sql
from millrace.plans.registry import CLEAN_SQL, query
from millrace.plans.sales import cleaned_sales, table

A, B = "NATION_3", "NATION_7"


def ttest_sql(column: str, a: str, b: str) -> str:
    """The statistic by its formula, the p-value by Simpson integration of the density."""
    return f"""{CLEAN_SQL},
side as (select
  count(*) filter ({column}='{a}') as n_a, count(*) filter ({column}='{b}') as n_b,
  avg(amount) filter ({column}='{a}') as mean_a, avg(amount) filter ({column}='{b}') as mean_b,
  var_samp(amount) filter ({column}='{a}') as var_a, var_samp(amount) filter ({column}='{b}') as var_b from cleaned),
stat as (select *, n_a+n_b-2 as dof,
  (mean_a-mean_b)/sqrt(((n_a-1)*var_a+(n_b-1)*var_b)/(n_a+n_b-2)*(1.0/n_a+1.0/n_b)) as t from side),
curve as (select sum((case when i=0 or i=4000 then 1 when i%2=1 then 4 else 2 end) *
  pow(1+pow(i*abs(t)/4000,2)/dof, -(dof+1)/2.0))*abs(t)/4000/3 *
  max(exp(lgamma((dof+1)/2.0)-lgamma(dof/2.0))/sqrt(dof*pi())) as area
  from stat, range(4001) r(i) group by t)"""


def ttest_rows(df):
    return df.withColumns({
        "mean_a": F.round("mean_a", 6), "mean_b": F.round("mean_b", 6),
        "t_stat": F.round("t_stat", 7), "p_value": F.round("p_value", 6),
    })


def ttest_select(a: str, b: str) -> str:
    return f"""select '{a}' as group_a, '{b}' as group_b, n_a, n_b, round(mean_a,6) as mean_a, round(mean_b,6) as mean_b,
  round(t,7) as t_stat, cast(dof as bigint) as dof, round(1-2*area,6) as p_value from stat, curve"""


@query("st1_ttest", f"with {ttest_sql('region', A, B)} {ttest_select(A, B)}")
def st1(spark, sf):
    return ttest_rows(statistics.ttest(cleaned_sales(spark, sf), "region", A, B, "amount"))


CHI2_SQL = f"""{CLEAN_SQL},
grid as (select r.region, c.category, coalesce(o.n,0) as o, r.n as rn, c.n as cn, t.n as n from
  (select region, count(*) as n from cleaned group by 1) r,
  (select category, count(*) as n from cleaned group by 1) c,
  (select count(*) as n from cleaned) t
  left join (select region as g, category as h, count(*) as n from cleaned group by 1, 2) o on g=r.region and h=c.category),
chi as (select sum(pow(o-rn*cn::double/n,2)/(rn*cn::double/n)) as chi2, max(n) as n,
  count(distinct region) as n_rows, count(distinct category) as n_cols from grid),
chid as (select *, (n_rows-1)*(n_cols-1) as dof from chi),
tail as (select sum(exp(-chi2/2+k*ln(chi2/2)-lgamma(k+1))) as p from chid, range(1000) r(k) where k<dof/2)"""


@query("st2_chi_square", f"""with {CHI2_SQL} select round(chi2,6) as chi2, round(p,8) as p_value, cast(dof as bigint) as dof,
  cast(n as bigint) as n, n_rows, n_cols from chid, tail""")
def st2(spark, sf):
    return statistics.chi2_test(cleaned_sales(spark, sf), "region", "category").withColumns(
        {"chi2": F.round("chi2", 6), "p_value": F.round("p_value", 8)}
    )


YES, NO = "the two are associated", "the two are independent"


@query("st3_verdict", f"""with {CHI2_SQL}
select case when p<0.05 then 'p < 0.05: {YES}' else 'p >= 0.05: {NO}' end as verdict from tail""")
def st3(spark, sf):
    result = statistics.chi2_test(cleaned_sales(spark, sf), "region", "category")
    return result.select(statistics.verdict(F.col("p_value"), YES, NO).alias("verdict"))


@query("st4_ttest_by_mode", f"with {ttest_sql('payment_method', '1-URGENT', '5-LOW')} {ttest_select('1-URGENT', '5-LOW')}")
def st4(spark, sf):
    return ttest_rows(statistics.ttest(cleaned_sales(spark, sf), "payment_method", "1-URGENT", "5-LOW", "amount"))


@query("st5_correlation_after_cleaning", f"with {CLEAN_SQL} {corr_sql('cleaned')}")
def st5(spark, sf):
    return correlation.correlation_long(cleaned_sales(spark, sf), NUMERIC).withColumn("r", F.round("r", 9))


def vif3_sql(x: str, y: str, z: str) -> str:
    """Inverse diagonal of a 3 x 3 correlation matrix in closed form."""
    return f"""r as (select corr({x},{y}) as xy, corr({x},{z}) as xz, corr({y},{z}) as yz from features),
d as (select *, 1+2*xy*xz*yz-xy*xy-xz*xz-yz*yz as det from r)"""


@query("st6_vif", f"""with {CLEAN_SQL}, features as (select quantity, unit_price, customer_age from cleaned),
{vif3_sql('quantity', 'unit_price', 'customer_age')}
select 'quantity' as feature, round((1-yz*yz)/det,7) as vif from d
union all select 'unit_price', round((1-xz*xz)/det,7) from d
union all select 'customer_age', round((1-xy*xy)/det,7) from d""")
def st6(spark, sf):
    return correlation.vif(cleaned_sales(spark, sf), ["quantity", "unit_price", "customer_age"]).withColumn(
        "vif", F.round("vif", 7)
    )


@query("st7_cramers_v", f"""with {CHI2_SQL} select 'region' as x, 'category' as y, round(chi2,6) as chi2,
  round(sqrt(chi2/(n*(least(n_rows,n_cols)-1))),9) as cramers_v from chid""")
def st7(spark, sf):
    return statistics.cramers_v(cleaned_sales(spark, sf), "region", "category").withColumns(
        {"chi2": F.round("chi2", 6), "cramers_v": F.round("cramers_v", 9)}
    )


CATEGORIES = ["region", "category", "payment_method", "customer_gender", "age_band", "n", "month", "parity", "cheap", "set"]
CATEGORIES_SQL = f"""{CLEAN_SQL},
wide as (select region, category, payment_method, customer_gender, customer_age//10 as age_band, order_id%7 as n,
  month(order_date) as month, case when order_id%3=0 then null else order_id%2 end as parity, quantity<25 as cheap,
  case when region='NATION_3' then null else order_id%4 end as "set" from cleaned),
long as (select row_number() over () as r, * from wide)"""


def pair_sql(x: str, y: str) -> str:
    """Chi-square and V of one pair over its full grid; two columns of two values are corrected."""
    return f"""select '{x}' as x, '{y}' as y, case when (n_rows-1)*(n_cols-1)=1 then corrected else plain end as chi2,
  cast((n_rows-1)*(n_cols-1) as bigint) as dof, n, least(n_rows,n_cols)-1 as least from (
  select sum(pow(o-e,2)/e) as plain, sum(pow(abs(o-e)-least(0.5,abs(o-e)),2)/e) as corrected, any_value(n) as n,
    count(distinct a) as n_rows, count(distinct b) as n_cols from (
    select a, b, coalesce(o,0) as o, ra*cb::double/n as e, n from
      (select "{x}" as a, count(*) as ra from wide where "{x}" is not null and "{y}" is not null group by 1)
      cross join (select "{y}" as b, count(*) as cb from wide where "{x}" is not null and "{y}" is not null group by 1)
      cross join (select count(*) as n from wide where "{x}" is not null and "{y}" is not null)
      left join (select "{x}" as a, "{y}" as b, count(*) as o from wide group by 1, 2) using (a, b)))"""


@query("st7_cramers_v_matrix", f"with {CATEGORIES_SQL}, v as (" + " union all ".join(
    pair_sql(x, y) for i, x in enumerate(CATEGORIES) for y in CATEGORIES[i + 1:])
    + ") select x, y, round(chi2,5) as chi2, dof, n, round(sqrt(chi2/(n*least)),8) as cramers_v from v")
def st7_matrix(spark, sf):
    """All pairs of ten columns, one of them named like a count, from one scan."""
    wide = cleaned_sales(spark, sf).select(
        "region", "category", "payment_method", "customer_gender", F.expr("customer_age div 10").alias("age_band"),
        (F.col("order_id") % 7).alias("n"), F.month("order_date").alias("month"),
        F.when(F.col("order_id") % 3 != 0, F.col("order_id") % 2).alias("parity"), (F.col("quantity") < 25).alias("cheap"),
        F.when(F.col("region") != "NATION_3", F.col("order_id") % 4).alias("set"),
    )
    return association.cramers_v_matrix(wide, CATEGORIES).withColumns(
        {"chi2": F.round("chi2", 5), "cramers_v": F.round("cramers_v", 8)}
    )


SURVEY = {f"q{i}": (f"l_partkey*{i + 1} % {17 + i} + l_quantity*{i % 5}", 5 + i) for i in range(36)}
SURVEY_SQL = "select " + ", ".join(
    f"case when (l_orderkey+l_partkey)%{m}=0 then null else {e} end as {q}" for q, (e, m) in SURVEY.items()) + " from lineitem"


@query("agg13_survey_correlation", f"with survey as ({SURVEY_SQL}), r as (select " + ", ".join(
    f"corr({x},{y}) as {x}_{y}" for i, x in enumerate(SURVEY) for y in list(SURVEY)[i + 1:])
    + " from survey) select split_part(pair,'_',1) as x, split_part(pair,'_',2) as y, round(r,6) as r from (unpivot r on * into name pair value r)")
def agg13_survey(spark, sf):
    """Many columns with values missing in different rows: every pair over the rows with both."""
    survey = table(spark, sf, "lineitem").selectExpr(
        *[f"case when (l_orderkey+l_partkey)%{m}=0 then null else {e} end as {q}" for q, (e, m) in SURVEY.items()]
    )
    place = F.array(*[F.lit(q) for q in SURVEY])
    found = correlation.correlation_long(survey, list(SURVEY))
    return found.where(F.array_position(place, F.col("x")) < F.array_position(place, F.col("y"))).withColumn("r", F.round("r", 6))


@query("st8_drop_collinear", f"""with {CLEAN_SQL},
features as (select quantity, quantity*unit_price as gross, customer_age, amount from cleaned),
{vif3_sql('quantity', 'gross', 'customer_age')},
v as (select 'quantity' as feature, (1-yz*yz)/det as vif, (select corr(quantity,amount) from features) as tr from d
union all select 'gross', (1-xz*xz)/det, (select corr(gross,amount) from features) from d
union all select 'customer_age', (1-xy*xy)/det, (select corr(customer_age,amount) from features) from d)
select feature, round(vif,3) as vif, round(tr,9) as target_r,
  vif<=5 or abs(tr)=(select max(abs(tr)) from v where vif>5) as kept from v""")
def st8(spark, sf):
    df = cleaned_sales(spark, sf).withColumn("gross", F.col("quantity") * F.col("unit_price"))
    out = correlation.drop_collinear(df, ["quantity", "gross", "customer_age"], "amount")
    return out.withColumns({"vif": F.round("vif", 3), "target_r": F.round("target_r", 9)})
