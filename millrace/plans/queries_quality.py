"""Queries: row validation, cleaning, fences, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import total
from millrace.operators import validation as val
from millrace.operators.cleaning import cleaning_report, drop_missing, fence_report, iqr_fence
from millrace.operators.profile import consistency_report, missing_report, schema_profile
from millrace.operators.validation import Field
from millrace.plans.ingest import SALES_FIELDS, split_records
from millrace.plans.registry import CLEAN_SQL, PRESENT_SQL, SALES_SQL, SUM_SQL, query
from millrace.plans.sales import REQUIRED, cleaned_sales, sales, staged_sales, table
from millrace.session import scratch_path
from millrace.sources.payloads import COUNTRY_FIELDS, flat_record
from millrace.sources.readers import read_csv

FIELDS = (
    Field("kind", "string", min_length=1),
    Field("amount", "float", gt=0),
    Field("pct", "float", ge=0, le=100),
    Field("code", "string", min_length=2, max_length=2),
)

RECORDS_SQL = """records as (select event_id,
  case when event_id%40=3 then '' else event_type end as kind,
  case when event_id%50=4 then null when event_id%60=5 then -value when event_id%70=6 then 0.0 else value end as amount,
  case when event_id%30=7 then 150.0 when event_id%80=9 then -1.0 else cast(event_id%101 as double) end as pct,
  case when event_id%45=8 then 'NLD' else 'NL' end as code from events)"""
ERRORS_SQL = RECORDS_SQL + """, problems as (
  select event_id, 'kind' as field, 'string_too_short' as error_type, kind as input from records where length(kind)<1
  union all select event_id, 'amount', 'missing', null from records where amount is null
  union all select event_id, 'amount', 'greater_than', cast(amount as varchar) from records where not amount>0
  union all select event_id, 'pct', 'less_than_equal', cast(pct as varchar) from records where pct>100
  union all select event_id, 'pct', 'greater_than_equal', cast(pct as varchar) from records where pct<0
  union all select event_id, 'code', 'string_too_long', code from records where length(code)>2)"""


def records(spark, sf):
    """Records over ``events`` that break each rule at fixed positions."""
    at = lambda m, r: F.col("event_id") % m == r
    return table(spark, sf, "events").select(
        "event_id",
        F.when(at(40, 3), "").otherwise(F.col("event_type")).alias("kind"),
        F.when(at(50, 4), F.lit(None)).when(at(60, 5), -F.col("value")).when(at(70, 6), 0.0)
        .otherwise(F.col("value")).alias("amount"),
        F.when(at(30, 7), 150.0).when(at(80, 9), -1.0).otherwise((F.col("event_id") % 101).cast("double")).alias("pct"),
        F.when(at(45, 8), "NLD").otherwise("NL").alias("code"),
    )


@query("dq1_valid_rows", f"""with {ERRORS_SQL}
select event_id, kind, amount, pct, code from records where event_id not in (select event_id from problems)""")
def dq1(spark, sf):
    return val.good_rows(val.validate(records(spark, sf), FIELDS, ["event_id"]))


@query("dq1_rejects", f"""with {ERRORS_SQL}
select r.event_id, r.kind, r.amount, r.pct, r.code, p.n_errors from records r join
(select event_id, cast(count(*) as int) as n_errors from problems group by 1) p on r.event_id=p.event_id""")
def dq1_rejects(spark, sf):
    bad = val.reject_records(val.validate(records(spark, sf), FIELDS, ["event_id"]), ["event_id"])
    return bad.select("event_id", "row.*", F.size("error").alias("n_errors"))


@query("dq2_errors", f"with {ERRORS_SQL} select event_id, field, error_type, input from problems")
def dq2(spark, sf):
    checked = val.validate(records(spark, sf), FIELDS, ["event_id"])
    return checked.select("event_id", F.explode("errors").alias("e")).select(
        "event_id", F.col("e.loc")[0].alias("field"), F.col("e.type").alias("error_type"), F.col("e.input").alias("input")
    )


@query("dq1_split_records", """with r as (select o_orderkey as k, case when o_orderkey%50=1 then '' else
  substr(cast(cast(o_orderdate as date) as varchar),1,7) end as month, case when o_orderkey%60=2 then '' else o_orderstatus end as region,
  case when o_orderkey%70=3 then -o_totalprice when o_orderkey%80=4 then 0 else o_totalprice end as amount from orders),
e as (select k, month='' as m, region='' as g, amount<=0 as a from r)
select 'valid' as side, month as name, count(*) as n, cast(sum(cast(amount as decimal(18,2))) as double) as amount
from r where month<>'' and region<>'' and amount>0 group by month
union all select 'reject', 'month string_too_short', count(*), null from e where m
union all select 'reject', 'region string_too_short', count(*), null from e where g
union all select 'reject', 'amount greater_than', count(*), null from e where a""")
def dq1_split(spark, sf):
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice")
    lines = table(spark, sf, "orders").select(F.to_json(F.struct(
        F.when(key % 60 == 2, "").otherwise(F.col("o_orderstatus")).alias("region"),
        F.col("o_orderpriority").alias("category"),
        F.when(key % 70 == 3, -amount).when(key % 80 == 4, 0.0).otherwise(amount).alias("amount"),
        F.when(key % 50 == 1, "").otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("month"),
    )).alias("line"))
    valid, rejects = scratch_path(spark, "valid-csv"), scratch_path(spark, "rejects-json")
    split_records(lines, "line", SALES_FIELDS, valid, rejects)
    good = read_csv(spark, valid, "month string, region string, amount double, category string")
    bad = spark.read.schema("row string, error array<struct<type:string,loc:array<string>>>").json(rejects)
    return good.groupBy(F.lit("valid").alias("side"), F.col("month").alias("name")).agg(
        F.count("*").alias("n"), total(F.col("amount")).alias("amount")
    ).unionByName(
        bad.select(F.explode("error").alias("e"))
        .groupBy(F.lit("reject").alias("side"), F.concat_ws(" ", F.col("e.loc")[0], "e.type").alias("name"))
        .agg(F.count("*").alias("n"), F.lit(None).cast("double").alias("amount"))
    )


JSON_KINDS = """kinds as (select event_id,
  case when event_id%11=1 then 'string_type' end as kind_error,
  case event_id%13 when 1 then 'missing' when 2 then 'float_type' when 3 then 'float_parsing'
    when 4 then 'less_than_equal' when 5 then 'float_parsing' end as pct_error from events)"""


@query("dq2_json_types", f"""with {JSON_KINDS}
select field, error_type, count(*) as n from (
  select 'kind' as field, kind_error as error_type from kinds union all select 'pct', pct_error from kinds)
where error_type is not null group by 1, 2""")
def dq2_json(spark, sf):
    text = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
    n = F.col("event_id") % 13
    pct = (
        F.when(n == 2, "null").when(n == 3, '"abc"').when(n == 4, '"NaN"').when(n == 5, '"1d"')
        .when(n == 6, "true").when(n == 7, '" 30 "').otherwise((F.col("event_id") % 101).cast("string"))
    )
    kind = F.when(F.col("event_id") % 11 == 1, "5").otherwise(text(F.col("event_type")))
    lines = table(spark, sf, "events").select(
        F.concat(
            F.lit('{"kind":'), kind, F.when(n == 1, "").otherwise(F.concat(F.lit(',"pct":'), pct)), F.lit(',"zz":1}')
        ).alias("line")
    )
    return val.error_counts(
        val.validate_json(lines, "line", (Field("kind", "string"), Field("pct", "float", ge=0, le=100)))
    )


@query("dq3_fail_fast_record", "select n_name as name, 'NL' as alpha2_code from nation where n_nationkey=0")
def dq3(spark, sf):
    landed = table(spark, sf, "nation").where("n_nationkey = 0").select(
        F.to_json(F.struct(F.col("n_name").alias("name"), F.lit("NL").alias("alpha2Code"))).alias("value")
    )
    return val.require_valid(flat_record(landed, "value", COUNTRY_FIELDS))


@query("dq4_fence_report", f"""with {CLEAN_SQL}
select round(q1,6) as q1, round(q3,6) as q3, round(iqr,6) as iqr, round(lower,6) as lower, round(upper,6) as upper,
  (select count(*) from present) as rows_before, (select count(*) from cleaned) as rows_after,
  (select count(*) from present)-(select count(*) from cleaned) as rows_removed from fence""")
def dq4(spark, sf):
    present = drop_missing(staged_sales(spark, sf), REQUIRED)
    report = fence_report(present, "amount", iqr_fence(present, "amount"))
    return report.withColumns({c: F.round(c, 6) for c in ("q1", "q3", "iqr", "lower", "upper")})


@query("dq5_cleaning_report", f"""with {PRESENT_SQL}
select count(*) as rows_before, (select count(*) from present) as rows_after,
  count(*)-(select count(*) from present) as rows_dropped, count(*) filter (region is null) as missing_region,
  count(*) filter (category is null) as missing_category, count(*) filter (amount is null) as missing_amount from sales""")
def dq5(spark, sf):
    return cleaning_report(sales(spark, sf), REQUIRED)


@query("dq6_missing_report", f"""with {SALES_SQL}, counts as (
  select 'region' as column_name, count(*) filter (region is null) as missing_count, count(*) as n from sales
  union all select 'category', count(*) filter (category is null), count(*) from sales
  union all select 'amount', count(*) filter (amount is null), count(*) from sales)
select column_name, missing_count, round(missing_count*100.0::double/n,3) as missing_pct from counts where missing_count>0""")
def dq6(spark, sf):
    return missing_report(sales(spark, sf))


@query("dq7_consistency", f"""with {SALES_SQL}, c as (
  select count(*) as checked, count(*) filter (abs(amount-quantity*unit_price)>1.0) as mismatched
  from sales where amount is not null and quantity is not null and unit_price is not null)
select checked, mismatched, round(mismatched*100.0::double/checked,3) as mismatch_pct from c""")
def dq7(spark, sf):
    return consistency_report(sales(spark, sf), "amount", ("quantity", "unit_price"))


SALES_TYPES = [
    ("order_id", "bigint"), ("order_date", "date"), ("region", "string"), ("category", "string"),
    ("product_name", "string"), ("quantity", "double"), ("unit_price", "double"), ("payment_method", "string"),
    ("customer_age", "int"), ("customer_gender", "string"), ("amount", "double"),
]


@query("dq8_schema_profile", f"with {SALES_SQL} " + " union all ".join(
    f"select cast({i} as int) as position, '{c}' as column_name, '{t}' as data_type, count({c}) as non_null, "
    f"count(*) as row_count, cast({len(SALES_TYPES)} as int) as column_count from sales"
    for i, (c, t) in enumerate(SALES_TYPES)))
def dq8(spark, sf):
    return schema_profile(sales(spark, sf))


@query("dq9_cleaned_rows", f"""with {CLEAN_SQL} select region, category, payment_method, customer_gender,
  count(*) as n, {SUM_SQL} as total_amount, min(amount) as least, max(amount) as most from cleaned group by 1,2,3,4""")
def dq9(spark, sf):
    return cleaned_sales(spark, sf).groupBy("region", "category", "payment_method", "customer_gender").agg(
        F.count("*").alias("n"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_amount"),
        F.min("amount").alias("least"),
        F.max("amount").alias("most"),
    )


WIDE = [
    (f"{c}_{j}", c, 19 + 3 * j + i)
    for i, c in enumerate(["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                           "l_returnflag", "l_linestatus", "l_shipdate", "l_linenumber", "l_orderkey"])
    for j in range(10)
]


@query("dq10_wide_missing_table", "with counts as (" + " union all ".join(
    f"select '{n}' as column_name, count(*) filter ((l_orderkey+l_partkey)%{m}=0) as missing_count, count(*) as n from lineitem"
    for n, _, m in WIDE)
    + ") select column_name, missing_count, round(missing_count*100.0::double/n,3) as missing_pct from counts")
def dq10(spark, sf):
    wide = table(spark, sf, "lineitem").selectExpr(
        *[f"case when (l_orderkey + l_partkey) % {m} != 0 then {c} end as {n}" for n, c, m in WIDE]
    )
    return missing_report(wide, only_missing=False)
