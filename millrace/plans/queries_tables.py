"""Queries: sources, sinks, projections, filters, scalar functions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.functions.columns import beyond_tolerance, lenient_double, missing, percent
from millrace.operators.aggregates import named_agg, with_month
from millrace.operators.cleaning import drop_missing, iqr_fence
from millrace.operators.modeling import label_above_mean, linear_pipeline
from millrace.operators.profile import missing_report
from millrace.operators.reconcile import column_agreement
from millrace.operators.validation import Field, good_rows, raise_on_error, validate
from millrace.plans.ingest import enriched_weather
from millrace.plans.queries_quality import ERRORS_SQL, FIELDS, records
from millrace.plans.registry import CLEAN_SQL, LABELED_SQL, PRESENT_SQL, SALES_SQL, SUM_SQL, query
from millrace.plans.sales import REQUIRED, cleaned_sales, sales, staged_sales, table
from millrace.session import scratch_path
from millrace.sources import clustered, payloads, sinks
from millrace.sources.multiline import csv_module_rows
from millrace.sources.readers import csv_table, read_csv, read_parquet, split_corrupt

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def landed_csv(spark, sf, name, columns=("*",)):
    path = scratch_path(spark, f"{name}-csv")
    sinks.write_csv(table(spark, sf, name).select(*columns), path)
    return path


# -- sources --------------------------------------------------------------------------

@query("src1_csv_read", "select * from customer")
def src1(spark, sf):
    path = landed_csv(spark, sf, "customer")
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_csv(spark, path, schema)


@query("src1_multiline_csv", r"""select doc_id, nullif(text,'') as text, lang from documents
union all select item_id, 'x'||chr(10)||'"'||text||'",'||chr(10)||chr(10)||'y', null from benchmark""")
def src1_multiline(spark, sf):
    """Texts with line breaks and quotes, read in byte ranges."""
    path = scratch_path(spark, "multiline-csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    items = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("doc_id"), F.concat(F.lit('x\n"'), "text", F.lit('",\n\ny')).alias("text"), F.lit(None).cast("string").alias("lang")
    )
    sinks.write_csv(docs.unionByName(items), path)
    return read_csv(spark, path, "doc_id bigint, text string, lang string", multi_line=True)


@query("src1_csv_inferred", "select c_mktsegment, count(*) as n, max(c_custkey) as top_key from "
       "(select c_mktsegment, cast(c_custkey as int) as c_custkey from customer) group by 1")
def src1_inferred(spark, sf):
    return read_csv(spark, landed_csv(spark, sf, "customer")).groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.max("c_custkey").alias("top_key")
    )


@query("src2_lazy_scan", "select o_orderkey, o_totalprice from orders where o_totalprice > 400000")
def src2(spark, sf):
    df = read_csv(spark, landed_csv(spark, sf, "orders", ORDER_COLS), ORDERS)
    return df.where("o_totalprice > 400000").select("o_orderkey", "o_totalprice")


@query("src3_sql_over_csv", """select o_orderpriority, count(*) as n,
  cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from orders group by 1""")
def src3(spark, sf):
    csv_table(spark, landed_csv(spark, sf, "orders", ORDER_COLS), "orders_csv", ORDERS)
    return spark.sql("""select o_orderpriority, count(*) as n,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from orders_csv group by 1""")


@query("src4_parquet_read", "select * from part")
def src4(spark, sf):
    return read_parquet(spark, f"{sf}/part.parquet")


@query("src5_csv_read_back", f"""with {CLEAN_SQL} select region, category, {SUM_SQL} as total_amount,
  {SUM_SQL}/count(amount) as avg_amount, count(amount) as item_count from cleaned group by 1, 2""")
def src5(spark, sf):
    result = named_agg(cleaned_sales(spark, sf), ["region", "category"])
    path = scratch_path(spark, "summary-csv")
    sinks.write_csv(result, path)
    return read_csv(spark, path, result.schema)


@query("src6_missing_path", " union all ".join(
    f"select '{t}' as table_name, true as found, count(*) as n from {t}" for t in ("lineitem", "orders", "events"))
    + " union all select 'absent', false, null")
def src6(spark, sf):
    out = None
    for name in ("lineitem", "orders", "events", "absent"):
        try:
            counted = read_parquet(spark, f"{sf}/{name}.parquet").agg(F.count("*").alias("n"))
            found = True
        except FileNotFoundError:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("n"))
            found = False
        row = counted.select(F.lit(name).alias("table_name"), F.lit(found).alias("found"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("src7_corrupt_rows", """select event_id%41=0 as corrupt, count(*) as n,
  sum(case when event_id%41<>0 then event_id else 0 end)::bigint as id_sum from events group by 1""")
def src7(spark, sf):
    path = scratch_path(spark, "ragged-csv")
    broken = F.col("event_id") % 41 == 0
    value = F.when(broken & (F.col("event_id") % 2 == 0), "x").otherwise(F.col("value").cast("string"))
    extra = F.when(broken & (F.col("event_id") % 2 == 1), ",9").otherwise("")
    lines = table(spark, sf, "events").select(
        F.concat_ws(",", F.col("event_id").cast("string"), "event_type", F.concat(value, extra)).alias("value")
    )
    lines.write.text(path)
    df = read_csv(spark, path, "event_id bigint, kind string, value double", keep_corrupt=True, header="false")
    good, bad = split_corrupt(df)
    return good.agg(F.lit(False).alias("corrupt"), F.count("*").alias("n"), F.sum("event_id").alias("id_sum")).unionByName(
        bad.agg(F.lit(True).alias("corrupt"), F.count("*").alias("n"), F.lit(0).cast("bigint").alias("id_sum"))
    )


def weather_payloads(spark, sf):
    """One hourly payload per event; some lack arrays, some have arrays of unequal length."""
    e, v = F.col("event_id"), F.col("value")
    probs = [(e % 101).cast("double"), F.when(e % 30 == 7, 150.0).otherwise(0.0), F.lit(100.0)]
    hourly = F.struct(
        F.array(*[F.concat(e.cast("string"), F.lit(f"-{i}")) for i in range(3)]).alias("time"),
        F.array(*[v + i for i in range(3)]).alias("temperature_2m"),
        F.when(e % 97 == 5, F.array(*probs[:2])).otherwise(F.array(*probs)).alias("precipitation_probability"),
    )
    return table(spark, sf, "events").select(
        "event_id",
        F.when(e % 89 == 3, F.lit('{"hourly":{}}')).otherwise(F.to_json(F.struct(hourly.alias("hourly")))).alias("value"),
    )


WEATHER_SQL = """hours as (select event_id, i, event_id||'-'||i as time_str, value+i as temp,
  case i when 0 then cast(event_id%101 as double) when 1 then (case when event_id%30=7 then 150.0 else 0.0 end)
    else 100.0 end::double as precip_prob
  from events, (select unnest([0,1,2]) as i) where event_id%89<>3 and event_id%97<>5)"""


@query("src8_parallel_arrays", f"with {WEATHER_SQL} select event_id, time_str, temp, precip_prob from hours where precip_prob<=100")
def src8(spark, sf):
    return good_rows(payloads.weather_rows(weather_payloads(spark, sf), "value", ["event_id"], strict=False))


@query("src8_uneven_arrays", """select event_id, cast(3 as int) as time_size, cast(3 as int) as temp_size,
  cast(2 as int) as precip_prob_size from events where event_id%97=5 and event_id%89<>3""")
def src8_uneven(spark, sf):
    parsed = payloads.parse_hourly(weather_payloads(spark, sf), "value", ["event_id"])
    return payloads.uneven_arrays(parsed, payloads.HOURLY_ARRAYS, ["event_id"])


@query("src8_merged_positions", """select event_id, cast(i as int) as position, event_id||'-'||i as time_str,
  event_id%97=5 and i=2 as cut from events, (select unnest([0,1,2]) as i) where event_id%89<>3""")
def src8_positions(spark, sf):
    """Every position of every payload; those after the end of an array say which one it is."""
    parsed = payloads.parse_arrays(weather_payloads(spark, sf), "value", keep=["event_id"])
    rows = payloads.merged_positions(parsed, {n: n for n in payloads.HOURLY_ARRAYS}, ["event_id"])
    cut = F.array_contains("absent", "precip_prob") & (F.size("absent") == 1) & F.col("precip_prob").isNull()
    return rows.select("event_id", "position", F.try_variant_get("time", "$", "string").alias("time_str"), cut.alias("cut"))


@query("src8_broken_payloads", """select case when event_id%7=1 then 'json_invalid' when event_id%7=2 then 'model_type'
  when event_id%7=3 then 'list_type' else 'uneven_arrays' end as fault, count(*) as n,
  cast(sum(case when event_id%7 not in (1,2,3) then 2 else 0 end) as bigint) as short_sizes
  from events where event_id%7 in (1,2,3) or (event_id%97=5 and event_id%89<>3) group by 1""")
def src8_broken(spark, sf):
    e, v = F.col("event_id"), F.col("value")
    broken = F.when(e % 7 == 1, F.substring(v, 1, 12)).when(e % 7 == 2, F.lit('{"hourly":null}')).when(e % 7 == 3, F.lit('{"hourly":{"time":"t"}}'))
    landed = weather_payloads(spark, sf).withColumn("value", F.coalesce(broken, v))
    rejects = payloads.weather_rows(landed, "value", ["event_id"], strict=False).where("row is null")
    error = F.col("errors")[0]
    short = F.coalesce(error["ctx"]["precip_prob"].cast("bigint"), F.lit(0).cast("bigint"))
    return rejects.groupBy(error["type"].alias("fault")).agg(F.count(F.lit(1)).alias("n"), F.sum(short).alias("short_sizes"))


@query("src9_flat_record", "select event_id, cast(json_extract(props,'$.k') as double) as seq from events")
def src9(spark, sf):
    checked = payloads.flat_record(
        table(spark, sf, "events"), "props", [Field("seq", "float", source="k")], ["event_id"]
    )
    return raise_on_error(checked)


@query("src10_two_readers", " union all ".join(
    f"select '{c}' as column_name, count({c}) as declared_rows, count({c}) as other_rows, true as agrees from orders"
    for c in ORDER_COLS))
def src10(spark, sf):
    """Spark's reader with declared types against records parsed by Python's csv module."""
    path = landed_csv(spark, sf, "orders", ORDER_COLS)
    other = csv_module_rows(spark, path, ORDER_COLS)
    schema = read_csv(spark, path, ORDERS).schema
    typed = other.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return column_agreement(read_csv(spark, path, ORDERS), typed).withColumnsRenamed({"left_rows": "declared_rows", "right_rows": "other_rows"})


ANSWERS = {f"a{i}": f"(o_custkey*{i + 3} + o_orderkey) % {i + 7}" for i in range(114)}


@query("src10_wide_survey", " union all ".join(
    f"select '{a}' as column_name, count({a}) as left_rows, count({a}){' - 1' if a == 'a70' else ''} as right_rows, "
    f"{'false' if a in ('a13', 'a70') else 'true'} as agrees from (select case when {e}<3 then {e} end as {a} from orders)"
    for a, e in ANSWERS.items()))
def src10_wide(spark, sf):
    """114 columns in two readers; the file of the second has one value altered and one emptied."""
    wide = table(spark, sf, "orders").selectExpr("o_orderkey", *[f"case when {e} < 3 then {e} end as {a}" for a, e in ANSWERS.items()])
    first, second = scratch_path(spark, "wide"), scratch_path(spark, "wide-altered")
    one = lambda a: wide.where(F.col(a).isNotNull()).agg(F.min("o_orderkey")).scalar() == F.col("o_orderkey")
    altered = wide.withColumns({"a13": F.when(one("a13"), F.lit(9)).otherwise(F.col("a13")), "a70": F.when(~one("a70"), F.col("a70"))})
    sinks.write_csv(wide.drop("o_orderkey"), first)
    sinks.write_csv(altered.drop("o_orderkey"), second)
    schema = ", ".join(f"{a} string" for a in ANSWERS)
    return column_agreement(read_csv(spark, first, schema), csv_module_rows(spark, second, list(ANSWERS)))


# -- sinks ----------------------------------------------------------------------------

@query("snk1_csv_write", "select p_partkey, p_name, p_type, p_retailprice from part")
def snk1(spark, sf):
    path = scratch_path(spark, "part-csv")
    sinks.write_csv(table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice"), path)
    return read_csv(spark, path, "p_partkey bigint, p_name string, p_type string, p_retailprice double")


@query("snk2_parquet_write", "select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders")
def snk2(spark, sf):
    path = scratch_path(spark, "orders-parquet")
    sinks.write_parquet(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), path)
    return read_parquet(spark, path)


@query("snk3_reject_report", f"""with {ERRORS_SQL}
select r.kind, r.amount, r.pct, r.code, p.field, p.error_type, p.input, count(*) as n
from problems p join records r on r.event_id=p.event_id group by all""")
def snk3(spark, sf):
    path = scratch_path(spark, "rejects-json")
    sinks.write_rejects(validate(records(spark, sf), FIELDS), path)
    schema = (
        "row struct<kind:string,amount:double,pct:double,code:string>, "
        "error array<struct<type:string,loc:array<string>,msg:string,input:string,ctx:map<string,string>>>"
    )
    # numbers are written as numbers, whose text says nothing about their type
    number = F.get("e.loc", F.lit(0)).isin("amount", "pct")
    shown = F.when(number, F.col("e.input").cast("double").cast("string")).otherwise(F.col("e.input"))
    return (
        spark.read.schema(schema).json(path)
        .select("row.*", F.explode("error").alias("e"))
        .groupBy("kind", "amount", "pct", "code", F.col("e.loc")[0].alias("field"),
                 F.col("e.type").alias("error_type"), shown.alias("input"))
        .agg(F.count("*").alias("n"))
    )


def _lines(spark, text):
    return spark.createDataFrame(
        list(enumerate(text.rstrip("\n").split("\n"))), "line_no int, line string"
    )


@query("snk4_markdown_table", f"""with {SALES_SQL},
t as (select category, {SUM_SQL} as total, count(*) as n from sales where category is not null group by 1)
select cast(row_number() over (order by total)+1 as int) as line_no,
  '| '||category||' | '||printf('%.2f', total)||' | '||n||' |' as line from t
union all select cast(0 as int), '| category | total | n |' union all select cast(1 as int), '|---|---|---|'""")
def snk4(spark, sf):
    present = sales(spark, sf).where(F.col("category").isNotNull())
    totals = present.groupBy("category").agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total"), F.count("*").alias("n")
    )
    return _lines(spark, sinks.markdown_table(totals, "total"))


@query("snk6_run_report", f"""with {SALES_SQL},
m as (select 'region' as c, count(*) filter (region is null) as k, count(*) as n from sales
  union all select 'category', count(*) filter (category is null), count(*) from sales
  union all select 'amount', count(*) filter (amount is null), count(*) from sales),
t as (select category, {SUM_SQL} as total, count(amount) as n from sales group by 1)
select '| '||c||' | '||k||' | '||printf('%.2f', round(k*100.0::double/n,3))||' |' as line from m
union all select '| '||coalesce(category,'')||' | '||printf('%.2f', total)||' | '||printf('%.2f', total/n)||' | '||n||' |' from t
union all select unnest(['# Sales run', '', '## Missing values', '', '| column_name | missing_count | missing_pct |',
  '|---|---|---|', '', '## Totals by category', '', '| category | total_amount | avg_amount | item_count |',
  '|---|---|---|---|', '', '## Note', '', 'Amounts are sums of single sales.'])""")
def snk6(spark, sf):
    path = scratch_path(spark, "report-md")
    raw = sales(spark, sf)
    sinks.write_report(spark, path, "Sales run", {
        "Missing values": missing_report(raw),
        "Totals by category": named_agg(raw, ["category"]),
        "Note": "Amounts are sums of single sales.",
    })
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("snk7_format_comparison", """select format, true as timed, n as n_rows, format='parquet' as smallest
  from (select count(*) as n from lineitem), (values ('csv'), ('parquet')) f(format)""")
def snk7(spark, sf):
    """Both formats were timed, hold all rows, and the columnar one is the smaller."""
    path = scratch_path(spark, "formats")
    source = table(spark, sf, "lineitem")
    found = sinks.compare_formats(source, path)
    counts = {f: spark.read.schema(source.schema).option("header", True).format(f).load(f"{path}/{f}").count() for f in ("csv", "parquet")}
    n_rows = F.element_at(F.create_map(*[F.lit(x) for pair in counts.items() for x in pair]), F.col("format")).cast("bigint")
    least = found.agg(F.min("bytes")).scalar()
    return found.select(
        "format", ((F.col("write_ms") > 0) & (F.col("read_ms") > 0)).alias("timed"), n_rows.alias("n_rows"),
        (F.col("bytes") == least).alias("smallest"),
    )


@query("snk5_saved_model", f"""with {PRESENT_SQL}
select category, count(*) as n, true as unbiased, true as same from present group by 1""")
def snk5(spark, sf):
    """A fitted regression, saved and loaded. With a level for each category, its predictions have the
    mean of the amounts in every category, and the loaded model gives the same ones."""
    df = drop_missing(staged_sales(spark, sf), REQUIRED)
    model = linear_pipeline(df, ["quantity", "unit_price"], ["category"], "amount").fit(df)
    loaded = PipelineModel.load(sinks.save_model(model, scratch_path(spark, "model")))
    first = model.transform(df).select(*df.columns, F.col("prediction").alias("fitted"))
    both = loaded.transform(first)
    off = F.abs(F.avg("prediction") - F.avg("amount"))
    return both.groupBy("category").agg(
        F.count("*").alias("n"), (off < F.avg("amount") * 1e-4).alias("unbiased"),
        F.bool_and(F.col("fitted") == F.col("prediction")).alias("same"),
    )


@query("snk2_clustered_fence", f"""with {CLEAN_SQL}
select region, count(*) as n, {SUM_SQL} as total_amount, true as fewer_files from cleaned group by 1""")
def snk2_clustered(spark, sf):
    """The fence over a table clustered by amount: the same rows from the files that overlap it."""
    rows = drop_missing(staged_sales(spark, sf), REQUIRED)
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(rows, path, "amount", max(1, rows.count() // 64))
    fence = iqr_fence(rows, "amount")
    kept = clustered.read_clustered(spark, path, "amount", fence.lower, fence.upper)
    opened, all_files = (len(df.inputFiles()) for df in (kept, spark.read.parquet(path)))
    total = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double")
    return kept.groupBy("region").agg(F.count("*").alias("n"), total.alias("total_amount"), F.lit(opened < all_files).alias("fewer_files"))


# -- projections ----------------------------------------------------------------------

@query("prj1_column_subset", f"with {SALES_SQL} select customer_age, region, category, payment_method from sales")
def prj1(spark, sf):
    return sales(spark, sf).select("customer_age", "region", "category", "payment_method")


@query("prj2_month_column", "select o_orderkey, substr(cast(cast(o_orderdate as date) as varchar),1,7) as order_month from orders")
def prj2(spark, sf):
    return with_month(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "order_month")


@query("prj3_attach_reference", f"""with {WEATHER_SQL} select event_id, time_str, temp, precip_prob,
  (select n_name from nation where n_nationkey=0) as country, '192.0.2.44' as ip from hours where precip_prob<=100""")
def prj3(spark, sf):
    nation = table(spark, sf, "nation").where("n_nationkey = 0")
    country = nation.select(F.to_json(F.struct(F.col("n_name").alias("name"), F.lit("NL").alias("alpha2Code"))).alias("value"))
    ip = nation.select(F.to_json(F.struct(
        F.lit("192.0.2.44").alias("query"), F.col("n_name").alias("country"), F.lit("c").alias("city"), F.lit("i").alias("isp")
    )).alias("value"))
    return enriched_weather(weather_payloads(spark, sf), country, ip, "value", ["event_id"], strict=False)


@query("prj4_field_alias", "select ts as time_str, value as temp from events")
def prj4(spark, sf):
    return table(spark, sf, "events").select(F.col("ts").alias("time_str"), F.col("value").alias("temp"))


@query("prj5_above_mean_label", f"""with {LABELED_SQL}
select high_value, count(*) as n, min(amount) as least, max(amount) as most from labeled group by 1""")
def prj5(spark, sf):
    present = drop_missing(staged_sales(spark, sf), REQUIRED)
    return label_above_mean(present, "amount", "high_value").groupBy("high_value").agg(
        F.count("*").alias("n"), F.min("amount").alias("least"), F.max("amount").alias("most")
    )


# -- filters --------------------------------------------------------------------------

@query("flt1_drop_missing", f"with {PRESENT_SQL} select order_id, region, category, amount from present")
def flt1(spark, sf):
    return drop_missing(sales(spark, sf), REQUIRED).select("order_id", "region", "category", "amount")


@query("flt2_within_fence", f"with {CLEAN_SQL} select order_id, region, category, amount from cleaned")
def flt2(spark, sf):
    return cleaned_sales(spark, sf).select("order_id", "region", "category", "amount")


@query("flt3_equality", f"with {CLEAN_SQL} select amount from cleaned where region='NATION_3'")
def flt3(spark, sf):
    return cleaned_sales(spark, sf).where(F.col("region") == "NATION_3").select("amount")


@query("flt4_beyond_tolerance", f"""with {SALES_SQL}
select order_id, amount, quantity*unit_price as expected from sales where abs(amount-quantity*unit_price)>1.0""")
def flt4(spark, sf):
    expected = F.col("quantity") * F.col("unit_price")
    return (
        sales(spark, sf)
        .where(beyond_tolerance(F.col("amount"), expected, 1.0))
        .select("order_id", "amount", expected.alias("expected"))
    )


@query("flt5_non_zero_counts", f"""with {SALES_SQL}
select 'region' as column_name, count(*) filter (region is null) as missing_count from sales
union all select 'category', count(*) filter (category is null) from sales
union all select 'amount', count(*) filter (amount is null) from sales""")
def flt5(spark, sf):
    return missing_report(sales(spark, sf)).select("column_name", "missing_count")


# -- scalar functions -----------------------------------------------------------------

@query("scl1_string_slice", "select o_orderkey, substr(o_orderpriority,1,7) as part from orders")
def scl1(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 7).alias("part"))


@query("scl2_date_as_text", "select o_orderkey, cast(cast(o_orderdate as date) as varchar) as day from orders")
def scl2(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day"))


@query("scl3_arithmetic", """select l_orderkey, l_partkey, abs(l_tax-l_discount) as gap, l_extendedprice*(1-l_discount) as net,
  case when l_discount=0 then null else l_tax/l_discount end as ratio from lineitem""")
def scl3(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.abs(F.col("l_tax") - F.col("l_discount")).alias("gap"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.try_divide("l_tax", "l_discount").alias("ratio"),
    )


@query("scl4_rounded_percent", """select l_returnflag, round(count(*) filter (l_discount>0.05)*100.0::double/count(*),3) as pct
  from lineitem group by 1""")
def scl4(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        percent(F.count_if(F.col("l_discount") > 0.05), F.count("*")).alias("pct")
    )


@query("scl5_null_flag", f"with {SALES_SQL} select order_id, cast(case when region is null then 1 else 0 end as int) as no_region from sales")
def scl5(spark, sf):
    return sales(spark, sf).select("order_id", F.when(F.col("region").isNull(), 1).otherwise(0).alias("no_region"))


@query("scl6_null_tests", f"""with {SALES_SQL} select count(*) as n from sales
  where region is not null and category is not null and amount is null""")
def scl6(spark, sf):
    df = sales(spark, sf)
    return df.where(~missing(df, "region") & ~missing(df, "category") & missing(df, "amount")).agg(F.count("*").alias("n"))


@query("scl7_comparisons", """select l_orderkey, l_partkey, l_quantity between 10 and 20 as within, l_quantity>=25 as high,
  l_tax=l_discount as same from lineitem""")
def scl7(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", q.between(10, 20).alias("within"), (q >= 25).alias("high"),
        (F.col("l_tax") == F.col("l_discount")).alias("same"),
    )


@query("scl8_default_for_absent_key",
       "select event_id, cast(case when event_id%89=3 then 0 else 3 end as int) as n_times from events")
def scl8(spark, sf):
    parsed = payloads.parse_hourly(weather_payloads(spark, sf), "value", ["event_id"])
    return parsed.select("event_id", F.size(F.coalesce("hourly.time", F.array())).alias("n_times"))


@query("scl9_length_limits", "select c_custkey, length(c_mktsegment) between 8 and 9 as fits from customer")
def scl9(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.length("c_mktsegment").between(8, 9).alias("fits"))


@query("scl10_lenient_number", """select event_id, case event_id%4 when 0 then cast(value as double) when 1 then value
  else null end as number from events""")
def scl10(spark, sf):
    shown = F.col("value").cast("string")
    n = F.col("event_id") % 4
    text = (
        F.when(n == 0, F.concat(F.lit(" "), shown, F.lit(" "))).when(n == 1, shown)
        .when(n == 2, F.concat(shown, F.lit("d"))).otherwise("abc")
    )
    return table(spark, sf, "events").select("event_id", lenient_double(text).alias("number"))
