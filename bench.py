"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to use (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default 8)
BENCH_RUNS     timed runs per query after one warm-up (default 3)
"""

from __future__ import annotations

import json
import os
import time

from millrace.operators import chartdata, correlation, profile, statistics, validation
from millrace.operators.aggregates import named_agg
from millrace.operators.cleaning import cleaning_report, drop_missing
from millrace.operators.duplicates import drop_duplicates
from millrace.operators.modeling import high_value_features
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.splits import stratified_split
from millrace.plans.queries_quality import FIELDS, records
from millrace.plans.sales import REQUIRED, cleaned_sales, sales, staged_sales, summaries, table
from millrace.session import local_session, scratch_path, stage
from millrace.sources.readers import read_csv
from millrace.sources.sinks import write_csv

NUMERIC = ["amount", "quantity", "unit_price", "customer_age"]
FEATURES = ["customer_age", "region", "category", "payment_method"]


def three_summaries(df) -> None:
    for result in summaries(df)[0].values():
        result.collect()


def staged_first(df):
    """The chain reads its input three times: joins and text parsing should run once."""
    return stage(df.select("region", "category", "payment_method", "order_date", "amount"), "bench-input")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    spark.sparkContext.setLogLevel("ERROR")

    staged = staged_sales(spark, sf_dir)
    csv_path = scratch_path(spark, "sales-csv")
    write_csv(staged, csv_path)
    kept = cleaned_sales(spark, sf_dir)
    present = drop_missing(staged, REQUIRED)

    def split() -> None:
        rows = stage(high_value_features(staged, REQUIRED, "amount", FEATURES, "high_value"), "features")
        for side in stratified_split(rows, "high_value"):
            side.groupBy("high_value").count().collect()

    queries = {
        "stage_sales": lambda: stage(sales(spark, sf_dir), "bench-sales"),
        "summaries_staged": lambda: three_summaries(staged),
        "summaries_csv": lambda: three_summaries(staged_first(read_csv(spark, csv_path, staged.schema))),
        "summaries_joined": lambda: three_summaries(staged_first(sales(spark, sf_dir))),
        "cleaning_report": lambda: cleaning_report(staged, REQUIRED).collect(),
        "missing_report": lambda: profile.missing_report(staged).collect(),
        "consistency": lambda: profile.consistency_report(staged, "amount", ("quantity", "unit_price")).collect(),
        "quantiles": lambda: exact_quantiles(present, "amount", {"q1": 0.25, "q3": 0.75}).collect(),
        "region_category": lambda: named_agg(kept, ["region", "category"]).collect(),
        "ttest": lambda: statistics.ttest(kept, "region", "NATION_3", "NATION_7", "amount").collect(),
        "chi_square": lambda: statistics.chi2_test(kept, "region", "category").collect(),
        "correlation": lambda: correlation.correlation_long(kept, NUMERIC).collect(),
        "vif": lambda: correlation.vif(kept, NUMERIC[1:]).collect(),
        "histogram": lambda: chartdata.histogram(kept, "amount").collect(),
        "density": lambda: chartdata.density(kept, "amount").collect(),
        "box_summary": lambda: chartdata.box_summary(kept, "region", "amount").collect(),
        "validate": lambda: validation.error_counts(validation.validate(records(spark, sf_dir), FIELDS)).collect(),
        "distinct_rows": lambda: drop_duplicates(table(spark, sf_dir, "events")).count(),
        "stratified_split": split,
    }
    seconds = {}
    for name, run in queries.items():
        run()
        start = time.perf_counter()
        for _ in range(runs):
            run()
        seconds[name] = round((time.perf_counter() - start) / runs, 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
