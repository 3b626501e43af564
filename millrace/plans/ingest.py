"""Landed records to tables: parse, validate, split, attach one-row references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.validation import Field, good_rows, require_valid, validate_json
from millrace.session import stage
from millrace.sources.payloads import COUNTRY_FIELDS, IP_FIELDS, flat_record, weather_rows
from millrace.sources.sinks import write_csv, write_rejects

# The fields of a small sales record, in the order they are stored.
SALES_FIELDS = (
    Field("month", "string", min_length=1),
    Field("region", "string", min_length=1),
    Field("amount", "float", gt=0),
    Field("category", "string"),
)


def split_records(
    lines: DataFrame, text: str, fields: Sequence[Field], valid_path: str, reject_path: str
) -> None:
    """Write the good records as CSV and the rejects, with reasons, as JSON lines. The
    check runs once; its result is staged for the two writers."""
    checked = stage(validate_json(lines, text, fields), "checked")
    write_csv(good_rows(checked), valid_path)
    write_rejects(checked, reject_path)


def attach_one_row(df: DataFrame, reference: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add values of a one-row table to every row (new name -> reference column)."""
    found = reference.select(*[F.col(c).alias(n) for n, c in columns.items()]).take(2)
    if len(found) != 1:
        raise ValueError("the reference must have exactly one row")
    return df.withColumns({n: F.lit(found[0][n]).cast(reference.schema[c].dataType) for n, c in columns.items()})


def enriched_weather(
    weather: DataFrame,
    country: DataFrame,
    ip: DataFrame,
    text: str = "value",
    keep: Sequence[str] = (),
    strict: bool = True,
) -> DataFrame:
    """``time_str, temp, precip_prob, country, ip``. Bad weather rows are left out; a bad
    country or address record stops the job."""
    rows = good_rows(weather_rows(weather, text, keep, strict))
    named = attach_one_row(rows, require_valid(flat_record(country, text, COUNTRY_FIELDS)), {"country": "name"})
    return attach_one_row(named, require_valid(flat_record(ip, text, IP_FIELDS)), {"ip": "ip"})
