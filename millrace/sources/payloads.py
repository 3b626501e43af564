"""Landed JSON payloads, one document per row, turned into rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.validation import Field, error_of, validate, validate_json

# The hourly forecast payload and the records made from payloads.
HOURLY_SCHEMA = (
    "hourly struct<time:array<variant>,temperature_2m:array<variant>,precipitation_probability:array<variant>>"
)
HOURLY_ARRAYS = {
    "time": "hourly.time",
    "temp": "hourly.temperature_2m",
    "precip_prob": "hourly.precipitation_probability",
}
WEATHER_FIELDS = (
    Field("time_str", "string", source="time"),
    Field("temp", "float"),
    Field("precip_prob", "float", ge=0, le=100),
)
COUNTRY_FIELDS = (
    Field("name", "string"),
    Field("alpha2_code", "string", source="alpha2Code", min_length=2, max_length=2),
)
IP_FIELDS = (
    Field("ip", "string", source="query"),
    Field("country", "string"),
    Field("city", "string"),
    Field("isp", "string"),
)


def _or_empty(path: str) -> Column:
    """The array, or an empty one where the payload lacks the key."""
    return F.coalesce(F.col(path), F.array())


def _sizes(arrays: dict[str, str]) -> list[Column]:
    return [F.size(_or_empty(p)) for p in arrays.values()]


def _sizes_equal(arrays: dict[str, str]) -> Column:
    sizes = _sizes(arrays)
    return reduce(lambda a, b: a & b, [s == sizes[0] for s in sizes[1:]], F.lit(True))


def _zipped(arrays: dict[str, str]) -> Column:
    """Structs of the values at each position, up to the longest array."""
    return F.arrays_zip(*[_or_empty(p).alias(n) for n, p in arrays.items()])


def zip_arrays(df: DataFrame, arrays: dict[str, str], keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """One row per position of parallel arrays (name of the new column -> array path).

    ``arrays_zip`` would fill short arrays with nulls, so lengths are compared first.
    Unequal lengths stop the job, or with ``strict=False`` the payload is skipped here:
    ``uneven_arrays`` lists such payloads and ``merged_positions`` keeps their values.
    """
    if strict:
        stop = F.raise_error(F.lit("parallel arrays differ in length"))
        checked = F.when(_sizes_equal(arrays), _zipped(arrays)).otherwise(stop)
        return df.select(*keep, F.inline(checked)).toDF(*keep, *arrays)
    return df.where(_sizes_equal(arrays)).select(*keep, F.inline(_zipped(arrays))).toDF(*keep, *arrays)


def merged_positions(df: DataFrame, arrays: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per position up to the longest array: ``keep``, ``position``, the values, and ``absent``.

    ``absent`` names the arrays that end before the position, which tells a missing value from
    a null in the array; it is empty in whole rows. Nothing is dropped.
    """
    sized = df.select(*keep, F.array(*_sizes(arrays)).alias("_sizes"), F.posexplode(_zipped(arrays)).alias("position", "_v"))
    short = F.array_compact(F.array(*[F.when(F.col("_sizes")[i] <= F.col("position"), F.lit(n)) for i, n in enumerate(arrays)]))
    return sized.select(*keep, "position", *[F.col(f"_v.{n}").alias(n) for n in arrays], short.alias("absent"))


def uneven_arrays(df: DataFrame, arrays: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Payloads whose parallel arrays differ in length, with the lengths."""
    return df.where(~_sizes_equal(arrays)).select(
        *keep, *[F.size(_or_empty(p)).alias(f"{n}_size") for n, p in arrays.items()]
    )


def parse_hourly(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Parse hourly payload text; values keep their JSON type."""
    return df.select(*keep, F.from_json(text, HOURLY_SCHEMA).alias("_p")).select(*keep, "_p.*")


def parse_arrays(df: DataFrame, text: str, arrays: dict[str, str] = HOURLY_ARRAYS, keep: Sequence[str] = ()) -> DataFrame:
    """The parallel arrays of each payload by their new names, and why a payload has none.

    The text is parsed once. ``fault`` is an error record or null: JSON that does not parse, a
    null text, a null or any other type for an object or a list, or arrays of unequal length,
    whose sizes are in its ``ctx``. Only an absent key is an empty list.
    """
    parents = sorted({p.rsplit(".", 1)[0] for p in arrays.values() if "." in p})
    places = [*parents, *arrays.values()]
    parsed = df.select(*keep, F.col(text).alias("_text"), F.try_parse_json(F.col(text)).alias("_doc"))
    found = parsed.select(
        *keep, "_text", F.schema_of_variant("_doc").alias("_type"),
        *[F.try_variant_get("_doc", f"$.{p}", "variant").alias(f"_at{i}") for i, p in enumerate(places)],
    )
    shown = F.col("_text")
    fault = F.when(F.col("_type").isNull(), error_of("json_invalid", None, shown))
    fault = fault.when(~F.col("_type").startswith("OBJECT"), error_of("model_type", None, shown))
    for i, path in enumerate(places):
        kind, start = ("model_type", "OBJECT") if path in parents else ("list_type", "ARRAY")
        fault = fault.when(~F.schema_of_variant(f"_at{i}").startswith(start), error_of(kind, path, shown))
    lists = {n: F.try_variant_get(f"_at{len(parents) + i}", "$", "array<variant>") for i, n in enumerate(arrays)}
    read = found.select(*keep, "_text", fault.alias("_fault"), *[c.alias(n) for n, c in lists.items()])
    sizes = F.create_map(*[x for n in arrays for x in (F.lit(n), F.size(_or_empty(n)).cast("string"))])
    uneven = error_of("uneven_arrays", None, shown).withField("ctx", sizes)
    own = {n: n for n in arrays}
    return read.select(*keep, *arrays, F.when(F.col("_fault").isNull() & ~_sizes_equal(own), uneven).otherwise(F.col("_fault")).alias("fault"))


def weather_rows(df: DataFrame, text: str, keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Validated weather rows (with ``row`` and ``errors``) of hourly payloads, in one pass.

    A payload that cannot be read, or whose arrays differ in length, stops the job, or with
    ``strict=False`` becomes one row without values whose error names the fault and holds the
    text. No payload is lost.
    """
    parsed = parse_arrays(df, text, HOURLY_ARRAYS, keep)
    names = {n: n for n in HOURLY_ARRAYS}
    if strict:
        why = F.when(F.col("fault")["type"] == "uneven_arrays", F.lit("parallel arrays differ in length"))
        why = why.otherwise(F.concat(F.lit("unreadable payload: "), F.col("fault")["msg"]))
        parsed = parsed.where(F.when(F.col("fault").isNull(), True).otherwise(F.raise_error(why).cast("boolean")))
        return validate(zip_arrays(parsed, names, keep), WEATHER_FIELDS, keep)
    values = _zipped(names)
    # a payload with a fault has one position without values, which carries the fault
    nothing = F.array(F.struct(*[F.lit(None).cast("variant").alias(n) for n in names]))
    positions = F.when(F.col("fault").isNull(), values).otherwise(nothing)
    rows = parsed.select(*keep, F.col("fault").alias("_fault"), F.inline(positions)).toDF(*keep, "_fault", *names)
    checked = validate(rows, WEATHER_FIELDS, [*keep, "_fault"])
    fault = F.col("_fault")
    errors = F.when(fault.isNull(), F.col("errors")).otherwise(F.array(fault))
    return checked.withColumns({"row": F.when(fault.isNull(), F.col("row")), "errors": errors}).drop("_fault")


def flat_record(df: DataFrame, text: str, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """Renamed flat fields of a JSON object; an absent key is an error of the row."""
    return validate_json(df, text, fields, keep)
