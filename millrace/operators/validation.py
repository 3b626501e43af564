"""Row validation by declared constraints.

Every rule is a column expression, so a whole table is checked in one pass and the check
also runs on a stream. All errors of a row are kept in a list beside the unchanged row;
a field reports its first problem only: presence, type, then bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import lenient_double

ERROR_TYPE = "struct<type:string,loc:array<string>,msg:string,input:string,ctx:map<string,string>>"

# Error types and their messages.
MESSAGES = {
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "less_than_equal": "Input should be less than or equal to {}",
    "less_than": "Input should be less than {}",
    "greater_than_equal": "Input should be greater than or equal to {}",
    "greater_than": "Input should be greater than {}",
    "string_too_long": "String should have at most {} character{}",
    "string_too_short": "String should have at least {} character{}",
    "json_invalid": "Invalid JSON",
    "model_type": "Input should be an object",
    "list_type": "Input should be a valid list",
    "uneven_arrays": "Parallel arrays should have equal lengths",
}


@dataclass(frozen=True)
class Field:
    """A field of a record and what it must satisfy. ``source`` is its key in a payload."""

    name: str
    kind: str = "any"  # "string", "float" or "any"
    source: str | None = None
    required: bool = True
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None
    min_length: int | None = None
    max_length: int | None = None

    @property
    def key(self) -> str:
        return self.source or self.name


def error_of(kind: str, key: str | None, shown: Column, *bound: tuple[str, float | int]) -> Column:
    msg = MESSAGES[kind]
    if bound:
        number = bound[0][1]
        msg = msg.format(repr(int(number) if float(number).is_integer() else number), "" if number == 1 else "s")
    ctx = [F.lit(str(x)) for pair in bound for x in pair]
    return F.struct(
        F.lit(kind).alias("type"),
        (F.array(F.lit(key)) if key else F.array()).alias("loc"),
        F.lit(msg).alias("msg"),
        shown.cast("string").alias("input"),
        (F.create_map(*ctx) if ctx else F.lit(None)).cast("map<string,string>").alias("ctx"),
    ).cast(ERROR_TYPE)


def _bound_errors(f: Field, value: Column, shown: Column) -> list[tuple[Column, Column]]:
    """(violated, error) pairs in the order they are looked at. NaN violates any bound."""
    out = []
    number = value.cast("double") if any(b is not None for b in (f.le, f.lt, f.ge, f.gt)) else None
    for kind, name, bound, ok in (
        ("less_than_equal", "le", f.le, lambda v, b: v <= b),
        ("less_than", "lt", f.lt, lambda v, b: v < b),
        ("greater_than_equal", "ge", f.ge, lambda v, b: v >= b),
        ("greater_than", "gt", f.gt, lambda v, b: v > b),
    ):
        if bound is not None:
            bad = F.isnan(number) | ~ok(number, F.lit(float(bound)))
            out.append((bad, error_of(kind, f.key, shown, (name, float(bound)))))
    if f.max_length is not None:
        bad = F.length(value) > f.max_length
        out.append((bad, error_of("string_too_long", f.key, shown, ("max_length", f.max_length))))
    if f.min_length is not None:
        bad = F.length(value) < f.min_length
        out.append((bad, error_of("string_too_short", f.key, shown, ("min_length", f.min_length))))
    return out


def _first_error(checks: list[tuple[Column, Column]]) -> Column:
    if not checks:
        return F.lit(None).cast(ERROR_TYPE)
    return reduce(lambda acc, c: acc.when(*c), checks[1:], F.when(*checks[0]))


def _typed_field(df: DataFrame, f: Field) -> tuple[Column, Column]:
    """(value, error) of a field held in a column of a declared type."""
    c = F.col(f.key)
    dtype = df.schema[f.key].dataType
    if isinstance(dtype, T.VariantType):
        return _variant_field(c, f)
    checks: list[tuple[Column, Column]] = []
    value = c
    if f.required:
        checks.append((c.isNull(), error_of("missing", f.key, F.lit(None))))
    if f.kind == "string" and not isinstance(dtype, T.StringType):
        checks.append((c.isNotNull(), error_of("string_type", f.key, c)))
        value = F.lit(None).cast("string")
    elif f.kind == "float":
        if isinstance(dtype, T.StringType):
            value = lenient_double(c)
            checks.append((c.isNotNull() & value.isNull(), error_of("float_parsing", f.key, c)))
        else:
            value = c.cast("double")
    checks += _bound_errors(f, value, c)
    return value, _first_error(checks)


def _variant_field(v: Column, f: Field) -> tuple[Column, Column]:
    """(value, error) of a field whose JSON type is still known."""
    jtype = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    is_text = jtype == "STRING"
    shown = F.when(is_text, text).otherwise(F.to_json(v))
    absent = v.isNull()
    checks: list[tuple[Column, Column]] = []
    if f.required:
        checks.append((absent, error_of("missing", f.key, F.lit(None))))
    is_number = jtype.isin("BIGINT", "DOUBLE", "FLOAT") | jtype.startswith("DECIMAL")
    if f.kind == "string":
        value = F.when(is_text, text)
        checks.append((~absent & ~is_text, error_of("string_type", f.key, shown)))
    elif f.kind == "float":
        value = (
            F.when(is_number, F.try_variant_get(v, "$", "double"))
            .when(is_text, lenient_double(text))
            .when(jtype == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
        )
        checks.append((is_text & value.isNull(), error_of("float_parsing", f.key, shown)))
        checks.append((~absent & value.isNull(), error_of("float_type", f.key, shown)))
    else:
        value = text
    checks += _bound_errors(f, value, shown)
    return value, _first_error(checks)


def validate(df: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """Check the columns of ``df``. Result: ``keep`` columns, ``row`` (the unchanged input
    fields), the parsed fields, and ``errors``."""
    states = [(f, *_typed_field(df, f)) for f in fields]
    return df.select(
        *keep,
        F.struct(*[F.col(f.key) for f in fields]).alias("row"),
        *[value.alias(f.name) for f, value, _ in states],
        F.array_compact(F.array(*[e for *_, e in states])).alias("errors"),
    )


def validate_json(df: DataFrame, text: str, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """Check one JSON object per row, with JSON types respected: the number 5 is not a
    string, and the text "3.5" is accepted where a number is wanted. Unknown keys are
    ignored. ``row`` is the unchanged text."""
    doc = F.try_parse_json(F.col(text))
    parsed = df.select(*keep, F.col(text).alias("row"), doc.alias("_doc")).withColumn(
        "_kind", F.schema_of_variant("_doc")
    )
    states = [(f, *_variant_field(F.try_variant_get("_doc", f"$['{f.key}']", "variant"), f)) for f in fields]
    is_object = F.col("_kind").startswith("OBJECT")
    errors = (
        F.when(F.col("_doc").isNull(), F.array(error_of("json_invalid", None, F.col("row"))))
        .when(~is_object, F.array(error_of("model_type", None, F.col("row"))))
        .otherwise(F.array_compact(F.array(*[e for *_, e in states])))
    )
    return parsed.select(
        *keep, "row", *[F.when(is_object, value).alias(f.name) for f, value, _ in states], errors.alias("errors")
    )


def good_rows(checked: DataFrame) -> DataFrame:
    """Rows without errors, with the parsed fields only."""
    return checked.where(F.size("errors") == 0).drop("row", "errors")


def reject_records(checked: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``row`` and ``error`` of every row that failed."""
    return checked.where(F.size("errors") > 0).select(*keep, "row", F.col("errors").alias("error"))


def reject_documents(checked: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The rejects as documents: ``row`` an object, and every ``input`` and bound with its own JSON type.

    A row that was text is parsed; text that is no JSON stays text. Numbers are numbers, also
    inside ``error``, where ``input`` is the value of the field that ``loc`` names.
    """
    is_text = isinstance(checked.schema["row"].dataType, T.StringType)
    rejects = reject_records(checked, keep)
    as_json = F.col("row") if is_text else F.to_json("row", {"ignoreNullFields": "false"})
    rejects = rejects.withColumn("_values", F.from_json(as_json, "map<string,variant>"))
    typed = lambda text: F.coalesce(F.try_parse_json(text), text.cast("variant"))
    errors = F.transform("error", lambda e: F.struct(
        e["type"].alias("type"), e["loc"].alias("loc"), e["msg"].alias("msg"),
        F.coalesce(F.try_element_at(F.col("_values"), F.get(e["loc"], F.lit(0))), e["input"].cast("variant")).alias("input"),
        F.transform_values(e["ctx"], lambda _, v: typed(v)).alias("ctx"),
    ))
    row = typed(F.col("row")) if is_text else F.col("row")
    return rejects.select(*keep, row.alias("row"), errors.alias("error"))


def quarantine(checked: DataFrame, path: str, mode: str = "error") -> None:
    """Write good and bad rows in one pass, partitioned by ``is_valid``."""
    checked.withColumn("is_valid", F.size("errors") == 0).write.partitionBy("is_valid").mode(mode).parquet(path)


def raise_on_error(checked: DataFrame) -> DataFrame:
    """The good rows; the job that reads them stops at the first bad one. Nothing is read
    ahead of that job."""
    first = F.get("errors", F.lit(0))
    why = F.concat_ws(": ", F.concat_ws(".", first["loc"]), first["msg"])
    ok = F.when(F.size("errors") == 0, True).otherwise(F.raise_error(why).cast("boolean"))
    return checked.where(ok).drop("row", "errors")


def require_valid(checked: DataFrame) -> DataFrame:
    """The good rows when there is no bad one; otherwise an error naming the first. Looks
    at once, so it suits small reference records; use ``raise_on_error`` for tables."""
    bad = checked.where(F.size("errors") > 0).select("errors").first()
    if bad is not None:
        first = bad["errors"][0]
        raise ValueError(f"{'.'.join(first['loc']) or 'record'}: {first['msg']} [{first['type']}]")
    return good_rows(checked)


def error_counts(checked: DataFrame) -> DataFrame:
    """``field, error_type, n`` over all rejects."""
    return (
        checked.select(F.explode("errors").alias("e"))
        .groupBy(F.get("e.loc", F.lit(0)).alias("field"), F.col("e.type").alias("error_type"))
        .agg(F.count("*").alias("n"))
        .orderBy("field", "error_type")
    )
