import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import validation as V
from millrace.operators.validation import Field
from millrace.plans.ingest import attach_one_row, enriched_weather
from millrace.sources.sinks import write_rejects
from millrace.sources import payloads as P

PCT = (Field("s", "string"), Field("f", "float", ge=0, le=100))


def check(rows, *docs, fields=PCT):
    df = rows("id int, j string", list(enumerate(docs)))
    return V.validate_json(df, "j", fields, ["id"])


def types(checked):
    return {r["id"]: [e["type"] for e in r["errors"]] for r in checked.collect()}


EDGES = [  # document, error types
    ('{"s":5,"f":1}', ["string_type"]),
    ('{"s":"x","f":"3.5"}', []),
    ('{"s":"x","f":" 3 "}', []),
    ('{"s":"x","f":true}', []),
    ('{"s":"x","f":"abc"}', ["float_parsing"]),
    ('{"s":"x","f":"1d"}', ["float_parsing"]),
    ('{"s":"x","f":null}', ["float_type"]),
    ('{"s":"x","f":[1]}', ["float_type"]),
    ('{"s":"x"}', ["missing"]),
    ('{"s":"x","f":"NaN"}', ["less_than_equal"]),
    ('{"s":"x","f":0}', []),
    ('{"s":"x","f":100}', []),
    ('{"s":"x","f":100.5}', ["less_than_equal"]),
    ('{"s":"x","f":-1}', ["greater_than_equal"]),
    ('{"s":"","f":1}', []),
    ('{"s":"x","f":1,"other":2}', []),
    ("{}", ["missing", "missing"]),
    ("not json", ["json_invalid"]),
    ("[1]", ["model_type"]),
    ("null", ["model_type"]),
]


def test_json_edges(rows):
    got = types(check(rows, *[d for d, _ in EDGES]))
    assert got == {i: want for i, (_, want) in enumerate(EDGES)}


def test_unbounded_float_takes_nan(rows):
    assert types(check(rows, '{"f":"NaN"}', fields=(Field("f", "float"),))) == {0: []}


def test_parsed_values(rows):
    got = [r["f"] for r in check(rows, '{"s":"","f":"3.5"}', '{"s":"","f":true}', '{"s":"","f":2}').orderBy("id").collect()]
    assert got == [3.5, 1.0, 2.0]


SALES = (
    Field("region", "string", min_length=1),
    Field("category", "string"),
    Field("amount", "float", gt=0),
    Field("month", "string", min_length=1),
)


def test_rejects_keep_the_row_and_say_why(rows):
    df = rows(
        "region string, category string, amount double, month string",
        [("north", "tea", 12.5, "2021-07"), ("south", "tea", -3.25, "2021-08"), ("", "oil", -1.0, ""),
         ("west", "oil", 77.0, ""), ("", "salt", 4.0, "2021-09")],
    )
    checked = V.validate(df, SALES)
    assert V.good_rows(checked).count() == 1
    bad = [json.loads(x) for x in V.reject_records(checked).toJSON().collect()]
    by = {tuple(sorted(e["type"] for e in b["error"])): b for b in bad}
    assert by[("greater_than", "string_too_short", "string_too_short")]["row"] == {"region": "", "category": "oil", "amount": -1.0, "month": ""}
    low = [b for b in bad if b["row"]["amount"] == -3.25][0]["error"]
    assert low == [{"type": "greater_than", "loc": ["amount"], "msg": "Input should be greater than 0", "input": "-3.25", "ctx": {"gt": "0.0"}}]
    short = [b for b in bad if b["row"]["month"] == "" and b["row"]["region"] == "west"][0]["error"][0]
    assert short["msg"] == "String should have at least 1 character" and short["ctx"] == {"min_length": "1"}


def test_typed_columns(rows):
    df = rows("s int, f string, b boolean", [(1, " 2 ", True), (None, "x", None)])
    checked = V.validate(df, (Field("s", "string"), Field("f", "float"), Field("b", "float")))
    got = [[e["type"] for e in r["errors"]] for r in checked.collect()]
    assert got == [["string_type"], ["missing", "float_parsing", "missing"]]


def test_require_valid(rows):
    ok = check(rows, '{"s":"a","f":1}')
    assert V.require_valid(ok).count() == 1
    with pytest.raises(ValueError, match="f: Input should be less than or equal to 100"):
        V.require_valid(check(rows, '{"s":"a","f":101}'))


def test_raise_on_error_is_lazy(rows):
    bad = V.raise_on_error(check(rows, '{"s":"a","f":1}', '{"s":"a","f":101}'))
    with pytest.raises(Exception, match="f: Input should be less than or equal to 100"):
        bad.collect()
    assert V.raise_on_error(check(rows, '{"s":"a","f":1}')).count() == 1


def test_quarantine_writes_both_sides(rows, spark, tmp_path):
    path = str(tmp_path / "q")
    V.quarantine(check(rows, '{"s":"a","f":1}', '{"s":"a","f":101}').drop("row"), path)
    back = spark.read.schema("id int, is_valid boolean").parquet(path)
    assert {(r["is_valid"], r["id"]) for r in back.collect()} == {(True, 0), (False, 1)}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(-200, 200)), min_size=1, max_size=20))
def test_good_and_bad_add_up(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, f double")
    checked = V.validate(df, (Field("f", "float", ge=0, le=100),), ["id"])
    good = {r["id"] for r in V.good_rows(checked).collect()}
    bad = {r["id"] for r in V.reject_records(checked, ["id"]).collect()}
    assert good | bad == set(range(len(values))) and not good & bad
    assert good == {i for i, v in enumerate(values) if v is not None and 0 <= v <= 100}


HOURLY = '{"hourly":{"time":["t0","t1"],"temperature_2m":[1.5,2],"precipitation_probability":[41,117]}}'


def test_weather_keeps_one_of_two(rows):
    checked = P.weather_rows(rows("j string", [(HOURLY,)]), "j")
    assert [tuple(r) for r in V.good_rows(checked).collect()] == [("t0", 1.5, 41.0)]


def test_absent_arrays_and_keys(rows):
    df = rows("j string", [('{"hourly":{}}',), ("{}",)])
    assert P.weather_rows(df, "j").count() == 0


def test_broken_payloads_are_rejected(rows):
    arrays = '{"hourly":{"time":%s,"temperature_2m":[],"precipitation_probability":[]}}'
    broken = ['{"hourly":{"time":["t"', "[1]", '{"hourly":null}', '{"hourly":"x"}', arrays % "null", arrays % '"t"', arrays % "{}", "", None]
    df = rows("id int, j string", list(enumerate([HOURLY, "{}", '{"hourly":{}}', *broken])))
    checked = P.weather_rows(df, "j", ["id"], strict=False)
    assert [r["id"] for r in V.good_rows(checked).collect()] == [0]
    found = {r["id"]: r["error"][0] for r in V.reject_records(checked, ["id"]).collect() if r["id"]}
    assert {i: e["input"] for i, e in found.items()} == {i + 3: t for i, t in enumerate(broken)}
    kinds = ["json_invalid", "model_type", "model_type", "model_type", "list_type", "list_type", "list_type", "json_invalid", "json_invalid"]
    assert [found[i + 3]["type"] for i in range(len(broken))] == kinds
    for text in broken:
        with pytest.raises(Exception, match="unreadable payload"):
            P.weather_rows(rows("j string", [(text,)]), "j").collect()


def test_uneven_arrays(rows):
    uneven = '{"hourly":{"time":["t"],"temperature_2m":[1,2],"precipitation_probability":[3]}}'
    df = rows("j string", [(uneven,), (HOURLY,)])
    with pytest.raises(Exception, match="differ in length"):
        P.weather_rows(df, "j").collect()
    checked = P.weather_rows(df, "j", strict=False)
    assert V.good_rows(checked).count() == 1
    (error,) = [r["error"][0] for r in V.reject_records(checked).collect() if r["row"] is None]
    assert (error["type"], error["input"], error["ctx"]) == ("uneven_arrays", uneven, {"time": "1", "temp": "2", "precip_prob": "1"})
    parsed = P.parse_hourly(df, "j")
    assert [tuple(r) for r in P.uneven_arrays(parsed, P.HOURLY_ARRAYS).collect()] == [(1, 2, 1)]


def test_reject_documents_keep_json_types(rows, spark, tmp_path):
    fields = [V.Field("kind", "string", min_length=1), V.Field("amount", "float", gt=0)]
    texts = ['{"kind":"","amount":-950,"more":[1]}', '{"amount":"x"}', "[1]", "{", '{"kind":5,"amount":true}']
    path = str(tmp_path / "rejects")
    write_rejects(V.validate_json(rows("j string", [(t,) for t in texts]), "j", fields), path)
    found = {json.dumps(d["row"]): d["error"] for d in (json.loads(r[0]) for r in spark.read.text(path).collect())}
    first = found['{"amount": -950, "kind": "", "more": [1]}']
    assert [(e["input"], e["ctx"]) for e in first] == [("", {"min_length": 1}), (-950, {"gt": 0.0})]
    assert [(e["type"], e["input"]) for e in found['{"amount": "x"}']] == [("missing", None), ("float_parsing", "x")]
    assert found["[1]"][0]["input"] == "[1]" and found['"{"'][0]["type"] == "json_invalid"
    assert found['{"amount": true, "kind": 5}'][0]["input"] == 5
    typed = rows("kind string, amount double", [("a", -2.5), ("b", None)])
    write_rejects(V.validate(typed, fields), path + "2")
    docs = sorted((json.loads(r[0]) for r in spark.read.text(path + "2").collect()), key=lambda d: d["row"]["kind"])
    assert docs[0]["row"] == {"kind": "a", "amount": -2.5} and docs[0]["error"][0]["input"] == -2.5
    assert docs[1]["row"] == {"kind": "b", "amount": None} and docs[1]["error"][0]["input"] is None


def test_positions_keep_what_uneven_arrays_hold(rows):
    uneven = '{"hourly":{"time":["t",null],"temperature_2m":[1,2,3],"precipitation_probability":[]}}'
    parsed = P.parse_arrays(rows("id int, j string", [(1, uneven), (2, "{}"), (3, HOURLY), (4, "[")]), "j", keep=["id"])
    assert {r["id"]: r["fault"] and r["fault"]["type"] for r in parsed.collect()} == {1: "uneven_arrays", 2: None, 3: None, 4: "json_invalid"}
    found = P.merged_positions(parsed, {n: n for n in P.HOURLY_ARRAYS}, ["id"])
    got = [(r["id"], r["position"], r["absent"]) for r in found.orderBy("id", "position").collect()]
    assert got == [(1, 0, ["precip_prob"]), (1, 1, ["precip_prob"]), (1, 2, ["time", "precip_prob"]), (3, 0, []), (3, 1, [])]


def test_a_payload_is_parsed_once(rows):
    plan = P.weather_rows(rows("id int, j string", [(1, HOURLY)]), "j", ["id"], strict=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1 and "from_json" not in plan.lower()


def test_country_and_address_records(rows):
    code = P.flat_record(rows("j string", [('{"name":"Netherlands","alpha2Code":"NLD"}',)]), "j", P.COUNTRY_FIELDS)
    assert [e["type"] for e in code.first()["errors"]] == ["string_too_long"]
    ip = P.flat_record(rows("j string", [('{"query":"192.0.2.44","country":"NL","city":"Delft","isp":"net"}',)]), "j", P.IP_FIELDS)
    assert tuple(V.good_rows(ip).first()) == ("192.0.2.44", "NL", "Delft", "net")


def test_enriched_weather(rows):
    weather = rows("value string", [(HOURLY,)])
    country = rows("value string", [('{"name":"Netherlands","alpha2Code":"NL"}',)])
    ip = rows("value string", [('{"query":"192.0.2.44","country":"NL","city":"Delft","isp":"net"}',)])
    out = enriched_weather(weather, country, ip)
    assert out.columns == ["time_str", "temp", "precip_prob", "country", "ip"]
    assert [tuple(r) for r in out.collect()] == [("t0", 1.5, 41.0, "Netherlands", "192.0.2.44")]
    with pytest.raises(ValueError):
        enriched_weather(weather, rows("value string", [('{"name":"Netherlands"}',)]), ip)


def test_reference_must_be_one_row(rows):
    with pytest.raises(ValueError):
        attach_one_row(rows("a int", [(1,)]), rows("b int", [(1,), (2,)]), {"b": "b"})
