"""CSV records that lie across byte ranges, against Spark's own multi-line reader."""

import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.sources import multiline as M
from millrace.sources.readers import CORRUPT, CSV_FORMAT, read_csv, split_corrupt

SCHEMA = "id bigint, t string, u string"


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 128 bytes: records lie across several."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def written(tmp_path, rows, name="f.csv", end="\n", header="id,t,u"):
    out = io.StringIO()
    out.write(header + end)
    csv.writer(out, lineterminator=end).writerows(rows)
    (tmp_path / name).write_bytes(out.getvalue().encode())


def spark_rows(spark, path):
    reader = spark.read.options(**CSV_FORMAT).option("multiLine", True).schema(SCHEMA)
    return sorted(map(tuple, reader.csv(str(path)).collect()), key=repr)


def own_rows(spark, path):
    return sorted(map(tuple, M.read_multiline_csv(spark, str(path), SCHEMA).collect()), key=repr)


TEXTS = [
    "plain", 'says "yes"', "a\nb", 'x\n"quoted",\n\ny', "", '"', '""', ",,,", "long " * 60, "many\nlines\n" * 40, "é\n日本", " blanks ", '\n"\n"\n', "end\n",
]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_sparks_reader(spark, tmp_path, small_ranges, end):
    rows = [(i, t, TEXTS[(i * 5) % len(TEXTS)]) for i, t in enumerate(TEXTS * 2)]
    written(tmp_path, rows[:18], "a.csv", end)
    written(tmp_path, rows[18:], "b.csv", end)
    inside = M._ranges_inside(M._lines(spark, str(tmp_path)), ",")
    assert len(inside) > 5  # ranges that begin inside quotes
    assert own_rows(spark, tmp_path) == spark_rows(spark, tmp_path) == sorted([(i, t or None, u or None) for i, t, u in rows], key=repr)
    got = M.csv_module_rows(spark, str(tmp_path), ["id", "t", "u"]).collect()
    assert sorted(((int(r["id"]), r["t"], r["u"]) for r in got), key=repr) == own_rows(spark, tmp_path)


def test_one_value_across_many_ranges(spark, tmp_path, small_ranges):
    rows = [(1, "a", "b"), (2, "line\n" * 200, "c"), (3, "d", "e")]
    written(tmp_path, rows)
    assert own_rows(spark, tmp_path) == rows


def test_many_tasks_read_one_file(spark, tmp_path, small_ranges):
    written(tmp_path, [(i, "two\nlines", "x") for i in range(170)])
    assert M.read_multiline_csv(spark, str(tmp_path), SCHEMA).select(F.spark_partition_id()).distinct().count() > 20


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a",\n', max_size=6), min_size=1, max_size=3), min_size=1, max_size=5))
def test_state_at_line_ends(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    inside, ends = False, 0
    for line in out.getvalue().split("\n")[:-1]:
        inside = M.ends_inside(line, inside)
        ends += not inside
    assert not inside and ends == len(rows)


def test_stray_quotes_do_not_open_a_value(spark, tmp_path, small_ranges):
    (tmp_path / "f.csv").write_text('id,t,u\n1,5" pipe,x\n2,"a\nb",y\n3,6" pipe,"z"\n')
    assert own_rows(spark, tmp_path) == [(1, '5" pipe', "x"), (2, "a\nb", "y"), (3, '6" pipe', "z")]


def test_empty_lines_and_an_open_value(spark, tmp_path):
    (tmp_path / "f.csv").write_text('\n\nid,t,u\n\n1,"a\n\nb",c\n\n')
    assert own_rows(spark, tmp_path) == [(1, "a\n\nb", "c")]
    (tmp_path / "f.csv").write_text("id,t,u\n")
    assert own_rows(spark, tmp_path) == []


def test_header_and_corrupt_rows(spark, tmp_path):
    written(tmp_path, [(1, "a\nb", "c"), ("x", "d\ne", "f")])
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect()
    good, bad = split_corrupt(read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, keep_corrupt=True))
    assert [tuple(r) for r in good.collect()] == [(1, "a\nb", "c")] and [r[CORRUPT] for r in bad.collect()] == ['x,"d\ne",f']
    with pytest.raises(Exception, match="header does not match"):
        read_csv(spark, str(tmp_path), "id bigint, t string, v string", multi_line=True).collect()
    nulls = read_csv(spark, str(tmp_path), "id string, t string, u string", null_values=["x"], multi_line=True)
    assert {r["id"] for r in nulls.collect()} == {"1", None}
