import pytest

from millrace.operators.validation import Field, validate
from millrace.session import scratch_path, shared_dir, stage
from millrace.sources import readers as R
from millrace.sources import sinks as S

SCHEMA = "region string, amount double"


@pytest.fixture
def csv(tmp_path):
    def write(text, name="a.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def test_null_markers(spark, csv):
    path = csv("region,amount\nNA,1\n,2\nnull,NaN\nb,\n")
    plain = [tuple(r) for r in R.read_csv(spark, path, SCHEMA).collect()]
    assert [r[0] for r in plain] == ["NA", None, "null", "b"] and plain[2][1] != plain[2][1]
    marked = [tuple(r) for r in R.read_csv(spark, path, SCHEMA, null_values=["NA", "null", "NaN"]).collect()]
    assert marked == [(None, 1.0), (None, 2.0), (None, None), ("b", None)]


def test_null_marker_in_number_column(spark, csv):
    path = csv("region,amount\na,NA\nb,2.5\n")
    assert [r["amount"] for r in R.read_csv(spark, path, SCHEMA, null_values=["NA"]).collect()] == [None, 2.5]
    with pytest.raises(Exception):
        R.read_csv(spark, path, SCHEMA).collect()


def test_inferred_types(spark, csv):
    df = R.read_csv(spark, csv("d,n,x,s\n2024-01-02,1,1.5,a\n"))
    assert [t for _, t in df.dtypes] == ["date", "int", "double", "string"]


def test_missing_path(spark, tmp_path):
    for read in (R.read_csv, R.read_parquet):
        with pytest.raises(FileNotFoundError, match="nothing"):
            read(spark, str(tmp_path / "nothing"))


def test_empty_file(spark, csv):
    with pytest.raises(ValueError):
        R.read_csv(spark, csv(""), SCHEMA)
    assert R.read_csv(spark, csv("region,amount\n", "b.csv"), SCHEMA).count() == 0


def test_ragged_rows(spark, csv):
    path = csv("region,amount\na,1\nb,2,3\nc,x\nd,4\n")
    with pytest.raises(Exception):
        R.read_csv(spark, path, SCHEMA).collect()
    good, bad = R.split_corrupt(R.read_csv(spark, path, SCHEMA, keep_corrupt=True))
    assert sorted(map(tuple, good.collect())) == [("a", 1.0), ("d", 4.0)]
    assert sorted(r[0] for r in bad.collect()) == ["b,2,3", "c,x"] and bad.count() == 2


def test_header_must_match_schema(spark, csv):
    with pytest.raises(Exception):
        R.read_csv(spark, csv("amount,region\n1,a\n"), SCHEMA).collect()


def test_sql_over_csv(spark, csv):
    R.csv_table(spark, csv("region,amount\na,1\nb,2\n"), "t_csv", SCHEMA)
    assert spark.sql("select sum(amount) from t_csv").first()[0] == 3.0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_write_and_read_back(spark, rows, tmp_path, fmt):
    df = rows(SCHEMA, [("a,\"q\"", 1.25), ("b", None)])
    path = str(tmp_path / fmt)
    (S.write_csv if fmt == "csv" else S.write_parquet)(df, path)
    back = R.read_csv(spark, path, SCHEMA) if fmt == "csv" else R.read_parquet(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert S.stored_bytes(spark, path) > 0


def test_rejects_as_json(spark, rows, tmp_path):
    fields = (Field("region", "string", min_length=1),)
    bad, none = str(tmp_path / "bad"), str(tmp_path / "none")
    S.write_rejects(validate(rows("region string", [("",), ("a",)]), fields), bad)
    got = spark.read.json(bad).first()
    assert got["row"]["region"] == "" and got["error"][0]["type"] == "string_too_short"
    S.write_rejects(validate(rows("region string", [("a",)]), fields), none)
    assert spark.read.text(none).count() == 0


def test_markdown(rows):
    df = rows("name string, ms double", [("b", 2.0), ("a|x", 1.5), ("c", None)])
    text = S.markdown_table(df.dropna(), "ms")
    assert text.split("\n") == ["| name | ms |", "|---|---|", "| a\\|x | 1.50 |", "| b | 2.00 |"]


def test_report(spark, rows, tmp_path):
    path = str(tmp_path / "report")
    text = S.write_report(spark, path, "Run", {"One": rows("a int", [(1,)]), "Two": "words"})
    assert "\n".join(r[0] for r in spark.read.text(path).collect()) == text
    assert text.startswith("# Run\n\n## One\n\n| a |")


def test_compare_formats(rows, tmp_path):
    got = {r["format"]: r for r in S.compare_formats(rows(SCHEMA, [("a", 1.0)] * 50), str(tmp_path)).collect()}
    assert set(got) == {"csv", "parquet"} and all(r["bytes"] > 0 and r["write_ms"] > 0 for r in got.values())


def test_staging_keeps_pushdown(spark, rows):
    staged = stage(rows(SCHEMA, [("a", 1.0), ("b", 2.0)]), "t")
    plan = staged.where("amount > 1").select("amount")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(amount), GreaterThan(amount,1.0)]" in plan and "ReadSchema: struct<amount:double>" in plan


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
