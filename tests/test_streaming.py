from millrace.operators.validation import Field
from millrace.streaming.ingest import checked_stream, start_quarantine


def test_landed_files_are_split_once(spark, tmp_path):
    land, out, ck = (tmp_path / n for n in ("land", "out", "ck"))
    land.mkdir()

    def run():
        checked = checked_stream(spark, str(land), (Field("f", "float", ge=0, le=100),))
        start_quarantine(checked, str(out), str(ck)).awaitTermination(120)
        back = spark.read.schema("f double, is_valid boolean").parquet(str(out))
        return sorted(tuple(r) for r in back.select("f", "is_valid").collect())

    (land / "a.json").write_text('{"f":1}\n{"f":150}\n')
    assert run() == [(1.0, True), (150.0, False)]
    (land / "b.json").write_text('{"f":2}\n')
    assert run() == [(1.0, True), (2.0, True), (150.0, False)]
