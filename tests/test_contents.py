"""Object contents: formats, bad records, repeated and unknown objects."""

import json

from evlake.sources.contents import object_records


def test_formats(spark, tmp_path):
    bucket = tmp_path / "in" / "a dir"
    bucket.mkdir(parents=True)
    (bucket / "x.json").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    (bucket / "y.json").write_text('{"a": 3}\n')
    (bucket / "50%+1.csv").write_text("a,b\n1,x\n2,y\n")
    spark.range(3).coalesce(1).write.parquet(str(bucket / "p.parquet"))
    part = next(p.name for p in (bucket / "p.parquet").glob("*.parquet"))
    keys = ["a dir/x.json", "a dir/x.json", "a dir/50%+1.csv", f"a dir/p.parquet/{part}", "a dir/gone.json", None]
    rows = [("in", k, "s3:ObjectCreated:Put") for k in keys] + [("in", "a dir/y.json", "s3:ObjectRemoved:Delete")]
    table = spark.createDataFrame(rows, "bucket string, object_key string, event_name string")

    def read(suffix):
        found = object_records(spark, table, str(tmp_path), str(tmp_path), suffix).collect()
        return found, sorted(json.loads(r.record).items() for r in found if r.record)

    found, records = read(".json")
    assert [list(r) for r in records] == [[("a", 1)], [("a", 2)]]
    assert [r.bad for r in found if r.bad] == ["not json"]
    assert {(r.bucket, r.object_key) for r in found} == {("in", "a dir/x.json")}
    assert [dict(r) for r in read(".csv")[1]] == [{"a": "1", "b": "x"}, {"a": "2", "b": "y"}]
    assert [dict(r) for r in read(".parquet")[1]] == [{"id": 0}, {"id": 1}, {"id": 2}]


def notified(spark, *keys):
    rows = [("in", k, "s3:ObjectCreated:Put") for k in keys]
    return spark.createDataFrame(rows, "bucket string, object_key string, event_name string")


def test_csv_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.csv").write_text("b,a,c\nz,9,keep\n")
    (folder / "two.csv").write_text("a,b\n1,x\n2,y,EXTRA\n3\n")
    (folder / "unheard.csv").write_text("q\n1\n")
    found = object_records(spark, notified(spark, "one.csv", "two.csv"), str(tmp_path), str(tmp_path), ".csv").collect()
    assert sorted(r.record for r in found if r.record) == ['{"a":"1","b":"x"}', '{"b":"z","a":"9","c":"keep"}']
    assert sorted(r.bad for r in found if r.bad) == ["2,y,EXTRA", "3"]


def test_json_documents(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "document.json").write_text('{\n"a": 1\n}\n')
    (folder / "lines.json").write_text('{"a": 2}\n{"a": 3}\n')
    (folder / "broken.json").write_text('{"a": 4}\n{"a": \n')
    keys = ("document.json", "lines.json", "broken.json")
    found = object_records(spark, notified(spark, *keys), str(tmp_path), str(tmp_path), ".json").collect()
    assert sorted(json.loads(r.record)["a"] for r in found if r.record) == [1, 2, 3, 4]
    assert [r.bad for r in found if r.bad] == ['{"a": ']


def test_parquet_with_differing_columns(spark, tmp_path):
    for name, sql in (("p", "1 AS id"), ("q", "2 AS id, 'more' AS x")):
        spark.sql(f"SELECT {sql}").coalesce(1).write.parquet(str(tmp_path / "in" / name))
    keys = [str(f.relative_to(tmp_path / "in")) for f in (tmp_path / "in").glob("*/*.parquet")]
    found = object_records(spark, notified(spark, *keys), str(tmp_path), str(tmp_path), ".parquet").collect()
    assert sorted(r.record for r in found) == ['{"id":1}', '{"id":2,"x":"more"}']


def test_nothing_notified(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text("{}")
    assert object_records(spark, notified(spark, "y.json"), str(tmp_path), str(tmp_path), ".json").count() == 0


def test_csv_over_lines(spark, tmp_path):
    """Files with fields over several lines are read whole, the others in parts."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "over.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    (folder / "escaped.csv").write_text('a,b\n3,"say \\"so\nand on"\n')
    (folder / "plain.csv").write_text('a,b\n4,"in quotes, here"\n')
    keys = ("over.csv", "escaped.csv", "plain.csv")
    found = object_records(spark, notified(spark, *keys), str(tmp_path), str(tmp_path), ".csv").collect()
    got = sorted((json.loads(r.record)["a"], json.loads(r.record)["b"]) for r in found)
    assert got == [("1", "x\ny"), ("2", "z"), ("3", 'say "so\nand on'), ("4", "in quotes, here")]
