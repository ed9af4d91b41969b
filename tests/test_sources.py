"""Files in and out."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillwork import schemas, session
from tillwork.session import scratch_path
from tillwork.streaming.messages import parse_messages, to_messages
from tillwork.sources.files import read_csv, read_json, write_json, write_table

CUSTOMER = {
    "CustomerKey": 1,
    "Prefix": None,
    "FirstName": "Ann",
    "PhoneNumber": "555-1234",
    "TotalChildren": "two",
}


def test_schemas():
    sizes = {"CUSTOMERS": 15, "PRODUCTS": 8, "RETURNS": 4, "SALES": 8}
    for name, size in sizes.items():
        schema = getattr(schemas, name)
        assert len(schema) == size
        assert all(field.nullable for field in schema)
    types = {field.name: field.dataType.simpleString() for field in schemas.CUSTOMERS}
    assert types["CustomerKey"] == "int" and types["PhoneNumber"] == "string"


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,Ann,\n2,"Lee, Bo"," x "\n')
    by_header = read_csv(spark, str(tmp_path))
    assert by_header.dtypes == [("id", "string"), ("name", "string"), ("note", "string")]
    expected = [("1", "Ann", None), ("2", "Lee, Bo", " x ")]
    assert [tuple(row) for row in by_header.collect()] == expected
    declared = read_csv(spark, str(tmp_path), ["id", "name", "note"])
    assert [tuple(row) for row in declared.collect()] == expected


def test_csv_with_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,id\nAnn,1\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(tmp_path), ["id", "name"]).collect()


def test_json_document_with_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([CUSTOMER, {"CustomerKey": 2}], indent=2))
    rows = read_json(spark, str(tmp_path), schemas.CUSTOMERS, multi_line=True).orderBy("CustomerKey").collect()
    assert [row.CustomerKey for row in rows] == [1, 2]
    # A cell that does not fit is NULL; the row and its other cells stay.
    assert (rows[0].TotalChildren, rows[0].PhoneNumber) == (None, "555-1234")
    assert rows[1].FirstName is None


def test_json_document_inferred(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([CUSTOMER, {"CustomerKey": 2}]))
    df = read_json(spark, str(tmp_path), multi_line=True)
    assert df.columns == sorted(CUSTOMER)
    assert dict(df.dtypes)["CustomerKey"] == "bigint"
    assert df.count() == 2


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"CustomerKey": 1}\n{"CustomerKey": 2}\n')
    assert read_json(spark, str(tmp_path), "CustomerKey INT", multi_line=False).count() == 2


def test_json_write_omits_nulls_and_guards_the_path(spark, tmp_path):
    df = spark.createDataFrame([("1", None)], "a string, b string").coalesce(1)
    path = str(tmp_path / "out")
    write_json(df, path)
    assert spark.read.text(path).collect()[0][0] == '{"a":"1"}'
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_json(df, path)
    write_json(df, path, mode="append")
    assert spark.read.text(path).count() == 2


def test_table_is_foldered_and_complete(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "if(id < 34, null, 2000 + id % 3) AS year")
    path = str(tmp_path / "t")
    back = write_table(df, path, partition_by=["year"])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert (tmp_path / "t" / "year=2001").is_dir()
    # A filter on the folder column reads only that folder.
    assert len(back.filter("year = 2001").inputFiles()) <= len(back.inputFiles())
    plan = back.filter("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_table_keeps_the_types_of_its_folders(spark, tmp_path):
    texts = spark.createDataFrame([(1, "01"), (2, "1")], "id int, code string")
    back = write_table(texts, str(tmp_path / "text"), partition_by=["code"])
    assert sorted(map(tuple, back.collect())) == [(1, "01"), (2, "1")]
    no_year = spark.createDataFrame([(1, None)], "id int, year int")
    back = write_table(no_year, str(tmp_path / "null"), partition_by=["year"])
    assert back.dtypes == [("id", "int"), ("year", "int")]
    assert [tuple(row) for row in back.collect()] == [(1, None)]


def test_sorted_table_keeps_order_across_files(spark, tmp_path):
    df = spark.range(1000).orderBy(F.col("id").desc())
    path = tmp_path / "s"
    write_table(df, str(path))
    ids = []
    for file in sorted(path.glob("part-*.parquet")):
        ids += [row[0] for row in spark.read.parquet(str(file)).collect()]
    assert ids == list(range(999, -1, -1))


def test_sorted_folders_split_what_shares_a_sort_value(spark, tmp_path):
    """Two thirds of the rows share folder and date; their files still take even shares, in order."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = spark.range(0, 24000, numPartitions=4).selectExpr(
            "if(id % 3 < 2, 2015, 2016 + id % 2) AS year",
            "if(id % 3 < 2, DATE'2015-05-05', date_add(DATE'2016-01-01', cast(id % 300 AS int))) AS d",
            "id",
        )
        back = write_table(df, str(tmp_path / "t"), partition_by=["year"], sort_by=["d"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert back.count() == 24000 and back.select("id").distinct().count() == 24000
    sizes = []
    for file in (tmp_path / "t").glob("year=*/part-*.parquet"):
        days = [row.d for row in spark.read.parquet(str(file)).collect()]
        assert days == sorted(days)
        sizes.append(len(days))
    assert max(sizes) < 24000 * 0.2


class ClusterSession:
    """Stands in for a session whose settings a test cannot change while it runs."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = self
        self.master = master


def test_scratch_path_lies_in_the_shared_folder():
    session = ClusterSession("yarn", {"spark.checkpoint.dir": "hdfs://shared/ckpt/"})
    first, second = scratch_path(session, "x"), scratch_path(session, "x")
    assert first != second
    assert first.startswith("hdfs://shared/ckpt/tillwork/x-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(ClusterSession("yarn", {}), "x")
    assert scratch_path(ClusterSession("local[2]", {}), "x")


def test_scratch_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_handed_out", [])
    monkeypatch.setattr(session, "_local_root", [])
    path, other = scratch_path(spark, "x"), scratch_path(spark, "y")
    spark.range(3).write.parquet(path)
    spark.range(3).write.parquet(other)
    session.remove_scratch(spark, other)
    assert os.path.isdir(path) and not os.path.exists(other)
    folder = session._local_root[0] if session._local_root else path
    assert os.path.isdir(folder)
    session.remove_scratch(spark)
    assert not os.path.exists(folder)
    session.remove_scratch(spark)


def test_reordered_headers_fail(spark, tmp_path):
    for name, text in (("a", "id,name\n1,Ann\n"), ("b", "name,id\nLee,3\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_json_layout_has_no_default(spark, tmp_path):
    with pytest.raises(TypeError):
        read_json(spark, str(tmp_path))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_json_keeps_microseconds(spark, tmp_path, kind):
    texts = ["2024-01-02 03:04:05.123456", "2024-01-02 03:04:05", "1969-12-31 23:59:59.000001"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(f"cast(t AS {kind}) AS t")
    write_json(rows, str(tmp_path / "j"))
    back = read_json(spark, str(tmp_path / "j"), rows.schema, multi_line=False)
    assert sorted(back.collect()) == sorted(rows.collect())
    assert sorted(parse_messages(to_messages(rows), rows.schema).collect()) == sorted(rows.collect())
