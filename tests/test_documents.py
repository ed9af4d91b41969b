"""JSON documents read in byte ranges."""

import json
import random

import pytest
from pyspark.errors import PySparkException

from tillwork.sources.documents import land_documents, pieces, records
from tillwork.sources.files import read_json

SCHEMA = "a long, s string, o struct<x: string, l: array<struct<y: string>>>"


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "97")
    spark.conf.set(names[1], "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def elements(n):
    random.seed(n)
    signs = ["}", "{", "[", "]", '"', "\\", ",", " ", "\n", "ß漢", "}{", '\\"', "x", ":"]

    def text():
        return "".join(random.choices(signs, k=random.randrange(30)))

    return [
        {"a": i, "s": text(), "o": random.choice([None, {}, {"x": text(), "l": [{"y": text()}, {}, {"y": text()}]}])}
        for i in range(n)
    ]


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_documents_equal_the_reader(spark, tmp_path, small_ranges, layout):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.json").write_text(json.dumps(elements(60), **layout))
    (source / "b.json").write_text(json.dumps(elements(7), **layout) + "\n \n")
    (source / "one.json").write_text(json.dumps(elements(3)[2], **layout))
    (source / "empty.json").write_text(" [ ]\n")
    (source / "none.json").write_text("")
    ranges = pieces(spark, str(source)).groupBy("_file").agg({"_range": "count"}).count()
    assert ranges == 4
    assert pieces(spark, str(source)).select("_file", "_range").distinct().count() > 20  # no task reads it all
    want = read_json(spark, str(source), SCHEMA, multi_line=True).collect()
    assert land_documents(spark, str(source), out) == 68
    got = read_json(spark, out, SCHEMA, multi_line=False).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    rows = records(spark, str(source / "a.json")).where("value IS NOT NULL").orderBy("number").collect()
    assert [json.loads(r.value) for r in rows] == elements(60)
    assert [r.number for r in rows] == list(range(60))


def test_objects_one_after_the_other(spark, tmp_path, small_ranges):
    every = elements(20)
    (tmp_path / "a.json").write_text("\n".join(json.dumps(e, indent=1) for e in every))
    rows = records(spark, str(tmp_path / "a.json")).where("value IS NOT NULL").orderBy("number").collect()
    assert [json.loads(r.value) for r in rows] == every


@pytest.mark.parametrize(
    "text", ['[{"a": 1}', '[{"a": 1', '[{"a": 1}, {"s": "x}', '{"a": 1', '[{"a": 1}, 5]', '[7, {"a": 1}]', '{"a": {}']
)
def test_cut_or_foreign_documents_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises((ValueError, PySparkException)):
        land_documents(spark, str(tmp_path / "a.json"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
