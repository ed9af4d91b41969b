"""The command line over files."""

import json

import pytest

from tillwork import schemas
from tillwork.__main__ import main
from tillwork.sources.files import read_json

CUSTOMER = {
    "CustomerKey": 1,
    "Prefix": "Mr",
    "FirstName": "Ann",
    "LastName": "Lee",
    "BirthDate": "1/1/2000",
    "MaritalStatus": "M",
    "Gender": "F",
    "EmailAddress": "a@x",
    "AnnualIncome": "$90,000 ",
    "TotalChildren": 2,
    "EducationLevel": "BSc",
    "Occupation": "Cook",
    "HomeOwner": "Y",
    "PhoneNumber": "555-1234",
    "Address": "1 Road",
}
SALE = {
    "OrderDate": "1/5/2015",
    "OrderNumber": "SO1",
    "ProductKey": 1,
    "CustomerKey": 1,
    "OrderLineItem": 1,
    "OrderQuantity": 2,
}
PRODUCT = {
    "ProductKey": 1,
    "ProductName": "cap",
    "ProductDescription": "a cap",
    "ProductColor": None,
    "ProductSize": "Small",
    "ProductCost": 4.0,
    "ProductPrice": 10.0,
}
VIEWS = "customers_curated customers_enriched products products_curated products_enriched".split()


@pytest.fixture
def inputs(tmp_path):
    for name, record in {"customers": CUSTOMER, "sales": SALE, "products": PRODUCT}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps([record, record]))
    return tmp_path


def arguments(folder, *names):
    return [part for name in names for part in (f"--{name}", str(folder / f"{name}.json"))]


def test_layers(spark, inputs):
    out = str(inputs / "out")
    main(["layers", *arguments(inputs, "customers", "sales"), "--json-documents", "--out", out])
    activity = spark.read.parquet(f"{out}/curated/customer_activity").collect()
    assert [(row.CustomerKey, row.NumOrders, row.AvgOrdersPerDay) for row in activity] == [(1, 1, 1.0)]
    assert len(spark.read.parquet(f"{out}/cleansed/customers").collect()[0].FullName) == 64


def test_report(spark, inputs, capfd):
    out = str(inputs / "out")
    main(["report", *arguments(inputs, "customers", "sales", "products"), "--json-documents", "--out", out])
    metrics = {r.metric: r.value for r in spark.read.parquet(f"{out}/parts/metrics").collect()}
    assert (metrics["orders_placed"], metrics["avg_units_per_order"]) == (1.0, 2.0)
    assert "Orders placed: 1.00" in capfd.readouterr().out


def test_enrich_and_export(spark, inputs):
    out, export = str(inputs / "out"), str(inputs / "export")
    main(
        ["enrich", *arguments(inputs, "customers", "products"), "--json-documents", "--infer-schema"]
        + ["--out", out, "--as-of", "2020-01-01", "--export-json", export]
    )
    read = {name: spark.read.parquet(f"{out}/{name}").collect() for name in VIEWS}
    assert {len(rows) for rows in read.values()} == {2}
    assert (read["customers_curated"][0].AnnualIncome, read["customers_curated"][0].FullName) == (90000, "Ann Lee")
    assert read["customers_enriched"][0].Age == 7305 / 365
    assert read["products_curated"][0].DiscountedPrice == 9.0
    assert read["products_enriched"][0].ProductProfit == 6.0
    exported = read_json(spark, export, schemas.PRODUCTS, multi_line=False).collect()
    assert [(row.ProductKey, row.ProductPrice, row.ProductSize) for row in exported] == [(1, 10.0, "Small")] * 2


def test_salt_comes_from_a_file(spark, inputs):
    (inputs / "salt").write_text("s\n")
    files = [*arguments(inputs, "customers", "sales"), "--json-documents"]
    main(["layers", *files, "--out", str(inputs / "plain")])
    main(["layers", *files, "--out", str(inputs / "salted"), "--salt-file", str(inputs / "salt")])
    plain, salted = (
        spark.read.parquet(f"{inputs}/{name}/cleansed/customers").collect()[0].FullName
        for name in ("plain", "salted")
    )
    assert plain != salted


@pytest.mark.parametrize("raw", [False, True])
def test_publish_and_feed(spark, tmp_path, raw):
    (tmp_path / "c.csv").write_text("id,name\n1,Ann\n2,\n")
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    main(["publish", "--csv", str(tmp_path / "c.csv"), "--topic-dir", topic])
    feed = ["feed", "--columns", "id,name", "--topic-dir", topic, "--out", out, "--available-now"]
    feed += ["--checkpoint", str(tmp_path / "ckpt")] + ["--raw"] * raw
    main(feed)
    main(feed)
    if raw:
        stored = read_json(spark, out, "value string", multi_line=False)
        expected = [('{"id":"1","name":"Ann"}',), ('{"id":"2"}',)]
    else:
        stored = read_json(spark, out, "id string, name string", multi_line=False)
        expected = [("1", "Ann"), ("2", None)]
    assert sorted(map(tuple, stored.collect())) == expected


def test_a_topic_is_needed(capsys):
    with pytest.raises(SystemExit):
        main(["publish", "--csv", "x.csv", "--servers", "host:9092"])
    assert "--topic" in capsys.readouterr().err


def test_publish_with_a_ledger(spark, tmp_path, capfd):
    (tmp_path / "c.csv").write_text("id,name\n1,Ann\n2,\n")
    topic = str(tmp_path / "topic")
    publish = ["publish", "--csv", str(tmp_path / "c.csv"), "--topic-dir", topic]
    publish += ["--ledger", str(tmp_path / "ledger")]
    main(publish)
    (tmp_path / "c.csv").write_text("id,name\n1,Ann\n2,\n3,Bo\n")
    main(publish)
    sent = spark.read.option("recursiveFileLookup", "true").text(topic).collect()
    assert sorted(r.value for r in sent) == ['{"id":"1","name":"Ann"}', '{"id":"2"}', '{"id":"3","name":"Bo"}']
    out = capfd.readouterr().out
    assert "2 new messages" in out and "1 new messages" in out


def test_a_ledger_sets_the_key(capsys):
    with pytest.raises(SystemExit):
        main(["publish", "--csv", "x", "--servers", "h:1", "--topic", "t", "--key", "id", "--ledger", "l"])
    assert "--ledger" in capsys.readouterr().err


def test_compact(spark, tmp_path, capfd):
    (tmp_path / "c.csv").write_text("id,name\n1,Ann\n2,\n")
    topic, out, large = (str(tmp_path / name) for name in ("topic", "out", "large"))
    main(["publish", "--csv", str(tmp_path / "c.csv"), "--topic-dir", topic])
    feed = ["feed", "--columns", "id,name", "--topic-dir", topic, "--out", out, "--available-now"]
    main([*feed, "--checkpoint", str(tmp_path / "ckpt")])
    main(["compact", "--columns", "id,name", "--sink", out, "--out", large])
    assert "files compacted" in capfd.readouterr().out
    assert spark.read.parquet(f"{large}/rows/*").count() == 2


def test_lines(spark, tmp_path, capfd):
    (tmp_path / "d.json").write_text('[{"a": "}"},\n {"a": {"b": [1]}}]')
    main(["lines", "--documents", str(tmp_path / "d.json"), "--out", str(tmp_path / "out")])
    assert "2 records landed" in capfd.readouterr().out
    assert {r.value for r in spark.read.text(str(tmp_path / "out")).collect()} == {'{"a": "}"}', '{"a": {"b": [1]}}'}


def test_revenue(spark, inputs):
    out = str(inputs / "out")
    main(["revenue", *arguments(inputs, "sales", "products"), "--json-documents", "--out", out])
    rows = spark.read.parquet(f"{out}/revenue_by_year_month").collect()
    assert [(float(r.revenue), r.units, r.unpriced_units) for r in rows] == [(20.0, 2, None)]
    assert spark.read.parquet(f"{out}/unpriced_products").count() == 0
