"""Session settings that follow the input."""

from pyspark.sql import functions as F

from tillwork.session import FILE_BYTES, GATHERED_BYTES, scale_shuffles, shuffle_partitions
from workload import entities


def test_shuffles_have_partitions_in_proportion_to_the_files(spark, tmp_path):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small, large = tmp_path / "small", tmp_path / "large"
    small.write_bytes(b"x")
    with large.open("wb") as file:
        file.truncate(FILE_BYTES * 20)
    gathered = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(gathered)
    try:
        scale_shuffles(spark, str(large), str(large))
        assert shuffle_partitions(spark) == 40
        plan = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()._jdf.queryExecution().executedPlan()
        assert ", 40), ENSURE_REQUIREMENTS" in plan.toString()
        assert int(spark.conf.get(gathered).removesuffix("b")) == GATHERED_BYTES
        spark.conf.set(gathered, "1m")
        scale_shuffles(spark, str(small))
        assert shuffle_partitions(spark) == least and spark.conf.get(gathered) == "1m"
    finally:
        scale_shuffles(spark)
        spark.conf.set(gathered, before)


def test_sales_scale_with_their_tables(spark, monkeypatch):
    scaled = []
    monkeypatch.setattr(entities, "scale_shuffles", lambda spark, *paths: scaled.extend(paths))
    entities.sales(spark, "/root/testdata/sf0.001")
    assert [path.rsplit("/", 1)[-1] for path in scaled] == ["lineitem.parquet", "orders.parquet"]
