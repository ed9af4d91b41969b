"""CSV, JSON and Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwork.schemas import all_strings
from tillwork.session import remove_scratch, scratch_path

Paths = str | list[str]

#: JSON writers cut times to milliseconds by default; readers take up to nine digits as they come.
EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def read_csv(spark: SparkSession, path: Paths, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header row; every column is a string and an empty cell is NULL.

    Files whose header differs from the others, or from ``columns``, fail. With ``columns`` no job
    runs to look at the header.
    """
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    if columns is not None:
        reader = reader.schema(all_strings(columns))
    return reader.csv(path)


def read_json(
    spark: SparkSession,
    path: Paths,
    schema: StructType | str | None = None,
    *,
    multi_line: bool,
) -> DataFrame:
    """JSON files; a cell that does not fit the schema is NULL and its row stays.

    ``multi_line=True`` reads one document or array of documents per file. Such a file cannot be
    split, so its whole read is one task: supply many files, or land the document with
    ``documents.land_documents`` as JSON Lines and read those with ``multi_line=False``.
    The flag has no default: it must match the data, since JSON Lines read as one document yield the
    first line only.
    Without ``schema`` the types come from an extra pass over the data, with columns sorted by name.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines files; NULL fields are left out, times keep their microseconds. The default mode
    refuses an existing path."""
    df.write.mode(mode).options(**EXACT_TIMES).json(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Land a DataFrame as Parquet and return it read back.

    With ``partition_by`` rows are first gathered by folder. The rebalance hint lets adaptive
    execution split a large folder over many tasks and give a small one a single file; without it
    every task would write a file into every folder.

    With ``sort_by`` too, rows are range-partitioned and sorted instead. That costs more to write, but
    the files are smaller, filters on those columns skip files and pages, and groups lie together, so
    later aggregations shrink before their shuffle. The ranges are cut over all columns: however many
    rows share a folder or a sort value, they are spread over as many tasks as their size asks for.
    Finding the ranges needs a sample, a whole pass over the rows; they are staged in the scratch
    folder first, so that they are computed once.

    With neither, rows are written where they are, and files of a sorted DataFrame follow its order.

    The table is read back with the types written, so nothing is guessed from folder names.
    """
    schema = df.schema
    spark = df.sparkSession
    staged = None
    if sort_by:
        staged = scratch_path(spark, "staged")
        df.write.parquet(staged)
        lead = [*partition_by, *sort_by]
        ranges = lead + [name for name in df.columns if name not in lead]
        df = spark.read.schema(schema).parquet(staged)
        df = df.repartitionByRange(*ranges).sortWithinPartitions(*lead)
    elif partition_by:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    try:
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    finally:
        if staged is not None:
            remove_scratch(spark, staged)
    return spark.read.schema(schema).parquet(path)
