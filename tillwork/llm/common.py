"""What the text operators share: the word pattern, table reads, and intermediate tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.session import scratch_path

#: The white space that ends words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

GIVE_BACK = {
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_TRIM_THRESHOLD_": str(1 << 20),
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null.

    One replacement per kind of white space and a split at a single character run several times
    faster than a split at a character class.
    """
    return F.filter(F.split(_spaced(text), " "), lambda word: word != "")


def _spaced(text: Column) -> Column:
    """A text with a space for every kind of white space; empty for null."""
    spaced = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    return spaced


def word_count(text: Column) -> Column:
    """How many words a text has, without the array of them: that would take a task some twenty times
    the text. Every run of spaces becomes one space and one line feed, and these are counted."""
    spaced = F.concat(F.lit(" "), _spaced(text), F.lit(" "))
    marked = F.replace(F.replace(spaced, F.lit(" "), F.lit(" \n")), F.lit("\n "), F.lit(""))
    bare = F.replace(spaced, F.lit(" "), F.lit(""))
    return ((F.octet_length(marked) - F.octet_length(bare)) / 2 - 1).cast("long")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, though ``use`` may name it often.

    A lambda variable holds the value; a plain column expression would be computed again wherever
    it is named inside an array function.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def set_aside(docs: DataFrame, *working: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with the columns that have an operator's working names renamed, and the columns that
    give them back in their order. Where no name clashes, ``docs`` itself."""
    taken, names = {name.lower() for name in (*docs.columns, *working)}, {}
    for name in docs.columns:
        if name.lower() in {w.lower() for w in working}:
            other = f"_kept{name}"
            while other.lower() in taken:
                other = f"_kept{other}"
            taken.add(other.lower())
            names[name] = other
    return (
        docs.withColumnsRenamed(names) if names else docs,
        [F.col(names[c]).alias(c) if c in names else F.col(c) for c in docs.columns],
    )


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts lineage, and tells the planner
    how large the table really is, so that it broadcasts only what is small. A landed side also lets
    adaptive execution split a hot key of the other side of a join, which it does not do where an
    aggregate feeds the join directly."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def landed_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """``landed``, in buckets by ``key``: joins on it deal the other side to the buckets and leave this
    one where it is. The session's catalog knows the table by its path's last part."""
    path = scratch_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches that Python gets, in bytes as well as rows: texts can be very long.

    Workers also look for the package where the driver has it, whatever folder the launcher ran in;
    where executors have no such folder, ship the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known = [path for path in paths if path]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *known])
    # Workers stay for later stages: what they free must go back to the machine.
    spark.sparkContext.environment.update(GIVE_BACK)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` over bounded batches."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
