"""Large files beside a streaming sink's many small ones.

A feed with short micro-batches leaves a small file per task and batch. Compaction copies what the sink
has committed into Parquet files of a target size and lists, as one version, the copies and the sink's
files they stand for. Readers take the copies, and from the sink only files that the version does not
name: every row once before, while and after a compaction runs, and whatever becomes of an interrupted
one. The sink and its commit log are not touched, so the feed runs on meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillwork.session import scratch_path
from tillwork.sources.versions import Listing, VersionedTables

TARGET_BYTES = 256 << 20
ROWS, COVERED = "rows", "covered"


def committed_files(spark: SparkSession, sink: str, schema: StructType) -> list[str]:
    """The files the sink has committed: Spark reads the sink's folder by its commit log."""
    return sorted(spark.read.schema(schema).json(sink).inputFiles())


def _covered(listing: Listing) -> set[str]:
    return {name for names in listing.get(COVERED, {}).values() for name in names}


def _bytes(spark: SparkSession, files: list[str]) -> int:
    total = 0
    for name in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return total


def compact(
    spark: SparkSession, sink: str, root: str, schema: StructType, target_bytes: int = TARGET_BYTES
) -> int:
    """Copy what is committed and not copied yet; returns how many files the copies stand for.

    Tasks read whole bins of small files and write one file each; nothing is shuffled.
    """
    tables = VersionedTables(spark, root)
    version, listing = tables.latest()
    new = sorted(set(committed_files(spark, sink, schema)) - _covered(listing))
    if not new:
        return 0
    bins = -(-_bytes(spark, new) // target_bytes) or 1
    run = scratch_path(spark, "run").rsplit("-", 1)[-1]
    folder = f"{ROWS}/{run}"
    spark.read.schema(schema).json(new).coalesce(bins).write.parquet(f"{tables.root}/{folder}")
    changed = {
        ROWS: listing.get(ROWS, {}) | {run: [folder]},
        COVERED: listing.get(COVERED, {}) | {run: new},
    }
    tables.commit(version, listing | changed)
    return len(new)


def read_compacted(spark: SparkSession, sink: str, root: str, schema: StructType) -> DataFrame:
    """All rows the sink has committed, from the copies where there are any."""
    tables = VersionedTables(spark, root)
    # The version first: a file copied after this is still read from the sink, and only there.
    _, listing = tables.latest()
    rest = sorted(set(committed_files(spark, sink, schema)) - _covered(listing))
    rows = tables.read(listing, ROWS, schema)
    return rows.unionByName(spark.read.schema(schema).json(rest)) if rest else rows
