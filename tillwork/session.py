"""Session settings the jobs rely on, and the shared scratch folder.

The package never builds a session; callers pass theirs.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A join whose output feeds a grouping on the join key is otherwise left skewed, because
    # splitting the hot key costs one more exchange. One hot key may hold a third of the rows, so
    # that exchange is worth it; without skew nothing changes.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Bytes of files for which a shuffle gets one more partition, and bytes of shuffled rows that adaptive
#: execution may gather for a task. Rows take some 25 times as much in the sorts and groupings of a task.
FILE_BYTES = 4 << 20
GATHERED_BYTES = 16 << 20

_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_GATHERED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

#: Paths handed out and not removed yet, and the folder of a local session that names none.
_handed_out: list[str] = []
_local_root: list[str] = []


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the jobs expect on a session the caller owns.

    They stay set: what the session runs later has the same time zone and adaptive settings.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle has before adaptive execution joins small ones."""
    return int(spark.conf.get(_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def scale_shuffles(spark: SparkSession, *paths: str) -> None:
    """Let shuffles have partitions in proportion to the files they are fed from, so that what a task
    sorts or groups does not grow with the input. The session's own number is the least."""
    conf = spark._jsc.hadoopConfiguration()
    size = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        size += path.getFileSystem(conf).getContentSummary(path).getLength()
    spark.conf.unset(_PARTITIONS)
    wanted = -(-size // FILE_BYTES)
    if wanted > shuffle_partitions(spark):
        spark.conf.set(_PARTITIONS, str(wanted))
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if bytes_of(spark.conf.get(_GATHERED)) > GATHERED_BYTES:
        spark.conf.set(_GATHERED, str(GATHERED_BYTES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables and stream checkpoints.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Only a local session
    without that setting falls back to a machine-local folder, one for the whole process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="tillwork-"))
        root = _local_root[0]
    path = f"{root.rstrip('/')}/tillwork/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Remove paths this process got from ``scratch_path``, by default all of them, and nothing else.

    Call it when no DataFrame that reads these tables is needed any more.
    """
    conf = spark._jsc.hadoopConfiguration()
    for name in paths or tuple(_handed_out):
        _handed_out.remove(name)
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    if not paths and _local_root:
        shutil.rmtree(_local_root.pop(), ignore_errors=True)
