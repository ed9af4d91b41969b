"""Tables that change by whole versions.

A version is one small file that lists the folders each part of each table consists of. Writers add
folders and then a version that names them; folders already listed are never written again. Readers use
the latest version, so they see a change as a whole or not at all, and an interrupted writer leaves
only folders that nobody lists. Two writers that began with the same version cannot both end: the file
of the next version is created once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Table to part to folders below the root.
Listing = dict[str, dict[str, list[str]]]


class VersionConflict(RuntimeError):
    """Another writer has committed since this one began."""


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _name(self, version: int) -> str:
        return f"{self.root}/versions/{version:010d}.json"

    def latest(self) -> tuple[int, Listing]:
        """Number and listing of the latest version; 0 and nothing before the first."""
        files, at = self._files(f"{self.root}/versions/*.json")
        names = sorted(status.getPath().toString() for status in files.globStatus(at) or [])
        if not names:
            return 0, {}
        text = "".join(row[0] for row in self.spark.read.text(names[-1], wholetext=True).collect())
        return int(names[-1].rsplit("/", 1)[-1].removesuffix(".json")), json.loads(text)

    def read(self, listing: Listing, table: str, schema: StructType, parts=None) -> DataFrame:
        """A table as a version lists it; only of some ``parts`` if they are named."""
        known = listing.get(table, {})
        folders = [f for part in sorted(known) if parts is None or part in parts for f in known[part]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{folder}" for folder in folders))

    def write(self, rows: DataFrame, table: str, run: str, part_column: str) -> dict[str, list[str]]:
        """Write rows into new folders, one per value of ``part_column`` (not stored), and list them."""
        folder = f"{table}/{run}"
        rows.write.partitionBy(part_column).parquet(f"{self.root}/{folder}")
        files, at = self._files(f"{self.root}/{folder}/{part_column}=*")
        names = [status.getPath().getName() for status in files.globStatus(at) or []]
        return {name.split("=", 1)[1]: [f"{folder}/{name}"] for name in names}

    def commit(self, version: int, listing: Listing) -> int:
        """Make ``listing`` the version after ``version``, in one step."""
        staged, target = self._name(version + 1) + f".{id(listing):x}.new", self._name(version + 1)
        files, at = self._files(staged)
        out = files.create(at, True)
        out.write(bytearray(json.dumps(listing, indent=1).encode()))
        out.close()
        _, goal = self._files(target)
        if files.exists(goal) or not files.rename(at, goal):
            files.delete(at, False)
            raise VersionConflict(f"version {version + 1} of {self.root} exists")
        return version + 1
