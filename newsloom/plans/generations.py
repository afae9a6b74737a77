"""Numbered generations of a table, each visible from one commit on.

The data of a generation are written first and its manifest last. A generation counts
once its manifest is whole, so a crash before that leaves the one before in force, and
the next try writes the same number again. Readers take the newest whole one when they
are made and keep to its files.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files_of(df: DataFrame) -> set[str]:
    """The files that ``df`` reads, as paths."""
    return {unquote(name) for name in df.inputFiles()}


def read_files(spark: SparkSession, schema, base: str, files: set[str]) -> DataFrame:  # noqa: ANN001
    """Some files of the partitioned table at ``base``."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*sorted(files))


class Generations:
    """``manifest`` rows (source, file) say which files of other tables a generation holds."""

    MANIFEST = "source string, file string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _file_system(self, path: str):  # noqa: ANN202
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def whole(self) -> list[int]:
        """The numbers of all whole generations, in order."""
        files, path = self._file_system(f"{self.root}/manifest")
        if not files.exists(path):
            return []
        names = [(status.getPath().getName(), status.getPath().toString()) for status in files.listStatus(path)]
        found = [(int(m[1]), at) for name, at in names if (m := re.fullmatch(r"generation=(\d+)", name))]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(n for n, at in found if files.exists(done(f"{at}/_SUCCESS")))

    def latest(self) -> int | None:
        return max(self.whole(), default=None)

    def data(self, generation: int, part: str = "data") -> str:
        return f"{self.root}/{part}/generation={generation}"

    def manifest(self, generation: int) -> dict[str, set[str]]:
        """The files of each source that a generation holds."""
        rows = self.spark.read.schema(self.MANIFEST).parquet(f"{self.root}/manifest/generation={generation}").collect()
        held: dict[str, set[str]] = {}
        for row in rows:
            held.setdefault(row["source"], set()).add(row["file"])
        return held

    def commit(self, generation: int, held: dict[str, set[str]]) -> None:
        rows = [(source, file) for source, files in sorted(held.items()) for file in sorted(files)]
        manifest = self.spark.createDataFrame(rows, self.MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.root}/manifest/generation={generation}")

    def drop(self, path: str) -> None:
        """Removes a folder or file of this store."""
        files, at = self._file_system(path)
        files.delete(at, True)


def bytes_of(spark: SparkSession, paths: set[str]) -> int:
    """The size of some files, from their listing."""
    if not paths:
        return 0
    listed = spark.read.format("binaryFile").load(sorted(paths)).select("length")
    return listed.agg(F.sum("length")).first()[0] or 0
