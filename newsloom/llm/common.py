"""Small helpers shared by the training-data operators.

Operators carry the incoming row as one struct column, ``row``, so that columns of
their own never clash with columns of the input. Tables an operator reads twice are
written once below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import shared_folder

#: What separates words in every contract of these operators.
SPACE = r"[\x20\x09-\x0D]"
#: A side of a join is broadcast by hint only up to this many bytes.
BROADCAST_BYTES = 8 * 1024 * 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of the session."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def small(df: DataFrame, row_bytes: Column | int) -> DataFrame:
    """``df`` with a broadcast hint if its summed bytes stay under BROADCAST_BYTES."""
    size = df.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0]
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else df


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def small_batches(spark: SparkSession, most: int) -> None:
    """From now on the session's Arrow batches have at most so many bytes (or one row); a smaller limit stays.

    Spark's own limit is 64 MB a batch, on both sides of every Python worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().removesuffix("b")
    if not now.isdigit() or int(now) > most:
        spark.conf.set(key, str(most))


def each_text(docs: DataFrame, doc_id: str, text: str, work: Callable[[list[str]], dict], schema: str) -> DataFrame:
    """The doc_id of every row with the columns that ``work`` makes of the texts of a batch; null counts as empty."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **made})

    return rows.mapInArrow(of_batches, f"doc_id {kind}, {schema}")


def added_up(parts: DataFrame, kind: str, size: int, add: np.ufunc = np.add, fan: int = 16) -> np.ndarray:
    """The arrays of ``parts`` (part long, m binary of ``size`` numbers of ``kind``) put together by ``add``, ``fan`` at a time in a task until one is left."""
    def of(rows: list[bytes]) -> np.ndarray:
        total = np.zeros(size, kind)
        for m in rows:
            add(total, np.frombuffer(m, kind), out=total)
        return total

    def of_group(key: tuple, table: pa.Table) -> pa.Table:
        total = of(table.sort_by("part").column("m").to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "m": pa.array([total.tobytes()], pa.binary())})

    while parts.count() > 1:
        level = parts.withColumn("group", F.floor(F.col("part") / fan).cast("long"))
        parts = landed(level.groupBy("group").applyInArrow(of_group, "part long, m binary"), "sums")
    return of([bytes(r["m"]) for r in sorted(parts.collect())])


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the folder's path in it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)
