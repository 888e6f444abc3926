"""Helpers of the operators: row-wise Arrow columns, shipping of the package, shared folders."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import measurekit
from measurekit.session import shared_warehouse

#: Rows of a batch that a worker function handles at once.
SLICE_ROWS = 1_000


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per Spark context, also where it is not installed."""
    context = spark.sparkContext
    if getattr(context, "_measurekit_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(measurekit.__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="measurekit-")), "measurekit.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("measurekit", os.path.relpath(path, root)))
    context.addPyFile(target)
    context._measurekit_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_columns(
    df: DataFrame,
    source: str,
    outs: dict[str, str],
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with the columns ``outs`` (name to type) computed from ``source`` by Arrow batches.

    ``make`` builds the worker function once per task. ``keep`` names the columns that travel along
    (all by default). Existing columns called like an output are replaced.
    """
    ship(df.sparkSession)
    kept = [c for c in (df.columns if keep is None else keep) if c not in outs]
    names = [*kept, *outs]
    place = "measurekit_in"
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias(place))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]), *(f"`{c}` {kind}" for c, kind in outs.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, *work(part.column(part.num_columns - 1))], names=names)

    return rows.mapInArrow(run, schema)


def map_column(
    df: DataFrame, source: str, out: str, kind: str, make: Callable[[], Callable[[pa.Array], pa.Array]], keep: Sequence[str] | None = None
) -> DataFrame:
    """``map_columns`` for a single output."""

    def one():
        work = make()
        return lambda column: [work(column)]

    return map_columns(df, source, {out: kind}, one, keep)


def shared_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``, else one in the warehouse if that is shared; a temporary one only on a single machine."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_measurekit_folder", None)
    if not folder and context.master.startswith("local["):
        folder = context._measurekit_folder = "file://" + tempfile.mkdtemp(prefix="measurekit-shared-")
    return folder or shared_warehouse(spark.conf.get("spark.sql.warehouse.dir"))


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/measurekit-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: a lost executor costs a re-read, nothing is computed twice."""
    spark = df.sparkSession
    path = fresh_folder(spark, "rows")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go the shuffle files of finished jobs, which stay on disk until the driver collects its garbage: with a quiet heap, to the end."""
    spark.sparkContext._jvm.System.gc()
