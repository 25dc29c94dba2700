"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_own: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it. A session on one machine that names none
    gets a temporary one; on a cluster that would lose rows, so it is an error there."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="spark-netquill-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_dir(spark)}/netquill/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so a lost executor
    costs a reread and not the work above, and the planner sees the true size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: set[str]) -> DataFrame:
    """``df`` less the columns that an operator is about to add."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def binaries(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A string column as bytes; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few texts, so that a task holds the Python objects of few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def append_columns(
    df: DataFrame,
    make: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    fields: list[T.StructField],
    drop: set[str] = frozenset(),
) -> DataFrame:
    """Add columns computed batch by batch; input columns of the same names, and ``drop``, go."""
    gone = {f.name.lower() for f in fields} | {d.lower() for d in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    schema = T.StructType(kept + fields)
    names = [f.name for f in kept]
    new = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = make(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [made[n] for n in new], names + new
            )

    return df.mapInArrow(run, schema)


def chunked(texts: list[bytes], limit: int = 1 << 21) -> Iterator[range]:
    """Index ranges of consecutive texts that hold about ``limit`` bytes together."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= limit:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))
