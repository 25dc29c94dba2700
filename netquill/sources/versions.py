"""Tables that change as a whole: immutable versions and a log of which one is current.

A version is a folder of tables under ``versions/<run id>``. It becomes current by one entry of the log, which is
made only if no other has its number, after all its tables are written. So a reader always finds the
tables of one version, a run that fails in between leaves the older version as it was, and a run that is
repeated finds its own version and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    """Hadoop's path maker and the file system of a path."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make, make(path).getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, root: str) -> list[str]:
    """Run ids of the published versions, the oldest first. Entries still being written do not count."""
    make, fs = _files(spark, root)
    log = make(f"{root}/log")
    if not fs.exists(log):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(log))
    found = []
    for name in names:
        stream = fs.open(make(f"{root}/log/{name}"))
        text = bytes(b & 255 for b in stream.readAllBytes()).decode()
        stream.close()
        if text.endswith("\n"):
            found.append(text[:-1])
    return found


def current(spark: SparkSession, root: str) -> str | None:
    """The run id of the current version."""
    runs = committed(spark, root)
    return runs[-1] if runs else None


def read(spark: SparkSession, root: str, table: str, run: str | None = None) -> DataFrame | None:
    """A table of the current version, or of that of a run; None if nothing is published. The frame stays on its
    version, whatever is published while it is read."""
    run = run or current(spark, root)
    return spark.read.parquet(f"{root}/versions/{run}/{table}") if run else None


def stage(df: DataFrame, root: str, run: str, table: str) -> DataFrame:
    """Write a table of a version that is not published yet, and read it back."""
    path = f"{root}/versions/{run}/{table}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish(spark: SparkSession, root: str, run: str, after: str | None) -> None:
    """Make a run's version the current one, if ``after`` still is. Another run that came between is an error."""
    runs = committed(spark, root)
    if (runs[-1] if runs else None) != after:
        raise RuntimeError(f"{root}: {runs[-1]} was published meanwhile")
    make, fs = _files(spark, root)
    fs.mkdirs(make(f"{root}/log"))
    # creation fails if the entry is there, so one of two runs wins
    out = fs.create(make(f"{root}/log/{len(runs):012d}"), False)
    out.write(bytearray(f"{run}\n".encode()))
    out.close()


def refresh(df: DataFrame, root: str, run: str, low: int, high: int, table: str = "table") -> int:
    """A new version of a reference table, published only if low < count < high. Readers of the table meet no
    moment without it. A run that is already published is left alone."""
    spark = df.sparkSession
    runs = committed(spark, root)
    if run in runs:
        return read(spark, root, table, run).count()
    n = stage(df, root, run, table).count()
    if not low < n < high:
        raise ValueError(f"{root}: {n} rows, expected between {low} and {high}")
    publish(spark, root, run, runs[-1] if runs else None)
    return n
