"""Readers and writers of measurements and tables, and the operators next to them."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.schemas import MEASUREMENT
from netquill.sources.archives import PostArchives


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names in ``spark.checkpoint.dir``. A session on one machine
    that names none takes a temporary one; on a cluster that would lose rows, so it is an error there."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-netquill-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base}/netquill/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for what several later steps read: it is made once, and a
    lost executor costs a reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType | str = MEASUREMENT) -> DataFrame:
    """Newline JSON, compressed or not; bad lines stay in ``_corrupt_record``."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def read_counted(spark: SparkSession, path: str | list[str], quarantine: str | None = None, name: str = "read") -> tuple[DataFrame, Observation]:
    """Measurements with test keys, and counters that are there once an action has read them: rows, unreadable
    (bad lines) and empty (no test keys). With ``quarantine``, the lines that are left out are appended to that
    table with their reason, file and day, by a pass of their own."""
    counters = Observation(name)
    raw = read_jsonl(spark, path)
    bad, empty = F.col("_corrupt_record").isNotNull(), F.col("test_keys").isNull()
    if quarantine is not None:
        reason = F.when(bad, "unreadable").otherwise("empty")
        lost = raw.withColumns({"reason": reason, "file": F.input_file_name(), "day": F.current_date()}).filter(bad | empty)
        lost.select("measurement_uid", F.col("_corrupt_record").alias("line"), "reason", "file", "day").write.partitionBy("day").mode("append").parquet(quarantine)
    seen = raw.observe(counters, F.count("*").alias("rows"), F.count_if(bad).alias("unreadable"), F.count_if(~bad & empty).alias("empty"))
    return seen.filter(~bad & ~empty), counters


def read_post_archives(spark: SparkSession, path: str) -> DataFrame:
    """(measurement_uid, raw) of the JSON posts in .tar.gz archives: the ``content`` of each ``.post`` file
    whose ``format`` is json, named by its file. An archive of any size is one task's work and read as a stream; only
    the list of archives is made here."""
    files = spark.read.format("binaryFile").load(path).select("path").collect()
    spark.dataSource.register(PostArchives)
    return spark.read.format("post_archives").option("paths", json.dumps(sorted(f.path for f in files))).load()


def parse_posts(posts: DataFrame, schema: str = MEASUREMENT) -> DataFrame:
    parsed = posts.select(F.col("measurement_uid").alias("_uid"), F.from_json("raw", schema).alias("m"))
    return parsed.select("_uid", "m.*").drop("measurement_uid").withColumnRenamed("_uid", "measurement_uid")


def measurement_id(raw: Column, start: Column) -> Column:
    """Id of a record without one: version, day of its start (zeros if unknown) and 30 hash digits."""
    return F.concat(F.lit("01"), F.coalesce(F.date_format(start, "yyyyMMdd"), F.lit("00000000")), F.substring(F.sha2(raw, 256), 1, 30))


def file_meta(paths: DataFrame, column: str = "path") -> DataFrame:
    """Time, country (NULL if the name has none), test and extension from file paths such as
    ``20240102_03_IT_webconnectivity.n0.0.jsonl.gz``."""
    name = F.element_at(F.split(column, "/"), -1)
    p = r"^(\d{8})(?:_?(\d{2}))?_(?:([A-Z]{2})_)?([a-z0-9]+)\.[^/]*?(jsonl\.gz|tar\.gz)$"
    g = lambda i: F.regexp_extract(name, p, i)
    hour = F.when(g(2) == "", "00").otherwise(g(2))
    return paths.select(
        "*",
        F.try_to_timestamp(F.concat(g(1), hour), F.lit("yyyyMMddHH")).alias("timestamp"),
        F.nullif(g(3), F.lit("")).alias("cc"),
        g(4).alias("test_name"),
        g(5).alias("extension"),
    ).filter("extension <> ''")


def select_files(files: DataFrame, start=None, end=None, probe_cc: tuple = (), tests: tuple = ()) -> DataFrame:
    """Files of [start, end) of the wanted tests and countries; files without a country stay, as their
    rows are filtered later."""
    if start is not None:
        files = files.filter(F.col("timestamp") >= F.lit(start))
    if end is not None:
        files = files.filter(F.col("timestamp") < F.lit(end))
    if tests:
        files = files.filter(F.col("test_name").isin(*tests))
    return files.filter(F.col("cc").isNull() | F.col("cc").isin(*probe_cc)) if probe_cc else files


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, timestamp, cc, test_name, extension) of the raw files under a path or pattern, from their listing;
    no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("size"))
    return file_meta(files)


def read_selected(spark: SparkSession, path: str, start=None, end=None, probe_cc: tuple = (), tests: tuple = ()) -> DataFrame:
    """Measurements of the files of [start, end) of the wanted tests and countries, and of no others. The chosen files are
    packed into tasks by their bytes; rows of files whose name has no country are filtered by their own."""
    chosen = [r.path for r in select_files(file_index(spark, path), start, end, probe_cc, tests).filter("extension = 'jsonl.gz'").select("path").collect()]
    rows = read_jsonl(spark, sorted(chosen)) if chosen else spark.createDataFrame([], T._parse_datatype_string(MEASUREMENT))
    return rows.filter(F.col("probe_cc").isin(*probe_cc)) if probe_cc else rows


def bytes_per_day(files: DataFrame) -> DataFrame:
    return files.groupBy(F.to_date("timestamp").alias("day")).agg(F.sum("size").alias("bytes"), F.count("*").alias("files"))


def dedup_latest(df: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """One row a key: the newest version, the greatest of equals; any without a version."""
    if version is None:
        return df.dropDuplicates(keys)
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys and c != version]
    order = Window.partitionBy(*keys).orderBy(F.col(version).desc_nulls_last(), *rest)
    return df.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def write_partitioned(df: DataFrame, path: str, time: str = "measurement_start_time", sort: list[str] | None = None) -> None:
    """Write by month and day; a rerun of a window replaces the days it holds and nothing else. Days are
    rebalanced, so a day of any size becomes files of about the advisory size, written by as many tasks, and small
    ones share a task. Rows are sorted inside files, so that statistics skip row groups."""
    out = df.withColumn("bucket_month", F.date_format(time, "yyyy-MM")).withColumn("bucket_date", F.date_format(time, "yyyy-MM-dd"))
    out = out.hint("rebalance", "bucket_date").sortWithinPartitions("bucket_date", *(sort or []))
    out.write.partitionBy("bucket_month", "bucket_date").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_partitioned(spark: SparkSession, path: str, start=None, end=None, time: str = "measurement_start_time") -> DataFrame:
    """Rows in (start, end] of what :func:`write_partitioned` wrote; only the months and days of that time are
    listed and read."""
    rows = spark.read.parquet(path)
    for bound, keep in ((start, lambda c, v: c >= v), (end, lambda c, v: c <= v)):
        if bound is not None:
            rows = rows.filter(keep(F.col("bucket_month").cast("string"), F.lit(f"{bound:%Y-%m}")))
            rows = rows.filter(keep(F.to_date("bucket_date"), F.lit(f"{bound:%Y-%m-%d}").cast("date")))
    if start is not None:
        rows = rows.filter(F.col(time) > F.lit(start))
    return rows if end is None else rows.filter(F.col(time) <= F.lit(end))


def write_csv(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def repartition_raw(msmts: DataFrame, path: str, existing: DataFrame | None = None) -> None:
    """Rewrite raw rows (test, day, cc and the record) as one set of compressed JSON files a group, large groups by
    several tasks; groups that exist already are skipped."""
    if existing is not None:
        msmts = msmts.join(existing.select("test", "day", "cc").distinct(), ["test", "day", "cc"], "left_anti")
    msmts.hint("rebalance", "test", "day", "cc").write.partitionBy("test", "day", "cc").mode("append").option("compression", "gzip").json(path)


def trim_column(column: Column, kind: T.DataType, most: int) -> Column:
    if isinstance(kind, T.StringType):
        return F.when(F.length(column) <= most, column)
    if isinstance(kind, T.StructType):
        fields = [trim_column(column[f.name], f.dataType, most).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: trim_column(x, kind.elementType, most))
    if isinstance(kind, T.MapType):
        return F.transform_values(column, lambda _, v: trim_column(v, kind.valueType, most))
    return column


def trim_long(df: DataFrame, most: int) -> DataFrame:
    """Every string longer than ``most`` characters, however deep, becomes NULL."""
    return df.select(*[trim_column(F.col(f"`{f.name}`"), f.dataType, most).alias(f.name) for f in df.schema.fields])


def refresh(df: DataFrame, path: str, low: int, high: int, swap: Callable[[str, str], None] | None = None) -> int:
    """Stage a reference table, count it, and publish it only if low < count < high. It is published by
    ``swap``, else by renames: the old table stands aside until the new one has its place, and a failed
    rename puts it back."""
    spark, staged = df.sparkSession, f"{path}__staged"
    df.write.mode("overwrite").parquet(staged)
    n = spark.read.parquet(staged).count()
    if not low < n < high:
        raise ValueError(f"{path}: {n} rows, expected between {low} and {high}")
    (swap or _rename_over(spark))(staged, path)
    return n


def _rename_over(spark: SparkSession) -> Callable[[str, str], None]:
    path_of = spark._jvm.org.apache.hadoop.fs.Path

    def swap(staged: str, path: str) -> None:
        new, live, old = path_of(staged), path_of(path), path_of(f"{path}__old")
        fs = live.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(live):
            fs.delete(old, True)
            if not fs.rename(live, old):
                raise OSError(f"{path}: cannot be moved aside")
        if not fs.rename(new, live):
            if fs.exists(old):
                fs.rename(old, live)
            raise OSError(f"{path}: the staged table cannot be moved there")
        fs.delete(old, True)

    return swap


URL_PARTS = r"^(?:https?://)?([^/:@\s]+)"


def read_test_lists(spark: SparkSession, path: str) -> DataFrame:
    """Per-country CSV lists: domain, url, country (``global`` is ZZ, other stems must be two letters),
    category. URLs with control characters are left out."""
    rows = spark.read.option("header", True).csv(path)
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1)
    cc = F.when(stem == "global", "ZZ").when(F.length(stem) == 2, F.upper(stem))
    out = rows.select(F.regexp_extract("url", URL_PARTS, 1).alias("domain"), "url", cc.alias("cc"), "category_code")
    return out.filter(F.col("cc").isNotNull() & ~F.col("url").rlike(r"[\x00-\x1F\x7F]"))
