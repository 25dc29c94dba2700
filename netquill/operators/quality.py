"""Checks of the data itself: volume, clocks, duplicates, schemas, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTRIBUTES = ["probe_cc", "probe_asn", "engine_version", "software_name", "software_version", "platform", "architecture"]


def _json(**columns: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]))


def _window(rows: DataFrame, start, end, column: str = "measurement_start_time") -> DataFrame:
    """Rows in [start, end)."""
    if start is not None:
        rows = rows.filter(F.col(column) >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col(column) < F.lit(end))
    return rows


def volume_anomalies(msmts: DataFrame, start=None, end=None, threshold: int = 200) -> DataFrame:
    """Minutes in which one kind of probe sends ``threshold`` measurements or more."""
    minute = F.date_trunc("minute", "measurement_start_time").alias("minute_start")
    busy = _window(msmts, start, end).groupBy(minute, *ATTRIBUTES).agg(F.count("*").alias("total")).filter(F.col("total") >= threshold)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    after = F.col("minute_start") + F.expr("INTERVAL 1 MINUTE")
    details = _json(total=F.col("total"), minute_start=text(F.col("minute_start")), minute_end=text(after), **{a: F.col(a) for a in ATTRIBUTES[2:]})
    return busy.select(F.col("minute_start").alias("ts"), F.lit("volume").alias("type"), "probe_cc", "probe_asn", "total", details.alias("details"))


def clock_drift(msmts: DataFrame, start=None, end=None, future_threshold: int = 1800, past_threshold: int = 7200) -> DataFrame:
    """Measurements whose upload time (the first 14 digits of the uid) and start time lie apart: the
    difference is start minus upload, in seconds."""
    uploaded = F.try_to_timestamp(F.substring("measurement_uid", 1, 14), F.lit("yyyyMMddHHmmss"))
    seconds = F.timestamp_diff("SECOND", F.date_trunc("second", uploaded), F.date_trunc("second", "measurement_start_time"))
    rows = _window(msmts, start, end).withColumn("upload_ts", uploaded).withColumn("difference", seconds)
    kind = F.when(F.col("difference") <= -future_threshold, "time_inconsistency_future").when(F.col("difference") >= past_threshold, "time_inconsistency_past")
    details = _json(difference=F.col("difference"), threshold=F.when(F.col("difference") < 0, future_threshold).otherwise(past_threshold), software_version=F.col("software_version"))
    return (
        rows.withColumn("type", kind)
        .filter("type IS NOT NULL")
        .select(F.col("measurement_start_time").alias("ts"), "type", F.col("measurement_uid").alias("uid"), "probe_cc", "probe_asn", "difference", details.alias("details"))
        .orderBy(F.desc("difference"), "uid")
    )


def duplicate_audit(rows: DataFrame, bucket: str, keys: list[str]) -> DataFrame:
    """Keys seen more than once in each bucket."""
    counted = rows.groupBy(bucket, *keys).agg(F.count("*").alias("cnt"))
    return counted.groupBy(bucket).agg(F.count_if(F.col("cnt") > 1).alias("duplicates"), F.sum("cnt").alias("total_rows"))


def months_to_clean(audit: DataFrame, bucket: str) -> DataFrame:
    """Months in which some bucket has duplicates."""
    return (
        audit.groupBy(F.substring(bucket, 1, 6).alias("month")).agg(F.sum("duplicates").alias("duplicates")).filter("duplicates > 0")
    )


def schema_frame(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string")


def schema_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Columns that are missing, extra or of another type, of two (name, type) tables."""
    a, b = expected.withColumnRenamed("type", "expected"), actual.withColumnRenamed("type", "actual")
    change = F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "extra").when(F.col("expected") != F.col("actual"), "type changed")
    return a.join(b, "name", "full").withColumn("change", change).filter("change IS NOT NULL")


def missing_columns(schema: T.StructType, actual: DataFrame) -> DataFrame:
    expected = actual.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "name string, type string")
    return schema_drift(expected, schema_frame(actual))


def unsupported_patterns(fingerprints: DataFrame, supported: tuple = ("full", "prefix", "contains", "regexp")) -> DataFrame:
    return fingerprints.filter(~F.col("pattern_type").isin(*supported) | F.col("pattern_type").isNull())


def bad_countries(fingerprints: DataFrame) -> DataFrame:
    """Fingerprints whose country list holds anything but two-letter codes."""
    codes = F.transform(F.split("expected_countries", ","), lambda c: F.trim(c))
    return fingerprints.filter((F.col("expected_countries") != "") & F.exists(codes, lambda c: ~c.rlike("^[A-Z]{2}$")))
