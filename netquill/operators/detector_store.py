"""The change detector with a store of its state and changes, written together and replayed safely."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquill.operators.detect import KEY, clear_changes, detect_changes
from netquill.sources import versions as S

KEYS = [*KEY, "signal"]


def load(spark: SparkSession, root: str, run: str | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """(changes, state) of the current version, or of that of a run."""
    run = run or S.current(spark, root)
    return (S.read(spark, root, "changes", run), S.read(spark, root, "state", run)) if run else (None, None)


def run_detector(series: DataFrame, root: str, run: str, **options) -> tuple[DataFrame, DataFrame]:
    """Resume from the stored state, and publish all changes so far and the state of every key as the version of
    ``run``: (changes, state). A run that is already published is not run again; its version is returned. Keys
    without points in the series keep their state."""
    spark = series.sparkSession
    if run in S.committed(spark, root):
        return load(spark, root, run)
    before = S.current(spark, root)
    old_changes, old_state = load(spark, root, before) if before else (None, None)
    changes, state, _ = detect_changes(series, old_state, **options)
    if before:
        changes = old_changes.unionByName(changes.select(*old_changes.columns))
        state = old_state.join(state.select(*KEYS), KEYS, "left_anti").unionByName(state.select(*old_state.columns))
    out = S.stage(changes, root, run, "changes"), S.stage(state, root, run, "state")
    S.publish(spark, root, run, before)
    return out


def clear(spark: SparkSession, root: str, run: str, start: datetime, end: datetime) -> tuple[DataFrame, DataFrame]:
    """A version without the changes of [start, end] and without the state of keys whose last hour is at or after
    ``start``: what a repeated run of those hours starts from."""
    if run in S.committed(spark, root):
        return load(spark, root, run)
    before = S.current(spark, root)
    if before is None:
        raise ValueError(f"{root}: nothing is published")
    changes, state = load(spark, root, before)
    kept = state.filter(F.col("ts") < F.lit(start))
    out = S.stage(clear_changes(changes, start, end), root, run, "changes"), S.stage(kept, root, run, "state")
    S.publish(spark, root, run, before)
    return out
