"""Streaming forms of two operators. On a bounded replay each gives what its batch form gives."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from netquill.operators.quality import ATTRIBUTES


def volume_stream(msmts: DataFrame, threshold: int = 200, watermark: str = "10 minutes") -> DataFrame:
    """Minutes with ``threshold`` measurements of one kind of probe or more, over a stream with
    ``measurement_start_time``; later rows than the watermark are not counted."""
    ts = F.col("measurement_start_time").cast("timestamp")
    minute = F.window("ts", "1 minute")
    counted = msmts.withColumn("ts", ts).withWatermark("ts", watermark).groupBy(minute, *ATTRIBUTES).agg(F.count("*").alias("total"))
    return counted.filter(F.col("total") >= threshold).select(F.col("window.start").alias("ts"), "probe_cc", "probe_asn", "total")


def step(state: tuple, ts: float, y: float, w: float, edd: float, mu0: float, mu1: float, halflife: float) -> tuple[tuple, tuple | None]:
    """One hour of the change detector: (state, change or None). State: (name, s_pos, s_neg, last change,
    last time in hours)."""
    name, pos, neg, last, seen = state
    if not w or y is None or y != y:
        return state, None
    half, h = (mu1 - mu0) / 2, edd * (mu1 - mu0) / 2
    if seen is not None and ts - seen > 24:
        pos, neg = pos * 0.5 ** ((ts - seen) / halflife), neg * 0.5 ** ((ts - seen) / halflife)
    pos = 0.0 if name == "blk" else max(0.0, pos + y - mu0 - half)
    neg = 0.0 if name == "ok" else max(0.0, neg - (y - mu1) - half)
    over, under = pos > h and name != "blk", neg > h and name != "ok"
    if name == "unk":
        return (("blk", 0.0, 0.0, last, ts) if over else ("ok", 0.0, 0.0, last, ts) if under else (name, pos, neg, last, ts)), None
    if not over and not under:
        return (name, pos, neg, last, ts), None
    way = 1 if over else -1
    if last == way:
        return (name, 0.0, 0.0, last, ts), None
    return ("blk" if over else "ok", 0.0, 0.0, way, ts), (way, pos, neg, name)


def cusum_stream(points: DataFrame, edd: float = 10, mu0: float = 0.0, mu1: float = 0.7, gap_halflife: float = 48.0) -> DataFrame:
    """Changes of a stream of long-form hourly points (probe_cc, probe_asn, domain, signal, ts, y, w). Hours
    of a key must arrive in order of time across batches, as closed hours do; inside a batch they are
    sorted."""
    schema = "probe_cc string, probe_asn long, domain string, signal string, ts timestamp, change_dir int, s_pos double, s_neg double, current_state string"

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = tuple(state.get) if state.exists else ("unk", 0.0, 0.0, 0, None)
        rows = pd.concat(list(frames)).sort_values("ts")
        found = []
        for ts, y, w in zip(rows["ts"], rows["y"], rows["w"]):
            now, change = step(now, ts.timestamp() / 3600, y, w, edd, mu0, mu1, gap_halflife)
            if change:
                found.append((*key, ts, *change))
        state.update(now)
        yield pd.DataFrame(found, columns=["probe_cc", "probe_asn", "domain", "signal", "ts", "change_dir", "s_pos", "s_neg", "current_state"])

    return points.groupBy("probe_cc", "probe_asn", "domain", "signal").applyInPandasWithState(
        update, schema, "name string, s_pos double, s_neg double, last_change int, seen double", "append", "NoTimeout"
    )


_STATE = "name string, s_pos double, s_neg double, last_change int, seen double"


class ChangeDetector(StatefulProcessor):
    """The detector of one key on the state API: hours wait, keyed by their time, until the watermark closes them, and
    are then taken in order of time. So hours may come late, and in any order, within the watermark. A key
    that is silent for ``ttl_days`` of event time is forgotten."""

    def __init__(self, edd: float, mu0: float, mu1: float, gap_halflife: float, ttl_days: int):
        self.parameters = (edd, mu0, mu1, gap_halflife)
        self.ttl = ttl_days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)
        self.waiting = handle.getMapState("waiting", "at long", "y double, w double")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        row = initialState.iloc[0]
        seen = None if pd.isna(row["last_ts"]) else row["last_ts"].timestamp() / 3600
        self.state.update((row["current_state"], float(row["s_pos"]), float(row["s_neg"]), int(row["last_change"]), seen))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for frame in rows:
            for ts, y, w in zip(frame["ts"], frame["y"], frame["w"]):
                at = int(ts.timestamp() * 1000)
                number = lambda x: None if x is None or x != x else float(x)
                self.waiting.updateValue((at,), (number(y), number(w)))
                self.handle.registerTimer(at)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at = expiredTimerInfo.getExpiryTimeInMs()
        now = tuple(self.state.get()) if self.state.exists() else ("unk", 0.0, 0.0, 0, None)
        if not self.waiting.containsKey((at,)):
            # a timer of the state and not of an hour
            if now[4] is not None and now[4] * 3_600_000 + self.ttl <= at:
                self.state.clear()
            yield pd.DataFrame()
            return
        y, w = self.waiting.getValue((at,))
        self.waiting.removeKey((at,))
        now, change = step(now, at / 3_600_000, y, w, *self.parameters)
        self.state.update(now)
        self.handle.registerTimer(at + self.ttl)
        if change is None:
            yield pd.DataFrame()
            return
        yield pd.DataFrame([(*key, pd.Timestamp(at, unit="ms"), *change)], columns=CHANGES)

    def close(self) -> None:
        pass


CHANGES = ["probe_cc", "probe_asn", "domain", "signal", "ts", "change_dir", "s_pos", "s_neg", "current_state"]


def detector_stream(
    points: DataFrame, state: DataFrame | None = None, watermark: str = "3 hours", edd: float = 10, mu0: float = 0.0, mu1: float = 0.7,
    gap_halflife: float = 48.0, ttl_days: int = 400,
) -> DataFrame:
    """Changes of a stream of long-form hourly points whose hours may be late, or out of order over batches, by up to the
    watermark. ``state``: the stored state of the batch detector, to begin from. The session needs the RocksDB
    state store (``spark.sql.streaming.stateStore.providerClass``)."""
    keys = ["probe_cc", "probe_asn", "domain", "signal"]
    schema = "probe_cc string, probe_asn long, domain string, signal string, ts timestamp, change_dir int, s_pos double, s_neg double, current_state string"
    first = None if state is None else state.select(*keys, "current_state", "s_pos", "s_neg", "last_change", "last_ts").groupBy(*keys)
    return points.withWatermark("ts", watermark).groupBy(*keys).transformWithStateInPandas(
        ChangeDetector(edd, mu0, mu1, gap_halflife, ttl_days), outputStructType=schema, outputMode="Append", timeMode="EventTime", initialState=first
    )
