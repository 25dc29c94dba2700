"""Hourly series, the two-sided CUSUM change detector with carried state, and what is made of its output.

The detector is a fold over each key's hours inside the engine: hours of one (country, network, domain)
and signal are one small array (at most 8 784 a year), the state is a struct that carries the changes
found, and nothing leaves the JVM.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEY = ["probe_cc", "probe_asn", "domain"]
#: signal → the count that weighs it
SIGNALS = {
    "dns_isp_blocked": "count_isp_resolver",
    "dns_other_blocked": "count_other_resolver",
    "tcp_blocked": "count",
    "tls_blocked": "count",
}
CHANGE = "ts timestamp, change_dir int, s_pos double, s_neg double, current_state string, h double"
STEP = "ts timestamp, obs_value double, weight double, s_pos double, s_neg double, h double, current_state string, is_changepoint boolean"
STATE = "current_state string, s_pos double, s_neg double, last_change int, last_ts timestamp"


def hourly_series(verdicts: DataFrame, start=None, end=None, domains: tuple = (), probe_cc: tuple = ()) -> DataFrame:
    """Counts by kind of resolver and median scores of each key and hour, strictly inside (start, end)."""
    rows = verdicts
    if domains:
        rows = rows.filter(F.col("domain").isin(*domains))
    if start is not None:
        rows = rows.filter(F.col("measurement_start_time") > F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("measurement_start_time") < F.lit(end))
    if probe_cc:
        rows = rows.filter(F.col("probe_cc").isin(*probe_cc))
    isp = F.col("resolver_asn") == F.col("probe_asn")
    median = lambda x: F.percentile(x, F.lit(0.5))
    return rows.groupBy(*KEY, F.date_trunc("hour", "measurement_start_time").alias("ts")).agg(
        F.count_if(isp).alias("count_isp_resolver"),
        F.count_if(~isp).alias("count_other_resolver"),
        F.count("*").alias("count"),
        median(F.when(isp, F.col("dns_blocked"))).alias("dns_isp_blocked"),
        median(F.when(~isp, F.col("dns_blocked"))).alias("dns_other_blocked"),
        median(F.col("tcp_blocked")).alias("tcp_blocked"),
        median(F.col("tls_blocked")).alias("tls_blocked"),
    )


def latest_state(states: DataFrame, start: datetime, keys: list[str] | None = None, days: int = 10) -> DataFrame:
    """The newest stored state of each key before ``start``, if it is younger than ``days``."""
    keys = keys or [*KEY, "signal"]
    rest = [c for c in states.columns if c not in keys]
    fresh = states.filter((F.col("ts") < F.lit(start)) & (F.col("ts") > F.lit(start) - F.expr(f"INTERVAL {days} DAYS")))
    return fresh.groupBy(*keys).agg(F.max_by(F.struct(*rest), "ts").alias("s")).select(*keys, "s.*")


def cusum_step(edd: float, mu0: float, mu1: float, gap_halflife: float, warmup: bool, trace: bool) -> str:
    """The fold's step as SQL: state ``a``, observation ``x`` (ts, y, w) → state."""
    v = mu1 - mu0
    h, half = edd * v / 2, v / 2
    d = lambda z: f"CAST({z!r} AS DOUBLE)"
    hours = "CAST(unix_micros(x.ts) - unix_micros(a.last_ts) AS DOUBLE) / 3600000000D"
    decay = f"CASE WHEN a.last_ts IS NOT NULL AND {hours} > 24 THEN power(0.5D, {hours} / {d(gap_halflife)}) ELSE 1D END"
    live = "false" if warmup else "true"
    # g: sums after decay; e: sums after this hour; f: what follows from them
    updated = f"""named_struct(
        'p', CASE WHEN a.current_state = 'blk' THEN 0D ELSE greatest(0D, g.p + (x.y - {d(mu0)}) - {d(half)}) END,
        'n', CASE WHEN a.current_state = 'ok' THEN 0D ELSE greatest(0D, g.n - (x.y - {d(mu1)}) - {d(half)}) END)"""
    verdict = f"""named_struct(
        'up', {live} AND a.current_state = 'ok' AND e.p > {d(h)},
        'down', {live} AND a.current_state = 'blk' AND e.n > {d(h)},
        'found', CASE WHEN a.current_state <> 'unk' THEN CAST(NULL AS STRING)
                      WHEN e.p > {d(h)} THEN 'blk' WHEN e.n > {d(h)} THEN 'ok' END)"""
    emits = "((f.up AND a.last_change <> 1) OR (f.down AND a.last_change <> -1))"
    reset = "(f.up OR f.down OR f.found IS NOT NULL)"
    change = f"named_struct('ts', x.ts, 'change_dir', CASE WHEN f.up THEN 1 ELSE -1 END, 's_pos', e.p, 's_neg', e.n, 'current_state', a.current_state, 'h', {d(h)})"
    kept = f"(f.found IS NOT NULL OR ((f.up OR f.down) AND NOT {emits}))"
    step = f"named_struct('ts', x.ts, 'obs_value', x.y, 'weight', x.w, 's_pos', CASE WHEN {kept} THEN 0D ELSE e.p END, 's_neg', CASE WHEN {kept} THEN 0D ELSE e.n END, 'h', {d(h)}, 'current_state', coalesce(f.found, a.current_state), 'is_changepoint', {emits})"
    idle = f"named_struct('ts', x.ts, 'obs_value', x.y, 'weight', x.w, 's_pos', a.s_pos, 's_neg', a.s_neg, 'h', {d(h)}, 'current_state', a.current_state, 'is_changepoint', false)"
    fields = lambda state, p, n, ch, ts, changes, steps: f"named_struct('current_state', {state}, 's_pos', {p}, 's_neg', {n}, 'last_change', {ch}, 'last_ts', {ts}, 'changes', {changes}, 'steps', {steps})"
    new = fields(
        f"CASE WHEN f.found IS NOT NULL THEN f.found WHEN {emits} THEN CASE WHEN f.up THEN 'blk' ELSE 'ok' END ELSE a.current_state END",
        f"CASE WHEN {reset} THEN 0D ELSE e.p END",
        f"CASE WHEN {reset} THEN 0D ELSE e.n END",
        f"CASE WHEN {emits} THEN CASE WHEN f.up THEN 1 ELSE -1 END ELSE a.last_change END",
        "x.ts",
        f"CASE WHEN {emits} THEN concat(a.changes, array({change})) ELSE a.changes END",
        f"concat(a.steps, array({step}))" if trace else "a.steps",
    )
    same = fields("a.current_state", "a.s_pos", "a.s_neg", "a.last_change", "a.last_ts", "a.changes", f"concat(a.steps, array({idle}))" if trace else "a.steps")
    bound = f"transform(array({verdict}), f -> {new})[0]"
    bound = f"transform(array({updated}), e -> {bound})[0]"
    bound = f"transform(array(named_struct('p', a.s_pos * ({decay}), 'n', a.s_neg * ({decay}))), g -> {bound})[0]"
    return f"CASE WHEN x.w = 0 OR x.y IS NULL THEN {same} ELSE {bound} END"


def long_form(series: DataFrame) -> DataFrame:
    """(key, signal, ts, y, w): one row a key, hour and signal."""
    parts = ", ".join(f"'{s}', CAST({s} AS DOUBLE), CAST({w} AS DOUBLE)" for s, w in SIGNALS.items())
    return series.select(*KEY, "ts", F.expr(f"stack({len(SIGNALS)}, {parts}) AS (signal, y, w)"))


def fold(
    points: DataFrame, state: DataFrame | None = None, edd: float = 10, mu0: float = 0.0, mu1: float = 0.7,
    gap_halflife: float = 48.0, warmup: bool = False, trace: bool = False,
) -> DataFrame:
    """Run the detector over long-form points; one row a key and signal with the new state, ``changes``
    and ``steps``. Keys without points keep no row."""
    keys = [*KEY, "signal"]
    grouped = points.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ts", "y", "w"))).alias("seq"))
    if state is not None:
        grouped = grouped.join(state.select(*keys, *[F.col(c).alias(f"old_{c}") for c in ("current_state", "s_pos", "s_neg", "last_change", "last_ts")]), keys, "left")
    else:
        grouped = grouped.select("*", *[F.lit(None).cast(t).alias(f"old_{c}") for c, t in (x.split() for x in STATE.split(", "))])
    zero = f"""named_struct('current_state', coalesce(old_current_state, 'unk'), 's_pos', coalesce(old_s_pos, 0D), 's_neg', coalesce(old_s_neg, 0D),
        'last_change', coalesce(old_last_change, 0), 'last_ts', old_last_ts,
        'changes', CAST(array() AS array<struct<{CHANGE.replace(' ', ':').replace(',:', ',')}>>), 'steps', CAST(array() AS array<struct<{STEP.replace(' ', ':').replace(',:', ',')}>>))"""
    step = cusum_step(edd, mu0, mu1, gap_halflife, warmup, trace)
    return grouped.select(*keys, F.expr(f"aggregate(seq, {zero}, (a, x) -> {step})").alias("r"), F.expr("seq[size(seq) - 1].ts").alias("ts"))


def detect_changes(
    series: DataFrame, state: DataFrame | None = None, edd: float = 10, mu0: float = 0.0, mu1: float = 0.7,
    gap_halflife: float = 48.0, warmup: bool = False, trace: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(changes, state, steps) of an hourly series; ``state`` resumes where an earlier run stopped."""
    keys = [*KEY, "signal"]
    done = fold(long_form(series), state, edd, mu0, mu1, gap_halflife, warmup, trace)
    changes = done.select(*keys, F.inline("r.changes"))
    new = done.select(*keys, "ts", *[f"r.{c.split()[0]}" for c in STATE.split(", ")])
    return changes, new, done.select(*keys, F.inline("r.steps"))


def state_bands(steps: DataFrame, keys: list[str], state: str = "current_state", ts: str = "ts") -> DataFrame:
    """Contiguous runs of one state: start, end and state."""
    order = Window.partitionBy(*keys).orderBy(ts)
    turned = F.when(F.lag(state).over(order).eqNullSafe(F.col(state)), 0).otherwise(1)
    run = F.sum("_turn").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        steps.withColumn("_turn", turned)
        .withColumn("_run", run)
        .groupBy(*keys, "_run", state)
        .agg(F.min(ts).alias("state_start"), F.max(ts).alias("state_end"))
        .drop("_run")
    )


def date_chunks(spark: SparkSession, start: datetime, end: datetime, day_delta: int = 1) -> DataFrame:
    """(start, end, label) that cover [start, end): single hours up to the first midnight, whole days (in
    pieces of ``day_delta``) up to the last one, single hours after it."""
    bounds = spark.sql(
        """SELECT s, e, least(e, CASE WHEN date_trunc('day', s) = s THEN s ELSE date_trunc('day', s) + INTERVAL 1 DAY END) AS first,
           greatest(date_trunc('day', e), least(e, CASE WHEN date_trunc('day', s) = s THEN s ELSE date_trunc('day', s) + INTERVAL 1 DAY END)) AS last
           FROM (SELECT CAST(:s AS TIMESTAMP) AS s, CAST(:e AS TIMESTAMP) AS e)""",
        args={"s": start, "e": end},
    )
    hours = lambda a, b: F.when(F.col(a) < F.col(b), F.sequence(F.col(a), F.col(b) - F.expr("INTERVAL 1 SECOND"), F.expr("INTERVAL 1 HOUR"))).otherwise(F.array().cast("array<timestamp>"))
    step = F.make_dt_interval(F.lit(day_delta))
    days = F.when(F.col("first") < F.col("last"), F.sequence(F.col("first"), F.col("last") - F.expr("INTERVAL 1 SECOND"), step)).otherwise(F.array().cast("array<timestamp>"))
    hour = lambda x: F.struct(x.alias("start"), (x + F.expr("INTERVAL 1 HOUR")).alias("end"), F.date_format(x, "yyyy-MM-dd'T'HH").alias("label"))
    day = lambda x: F.struct(x.alias("start"), F.least(x + step, F.col("last")).alias("end"), F.date_format(x, "yyyy-MM-dd").alias("label"))
    parts = F.concat(F.transform(hours("s", "first"), hour), F.transform(days, day), F.transform(hours("last", "e"), hour))
    return bounds.select(F.inline(parts))


def alert_rows(changes: DataFrame, explorer: str = "https://explorer.example/", panel: str = "https://panel.example/", batch: int = 10) -> DataFrame:
    """One line of text for each change with links to a window around it, numbered in batches."""
    word = F.when(F.col("change_dir") == 1, "is blocked").when(F.col("change_dir") == -1, "is unblocked").otherwise("changed")
    day = lambda n: F.date_format(F.date_add(F.to_date("ts"), n), "yyyy-MM-dd")
    query = F.concat(F.lit("?domain="), F.url_encode("domain"), F.lit("&probe_cc="), F.col("probe_cc"), F.lit("&probe_asn=AS"), F.col("probe_asn").cast("string"), F.lit("&since="), day(-13), F.lit("&until="), day(2))
    text = F.concat(F.lit("["), F.col("probe_cc"), F.lit("/AS"), F.col("probe_asn").cast("string"), F.lit("] "), F.col("domain"), F.lit(" "), word, F.lit(" - "), F.col("signal"))
    # numbered within each hour, after the changes of all hours before: one row an hour is ordered in one task
    order = Window.partitionBy("ts").orderBy("probe_cc", "probe_asn", "domain", "signal")
    before = Window.partitionBy(F.lit(1)).orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    hours = changes.groupBy("ts").agg(F.count("*").alias("n")).select(F.col("ts").alias("_hour"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    numbered = changes.withColumn("_own", F.row_number().over(order)).join(hours, F.col("ts").eqNullSafe(F.col("_hour")))
    return numbered.select(
        "ts", *KEY, "signal", "change_dir", text.alias("text"),
        F.concat(F.lit(explorer), F.lit("chart/mat"), query).alias("explorer_url"),
        F.concat(F.lit(panel), query).alias("panel_url"),
        F.floor((F.col("_before") + F.col("_own") - 1) / batch).cast("int").alias("batch"),
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    """One text a batch."""
    return alerts.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("message"))


def clear_changes(changes: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Changes outside [start, end]: what is to be written back after clearing the range."""
    return changes.filter(~F.col("ts").between(F.lit(start), F.lit(end)))


def missing_signals(keys: DataFrame, seen: DataFrame, key: str, expected: tuple) -> DataFrame:
    """(key, signal) for every expected signal that a key never gave."""
    wanted = keys.select(key, F.explode(F.array(*[F.lit(x) for x in expected])).alias("signal"))
    return wanted.join(seen.select(key, "signal").distinct(), [key, "signal"], "left_anti")


def warm_up(verdicts: DataFrame, start: datetime, days: int = 30, **options) -> DataFrame:
    """The detector's state after a replay of the days before ``start``, from nothing and without changes: what
    a run that begins at ``start`` resumes from, in place of any stored state."""
    series = hourly_series(verdicts, start - timedelta(days=days), start)
    return detect_changes(series, warmup=True, **options)[1]


def event_clusters(changes: DataFrame, keys: list[str], gap_hours: float) -> DataFrame:
    """Changes of one key and direction that lie within a gap of each other, as one event."""
    order = Window.partitionBy(*keys, "change_dir").orderBy("ts")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    apart = micros - F.lag(micros).over(order) > gap_hours * 3600e6
    numbered = changes.withColumn("_new", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)).withColumn(
        "event", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy(*keys, "change_dir", "event").agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("n_changes")
    )


def bernoulli_step(p0: float, p1: float) -> tuple[Column, Column]:
    """Log-likelihood increments (towards blocked, towards ok) of an hour with ``w`` measurements of
    which the share ``y`` is blocked."""
    y, w = F.col("y"), F.col("w")
    up = w * (y * F.log(F.lit(p1 / p0)) + (1 - y) * F.log(F.lit((1 - p1) / (1 - p0))))
    return up, -up


def bernoulli_cusum(points: DataFrame, p0: float = 0.1, p1: float = 0.7) -> DataFrame:
    """Weighted one-sided sums of each key and signal: the running sum less its running minimum."""
    keys = [*KEY, "signal"]
    up, down = bernoulli_step(p0, p1)
    order = Window.partitionBy(*keys).orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = points.filter("w > 0 AND y IS NOT NULL").withColumn("_u", F.sum(up).over(order)).withColumn("_d", F.sum(down).over(order))
    low = lambda c: F.least(F.min(c).over(order), F.lit(0.0))
    return rows.select(*keys, "ts", (F.col("_u") - low("_u")).alias("s_pos"), (F.col("_d") - low("_d")).alias("s_neg"))


def watch_list(lists: DataFrame, category: str = "GRP", cc: str = "ZZ", more: tuple = ()) -> DataFrame:
    """(domain): the domains that a list of (domain, cc, category_code) holds of a category, and some by name."""
    found = lists.filter((F.col("cc") == cc) & (F.col("category_code") == category)).select("domain")
    if more:
        found = found.unionByName(lists.sparkSession.createDataFrame([(d,) for d in more], "domain string"))
    return found.distinct()


def watched(rows: DataFrame, domains: DataFrame) -> DataFrame:
    """The rows of watched domains."""
    return rows.join(domains, "domain", "left_semi")


def panel_summary(series: DataFrame, changes: DataFrame) -> DataFrame:
    """Hours of each network, how many have a value of each resolver kind, and whether it has a change."""
    changed = changes.select("probe_asn").distinct().withColumn("has_change", F.lit(True))
    per = series.groupBy("probe_asn").agg(
        F.count("*").alias("n_hours"), F.count("dns_isp_blocked").alias("n_isp"), F.count("dns_other_blocked").alias("n_other")
    )
    return per.join(changed, "probe_asn", "left").withColumn("has_change", F.coalesce("has_change", F.lit(False)))
