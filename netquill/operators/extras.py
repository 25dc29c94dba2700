"""Hourly cells, profiles, confounds, hierarchical labels, strata and presentation states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LAYERS = ("dns", "tcp", "tls")


def dense_hours(rows: DataFrame, keys: list[str], ts: str = "measurement_start_time", start=None, end=None) -> DataFrame:
    """Rows counted by key and hour, empty hours with 0, over the hours of [start, end]: without bounds from the first
    hour of all rows to the last, so a row of a stray date makes every key's hours many. Rows outside are not counted."""
    hour = F.date_trunc("hour", ts)
    for bound, keep in ((start, lambda v: F.col(ts) >= v), (end, lambda v: F.col(ts) <= v)):
        if bound is not None:
            rows = rows.filter(keep(F.lit(bound)))
    counted = rows.groupBy(*keys, hour.alias("ts")).agg(F.count("*").alias("n"))
    edge = lambda bound, found: found if bound is None else F.date_trunc("hour", F.lit(bound))
    span = rows.agg(edge(start, F.min(hour)).alias("lo"), edge(end, F.max(hour)).alias("hi"))
    # one row beside one row a key; hours are made in the row
    grid = counted.select(*keys).distinct().join(F.broadcast(span)).select(*keys, F.explode(F.expr("sequence(lo, hi, INTERVAL 1 HOUR)")).alias("ts"))
    return grid.join(counted, [*keys, "ts"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def cell_state(verdicts: DataFrame, keys: list[str], session: str | None = None) -> DataFrame:
    """For each cell (keys and hour) and layer, how often each rule won: (keys, ts, layer, rule_id, n),
    with the cell's measurements and known probes."""
    hour = F.date_trunc("hour", "measurement_start_time").alias("ts")
    cell = verdicts.groupBy(*keys, hour).agg(
        F.count_distinct("measurement_uid").alias("n_measurements"),
        F.count_distinct(F.when(F.col("probe_id") != "", F.col("probe_id"))).alias("n_probes"),
        *([F.count_distinct(session).alias("n_sessions")] if session else []),
    )
    stacked = ", ".join(f"'{x}', top_{x}_rule_id" for x in LAYERS)
    long = verdicts.select(*keys, hour, F.expr(f"stack({len(LAYERS)}, {stacked}) AS (layer, rule_id)"))
    return long.groupBy(*keys, "ts", "layer", "rule_id").agg(F.count("*").alias("n")).join(cell, [*keys, "ts"])


def cell_histograms(state: DataFrame, keys: list[str]) -> DataFrame:
    """The same with one map of rule counts a cell and layer."""
    return state.groupBy(*keys, "ts", "layer").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("rule_id", "n")))).alias("rules")
    )


def cell_verdict(state: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """The dominant outcome of each cell and layer, the dominant rule within it, and its share. Ties go
    to the later name."""
    known = rules.select("layer", "rule_id", "outcome")
    # the rule table has a few dozen rows
    rows = state.join(F.broadcast(known), ["layer", "rule_id"], "left").withColumn("outcome", F.coalesce("outcome", F.lit("unknown")))
    by = [*keys, "ts", "layer"]
    outcomes = rows.groupBy(*by, "outcome").agg(F.sum("n").alias("n_outcome"), F.max_by("rule_id", F.struct("n", "rule_id")).alias("rule_id"))
    best = outcomes.groupBy(*by).agg(
        F.max(F.struct("n_outcome", "outcome", "rule_id")).alias("b"), F.sum("n_outcome").alias("total")
    )
    return best.select(*by, "b.outcome", "b.rule_id", (F.col("b.n_outcome") / F.col("total")).alias("share"), "total")


# Rules that rest on something which settles the matter alone, and one that is ambiguous.
ARTEFACTS, AMBIGUOUS = ("country_consistent_blockpage", "bogon_not_in_ctrl"), ("dns_system_failure_no_ctrl",)


def presentation(verdict: DataFrame, least: int = 3) -> DataFrame:
    """What to show of a cell, by the kind of evidence behind its dominant rule and not by a score: blocked (with an
    artefact), likely_blocked, impaired (an ambiguous rule), down, ok, or insufficient: below the floor of ``least``
    results, or without a rule that tells anything."""
    state = (
        F.when(F.coalesce("total", F.lit(0)) < least, "insufficient")
        .when((F.col("outcome") == "blocked") & F.col("rule_id").isin(*ARTEFACTS), "blocked")
        .when(F.col("outcome") == "blocked", "likely_blocked")
        .when(F.col("rule_id").isin(*AMBIGUOUS), "impaired")
        .when(F.col("outcome").isin("down", "ok"), F.col("outcome"))
        .otherwise("insufficient")
    )
    return verdict.withColumn("state", state)


def profile(rows: DataFrame, keys: list[str], score: str, witness: str, threshold: float) -> DataFrame:
    """Highest score, how many exceed a threshold, how many there are, and who holds the highest."""
    return rows.groupBy(*keys).agg(
        F.max(score).alias("max_score"),
        F.count_if(F.col(score) > threshold).alias("n_over"),
        F.count("*").alias("n"),
        F.max_by(witness, F.struct(score, witness)).alias("witness"),
    )


def confound(rows: DataFrame, failure: str, inner: str, outer: str) -> DataFrame:
    """How many versions and networks show each failure: one version on many networks points to the
    software and not to the network."""
    return rows.filter(F.col(failure).isNotNull()).groupBy(failure).agg(
        F.count_distinct(inner).alias("n_inner"), F.count_distinct(outer).alias("n_outer"), F.count("*").alias("n")
    ).withColumn("software_suspect", (F.col("n_inner") == 1) & (F.col("n_outer") > 1))


def ancestors(label: Column) -> Column:
    """``a.b.c`` → [a, a.b, a.b.c]."""
    parts = F.split(label, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "."))


def hierarchical_scores(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision and recall over labels with all their ancestors."""
    a, b = ancestors(F.col(truth)), ancestors(F.col(guess))
    sums = rows.agg(F.sum(F.size(F.array_intersect(a, b))).alias("both"), F.sum(F.size(a)).alias("t"), F.sum(F.size(b)).alias("g"))
    return sums.select(F.try_divide("both", "g").alias("precision"), F.try_divide("both", "t").alias("recall"))


def strata_sample(rows: DataFrame, strata: list[str], key: str, per_stratum: int, design: str) -> DataFrame:
    """A fixed number of rows a stratum, first in the order of a hash of design and key, with the weight
    that each stands for. The same design draws the same rows."""
    order = F.md5(F.concat(F.lit(design), F.lit(":"), F.col(key).cast("string")))
    ranked = rows.withColumn("_h", order).withColumn("_r", F.row_number().over(Window.partitionBy(*strata).orderBy("_h", key)))
    sizes = rows.groupBy(*strata).agg(F.count("*").alias("stratum_size"))
    out = ranked.filter(F.col("_r") <= per_stratum).join(sizes, strata)
    return out.withColumn("weight", F.col("stratum_size") / F.least(F.col("stratum_size"), F.lit(per_stratum))).drop("_h", "_r")


def design_id(*parts: str) -> Column:
    """Content-hashed id of a sampling design."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.lit(p) for p in parts]), 256), 1, 16)


def event_fields(events: DataFrame) -> DataFrame:
    """Whether an event goes on, the layers of its labels, and a band of its size."""
    band = F.when(F.col("n_networks") >= 10, "national").when(F.col("n_networks") >= 3, "regional").otherwise("local")
    return events.select(
        "*",
        F.col("ended").isNull().alias("ongoing"),
        F.array_sort(F.array_distinct(F.transform("labels", lambda x: F.split(x, r"\.")[0]))).alias("layers"),
        band.alias("size_band"),
    )


def arrival_lag(rows: DataFrame, keys: list[str], measured: str, bucket: str) -> DataFrame:
    """Median and 90th percentile of the seconds from measurement to bucket."""
    lag = F.timestamp_diff("SECOND", F.col(measured), F.col(bucket))
    return rows.groupBy(*keys).agg(
        F.percentile(lag, F.lit(0.5)).alias("p50"), F.percentile(lag, F.lit(0.9)).alias("p90"), F.count("*").alias("n")
    )


def running_sum(rows: DataFrame, keys: list[str], order: str, value: str, name: str, span: int = 4096) -> DataFrame:
    """Sum of ``value`` from a key's first row to each row, by a whole-numbered ``order`` without repeats.
    Rows are summed in spans of ``order``, so no task takes all rows of a key; one row a span is summed
    across spans. ``value`` may not be NULL."""
    kept = rows.columns
    rows = rows.withColumn("_span", F.floor(F.col(order) / span))
    by = [*keys, "_span"]
    within = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy(*by).agg(F.sum(value).alias("_sum")).select(*[F.col(c).alias(f"_of_{c}") for c in by], F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    summed = rows.withColumn("_own", F.sum(value).over(within)).join(spans, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by])
    return summed.select(*kept, (F.col("_own") + F.col("_before")).alias(name))
