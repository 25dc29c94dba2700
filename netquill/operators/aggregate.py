"""Aggregations behind the read queries: outcomes, failures, TLS consistency, shares, lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netquill.functions.scalars import time_grain

LAYERS = ("dns", "tcp", "tls")
# Failures that mean that a name does not exist.
NO_SUCH_NAME = ("dns_nxdomain_error", "android_dns_cache_no_data")


def _axes(rows: DataFrame, names: tuple, grain: str) -> tuple[DataFrame, list[str]]:
    """Axis columns: ``measurement_start_day`` is the start in the grain, others are columns."""
    out = []
    for n in names:
        if n == "measurement_start_day":
            rows = rows.withColumn(n, time_grain(F.col("measurement_start_time"), grain))
        out.append(n)
    return rows, out


def labelled_scores(verdicts: DataFrame, axes: list[str]) -> DataFrame:
    """(axes, layer, label, value): the not-ok scores of each verdict under their labels."""
    isp = F.when(F.col("resolver_asn") == F.col("probe_asn"), "dns_isp").otherwise("dns_other")
    dns = F.when(F.col("top_dns_failure").isin(*NO_SUCH_NAME), "nxdomain").otherwise(F.coalesce("top_dns_failure", F.lit("got_answer")))
    rows = verdicts.withColumn("_isp", isp).withColumn("_dns", dns)
    pairs = []
    for kind in ("blocked", "down"):
        pairs.append(("dns", F.concat("_isp", F.lit(f".{kind}."), "_dns"), f"dns_{kind}"))
        for x in ("tcp", "tls"):
            pairs.append((x, F.concat(F.lit(f"{x}.{kind}."), F.coalesce(f"top_{x}_failure", F.lit(""))), f"{x}_{kind}"))
    items = F.array(*[F.struct(F.lit(a).alias("layer"), b.alias("label"), F.col(c).cast("double").alias("value")) for a, b, c in pairs])
    return rows.select(*axes, F.inline(items))


def outcome_aggregation(
    verdicts: DataFrame, axis_x: str = "measurement_start_day", axis_y: str | None = None, time_grain_: str = "day",
    since=None, until=None, anomaly_sensitivity: float = 0.9, **filters,
) -> DataFrame:
    """One row a cell of the axes: the final outcome and its value, the ok value, and counts by kind.

    Not-ok scores are summed by label; a label's share is of its own layer's not-ok mass (so a lone small
    score has share 1). A layer is ok by what its top label leaves, the cell by its least ok layer; TLS
    without any mass is left out. The largest of the layers' tops and of ok wins; ties go to dns, tcp,
    tls, ok in that order."""
    rows = verdicts
    if since is not None:
        rows = rows.filter(F.col("measurement_start_time") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("measurement_start_time") <= F.lit(until))
    for name, wanted in filters.items():
        rows = rows.filter(F.col(name).isin(*(wanted if isinstance(wanted, (list, tuple, set)) else [wanted])))
    rows, axes = _axes(rows, tuple(a for a in (axis_x, axis_y) if a), time_grain_)
    sums = labelled_scores(rows, axes).groupBy(*axes, "layer", "label").agg(F.sum("value").alias("value")).filter("value > 0")
    layer = Window.partitionBy(*axes, "layer")
    shares = sums.withColumn("share", F.col("value") / F.sum("value").over(layer))
    order = Window.partitionBy(*axes, "layer").orderBy(F.desc("share"), "label")
    top = shares.withColumn("r", F.row_number().over(order)).filter("r = 1")
    tops = top.groupBy(*axes).agg(
        *[F.max(F.when(F.col("layer") == x, F.col("label"))).alias(f"{x}_label") for x in LAYERS],
        *[F.max(F.when(F.col("layer") == x, F.col("share"))).alias(f"{x}_share") for x in LAYERS],
    )
    cells = rows.groupBy(*axes).agg(F.count("*").alias("count"), *[F.sum(f"{x}_ok").alias(f"{x}_ok_sum") for x in LAYERS])
    both = cells.join(tops, axes, "left")
    share = lambda x: F.coalesce(f"{x}_share", F.lit(0.0))
    ok = {x: F.when(F.col(f"{x}_ok_sum") > 0, 1 - share(x)).otherwise(F.lit(0.0)) for x in LAYERS}
    no_tls = (F.col("tls_ok_sum") == 0) & (share("tls") == 0)
    ok_value = F.when(no_tls, F.least(ok["dns"], ok["tcp"])).otherwise(F.least(ok["dns"], ok["tcp"], ok["tls"]))
    candidate = lambda v, i, label: F.struct(v.alias("value"), F.lit(-i).alias("order"), label.alias("label"))
    best = F.array_max(F.array(*[candidate(share(x), i, F.coalesce(f"{x}_label", F.lit(""))) for i, x in enumerate(LAYERS)], candidate(ok_value, 3, F.lit("ok"))))
    out = both.withColumn("ok_value", ok_value).withColumn("_b", best)
    out = out.select(*axes, "count", "ok_value", F.col("_b.label").alias("outcome_label"), F.col("_b.value").alias("outcome_value"))
    return out.select("*", *outcome_counts(anomaly_sensitivity))


def all_outcomes(verdicts: DataFrame, axes: list[str]) -> DataFrame:
    """(axes, layer, label, share, place): every not-ok outcome of each cell of the axes with its share of its
    layer's not-ok mass, the layers in order and the largest share of a layer first."""
    sums = labelled_scores(verdicts, axes).groupBy(*axes, "layer", "label").agg(F.sum("value").alias("value")).filter("value <> 0")
    layer = Window.partitionBy(*axes, "layer")
    shares = sums.withColumn("share", F.col("value") / F.sum("value").over(layer))
    number = F.array_position(F.array(*[F.lit(x) for x in LAYERS]), F.col("layer"))
    order = Window.partitionBy(*axes).orderBy(number, F.desc(F.round("share", 12)), "label")
    return shares.select(*axes, "layer", "label", "share", F.row_number().over(order).alias("place"))


def outcome_counts(sensitivity: float = 0.9) -> list[Column]:
    """Ok, anomaly, confirmed and failure counts of a cell from its outcome."""
    blocked = F.contains(F.col("outcome_label"), F.lit(".blocked."))
    down = F.contains(F.col("outcome_label"), F.lit(".down."))
    sure = F.col("outcome_value") >= sensitivity
    n = F.col("count")
    one = lambda cond, name: F.when(cond, n).otherwise(0).alias(name)
    return [
        one(F.col("outcome_label") == "ok", "ok_count"),
        one(blocked & ~sure, "anomaly_count"),
        one(blocked & sure, "confirmed_count"),
        one(down, "failure_count"),
    ]


def observed_failure() -> Column:
    """The first failure of an observation with its layer; a handshake that ended on its first write failed
    after the client hello. ``none`` needs a server name; NULL where a handshake ended so without a failure, or
    there is neither a failure nor a server name."""
    tls = (
        F.when(F.col("tls_handshake_last_operation") == "write_1", F.concat(F.lit("tls_"), "tls_failure", F.lit("_after_CH")))
        .when(F.col("tls_failure").isNull() & F.col("tls_server_name").isNotNull(), "none")
        .otherwise(F.concat(F.lit("tls_"), "tls_failure"))
    )
    first = tls
    for x in ("tcp", "dns"):
        first = F.when(F.col(f"{x}_failure").isNotNull(), F.concat(F.lit(f"{x}_"), f"{x}_failure")).otherwise(first)
    return first


def failure_aggregation(
    obs: DataFrame, group_by: tuple = ("failure",), grain: str = "day", since=None, until=None, **in_filters
) -> DataFrame:
    """Observations counted by the chosen keys, most frequent first. Each filter is also a key; time is
    strictly inside (since, until). Grouping by failure leaves out observations of HTTP alone."""
    keys = list(group_by) + [k for k in in_filters if k not in group_by]
    rows = obs
    if since is not None:
        rows = rows.filter(F.col("measurement_start_time") > F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("measurement_start_time") < F.lit(until))
    for name, wanted in in_filters.items():
        rows = rows.filter(F.col(name).isin(*wanted))
    if "failure" in keys:
        rows = rows.filter("dns_failure IS NOT NULL OR tcp_failure IS NOT NULL OR tls_failure IS NOT NULL OR tls_server_name IS NOT NULL")
        rows = rows.withColumn("failure", observed_failure())
    if "timestamp" in keys:
        rows = rows.withColumn("timestamp", time_grain(F.col("measurement_start_time"), grain))
    out = rows.groupBy(*keys).agg(F.count("*").alias("observation_count"))
    order = [F.col("timestamp")] if "timestamp" in keys else []
    return out.orderBy(*order, F.desc("observation_count"), *[k for k in keys if k != "timestamp"])


def failure_class() -> Column:
    """``layer.failure`` of an observation's first failure, unknown ones folded; ``ok`` without one."""
    text = F.lit("ok")
    for layer, name in (("https", "http"), ("tls", "tls"), ("tcp", "tcp"), ("dns", "dns")):
        c = F.col(f"{name}_failure")
        part = F.when(c.startswith("unknown_failure"), F.lit("unknown_failure")).otherwise(c)
        text = F.when(c.isNotNull(), F.concat(F.lit(f"{layer}."), part)).otherwise(text)
    return text


def failure_classes(obs: DataFrame, keys: list[str], grain: str = "day") -> DataFrame:
    """Observations by key, start of the grain and class of failure; one row an observation is counted."""
    rows = obs.select(*keys, time_grain(F.col("measurement_start_time"), grain).alias("ts"), failure_class().alias("failure_str"))
    return rows.groupBy(*keys, "ts", "failure_str").agg(F.count("*").alias("cnt"))


IP_META = ("ip_cc", "ip_asn", "ip_as_cc", "ip_as_org_name")


def tls_evidence(obs: DataFrame, ctrl: DataFrame) -> DataFrame:
    """Full outer join of the experiment's handshakes without failure, by address, what is known of it and
    server name, and the control's successful ones by address and name."""
    meta = [c for c in IP_META if c in obs.columns]
    named = "ip IS NOT NULL AND tls_server_name IS NOT NULL"
    a = obs.filter(f"{named} AND tls_failure IS NULL").groupBy("ip", "tls_server_name", *meta).agg(
        F.count("*").alias("msmt_count"), F.count_distinct("probe_cc", "probe_asn").alias("vp_count")
    )
    b = ctrl.filter(f"{named} AND tls_success = 1").groupBy("ip", "tls_server_name").agg(F.count("*").alias("ctrl_count"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return a.join(b, ["ip", "tls_server_name"], "full").select(
        "ip", "tls_server_name", *meta, zero("msmt_count"), zero("vp_count"), F.col("ctrl_count").isNotNull().alias("in_ctrl"), zero("ctrl_count"),
    )


def tls_consistency(obs: DataFrame, ctrl: DataFrame) -> DataFrame:
    """Per address and name: handshakes, vantage points, control flag, and one of the values of each property of
    the address (the smallest, so that reruns agree)."""
    rows = tls_evidence(obs, ctrl)
    meta = [c for c in IP_META if c in rows.columns]
    return rows.groupBy("ip", "tls_server_name").agg(
        F.sum(F.col("msmt_count") + F.col("ctrl_count")).alias("msmt_count"), F.sum("vp_count").alias("vp_count"),
        F.max("in_ctrl").alias("in_ctrl"), *[F.min(c).alias(c) for c in meta],
    )


def rule_distribution(verdicts: DataFrame, layer: str) -> DataFrame:
    return verdicts.groupBy(F.col(f"top_{layer}_rule_id").alias("rule_id")).agg(
        F.count("*").alias("n"), F.count_if(F.col(f"{layer}_blocked") > 0.5).alias("n_blocked")
    ).select(F.lit(layer).alias("layer"), "rule_id", "n", "n_blocked")


def share_of_total(rows: DataFrame, keys: list[str], total: list[str]) -> DataFrame:
    """Count of each key and its share of the count of ``total``."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*total)))


def topk_other(rows: DataFrame, layer: str, label: str, most: int = 3, keep: int = 2) -> DataFrame:
    """Categories of each layer; if there are more than ``most``, all but the ``keep`` most frequent
    become ``<layer>_other``."""
    counted = rows.groupBy(layer, label).agg(F.count("*").alias("n"))
    by = Window.partitionBy(layer)
    ranked = counted.withColumn("r", F.row_number().over(by.orderBy(F.desc("n"), label))).withColumn("k", F.count("*").over(by))
    name = F.when((F.col("r") <= keep) | (F.col("k") <= most), F.col(label)).otherwise(F.concat(F.col(layer), F.lit("_other")))
    return ranked.select(layer, name.alias("category"), "n").groupBy(layer, "category").agg(F.sum("n").alias("n"))


def list_observations(rows: DataFrame, equal: dict, since=None, until=None, order_by: str = "measurement_start_time", descending: bool = True, offset: int = 0, limit: int = 100, unique: str = "measurement_uid", time: str = "measurement_start_time") -> DataFrame:
    """A page of rows under equality filters and an inclusive time range, with a unique last sort key."""
    for name, value in equal.items():
        if value is not None:
            rows = rows.filter(F.col(name) == F.lit(value))
    if since is not None:
        rows = rows.filter(F.col(time) >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col(time) <= F.lit(until))
    first = F.desc(order_by) if descending else F.asc(order_by)
    return rows.orderBy(first, unique).offset(offset).limit(limit)


def list_verdicts(verdicts: DataFrame, offset: int = 0, limit: int = 100) -> DataFrame:
    """A page of verdicts under their public names, with anomaly and confirmed flags from the sum of the
    layers' blocked scores."""
    total = F.aggregate(F.array(*[F.col(f"{x}_blocked").cast("double") for x in LAYERS]), F.lit(0.0), lambda a, x: a + x)
    names = {"top_dns_failure": "dns_failure", "top_tcp_failure": "tcp_failure", "top_tls_failure": "tls_failure"}
    page = verdicts.withColumn("_t", total).orderBy("measurement_start_time", "measurement_uid").offset(offset).limit(limit)
    return page.select(
        "measurement_uid", "measurement_start_time", "probe_cc", "probe_asn", "domain", *names,
        (F.col("_t") > 0.5).alias("anomaly"), (F.col("_t") == 1.0).alias("confirmed"),
    ).withColumnsRenamed(names)
