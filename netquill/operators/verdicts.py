"""From observations and a control population to one verdict a measurement.

Evidence stays in long form: what the control population and other probes know of an address is one row of
counts a (hostname, day, address), what the control knows of a host one row a (hostname, day). Observations meet
both by equality, so no row carries a host's addresses and the rows of a hot host are spread by address. Evidence is
staged and counted, and goes to the rows where it is small (see :func:`met`). Then the rows are dealt by measurement,
once for the answers that a measurement's rows share and for its verdict.
``grain`` is the width of the day key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netquill.functions.scalars import is_ipv4, is_ipv6, map_get0, safe_div, url_domain
from netquill.operators.rules import VERSION, score_layers
from netquill.sources.io import staged

# Networks of content delivery and cloud providers.
CLOUD_ASNS = [13335, 209242, 20940, 9002, 16625, 63949, 16509, 14618, 15169, 396982, 54113, 8075, 8068]

#: predicate of each address map of the control side
MAPS = {
    "ctrl_dns_answers": "dns_success = 1",
    "ctrl_tls_success_ips": "tls_success = 1",
    "ctrl_tls_inconsistent_ips": "tls_success = 0 AND startswith(tls_failure, 'ssl_')",
    "ctrl_tls_failing_ips": "tls_success = 0 AND tls_failure IS NOT NULL",
    "ctrl_tcp_success_ips": "tcp_success = 1",
    "ctrl_tcp_failing_ips": "tcp_success = 0",
}
KEY = ["hostname", "measurement_day"]
#: columns of observations that :func:`web_verdicts` reads
OBSERVED = (
    "measurement_uid", "measurement_start_time", "report_id", "input", "test_name", "hostname", "ip", "ip_is_bogon", "ip_asn", "probe_asn", "probe_cc",
    "probe_id", "probe_analysis", "resolver_asn", "network_type", "dns_engine", "dns_failure", "dns_answer", "tcp_success", "tcp_failure", "tls_failure",
    "tls_is_certificate_valid",
)
#: rows of evidence that are sent to the observations; more of them are joined by a shuffle of both
SMALL = 1 << 19


def with_day(rows: DataFrame, grain: str = "day") -> DataFrame:
    return rows.withColumn("measurement_day", F.date_trunc(grain, "measurement_start_time"))


def between(rows: DataFrame, start=None, end=None) -> DataFrame:
    """Rows in (start, end]; applied to every input, since time is no join key."""
    if start is not None:
        rows = rows.filter(F.col("measurement_start_time") > F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("measurement_start_time") <= F.lit(end))
    return rows


def _entries(key: str, n: str) -> Column:
    pairs = F.filter(F.collect_list(F.struct(F.col(key).alias("key"), F.col(n).alias("value"))), lambda e: (e.value > 0) & e.key.isNotNull())
    return F.map_from_entries(F.array_sort(pairs))


def control_counts(ctrl: DataFrame, cloud: list[int] | None = None) -> DataFrame:
    """DNS failures and successes, and distinct cloud and other addresses, of each hostname and day."""
    inside = F.col("ip_asn").isin(CLOUD_ASNS if cloud is None else cloud)
    return ctrl.groupBy(*KEY).agg(
        F.count_if(F.col("dns_failure").isNotNull()).alias("ctrl_dns_failure_count"),
        F.count_if(F.col("dns_success") == 1).alias("ctrl_dns_success_count"),
        F.count_distinct(F.when(inside, F.col("ip"))).alias("cloud_provider_ips_count"),
        F.count_distinct(F.when(~inside, F.col("ip"))).alias("not_cloud_provider_ips_count"),
    )


def control_maps(ctrl: DataFrame) -> DataFrame:
    """Address → count maps of each hostname and day under the predicates of MAPS, and the answers'
    ASNs. Counts are summed in long form first; maps are made once at the end."""
    by_ip = ctrl.groupBy(*KEY, "ip").agg(*[F.count_if(F.expr(p)).alias(n) for n, p in MAPS.items()])
    maps = by_ip.groupBy(*KEY).agg(*[_entries("ip", n).alias(n) for n in MAPS])
    by_asn = ctrl.filter("dns_success = 1 AND ip_asn <> 0").groupBy(*KEY, "ip_asn").agg(F.count("*").alias("n"))
    asns = by_asn.groupBy(*KEY).agg(_entries("ip_asn", "n").alias("ctrl_dns_answers_asns"))
    return maps.join(asns, KEY, "left").withColumn(
        "ctrl_dns_answers_asns", F.coalesce("ctrl_dns_answers_asns", F.create_map().cast("map<bigint,bigint>"))
    )


def rate_map(ok: Column, failing: Column) -> Column:
    """Success rate of every address in either map."""
    ips = F.array_sort(F.array_union(F.map_keys(ok), F.map_keys(failing)))
    rate = lambda ip: safe_div(map_get0(ok, ip), map_get0(ok, ip) + map_get0(failing, ip))
    return F.map_from_entries(F.transform(ips, lambda ip: F.struct(ip, rate(ip))))


def consistent_ips(obs: DataFrame, at_least_probes: int = 0) -> DataFrame:
    """Addresses whose certificate was valid for some probe, by hostname and day; ``at_least_probes``
    admits only those that so many known probes saw."""
    valid = obs.filter("tls_is_certificate_valid = 1")
    if at_least_probes:
        valid = (
            valid.groupBy(*KEY, "ip")
            .agg(F.count_distinct(F.when(F.col("probe_id") != "", F.col("probe_id"))).alias("n"))
            .filter(F.col("n") >= at_least_probes)
        )
    return valid.groupBy(*KEY).agg(F.array_sort(F.collect_set("ip")).alias("other_tls_consistent_ips"))


def control_baseline(ctrl: DataFrame, obs: DataFrame, start=None, end=None, grain: str = "day") -> DataFrame:
    """One row a hostname and day with all that the rules ask of the control population."""
    ctrl, obs = (with_day(between(x, start, end), grain) for x in (ctrl, obs))
    joined = control_counts(ctrl).join(control_maps(ctrl), KEY).join(consistent_ips(obs), KEY, "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "*",
        F.array_union(F.map_keys("ctrl_tls_success_ips"), F.coalesce("other_tls_consistent_ips", none)).alias("union_tls_consistent_ips"),
        rate_map(F.col("ctrl_tls_success_ips"), F.col("ctrl_tls_failing_ips")).alias("ctrl_tls_success_rates"),
        rate_map(F.col("ctrl_tcp_success_ips"), F.col("ctrl_tcp_failing_ips")).alias("ctrl_tcp_success_rates"),
    )


def with_windows(obs: DataFrame) -> DataFrame:
    """Answers of a measurement's system resolver and failure rates of its report. Both are aggregated with
    map-side combine and joined back, so the wide rows of a large report are not gathered."""
    v4, v6 = is_ipv4(F.col("ip")), is_ipv6(F.col("ip"))
    obs = obs.withColumn("ip_is_v4", v4).withColumn("ip_is_v6", v6)
    local = F.col("dns_engine").isin("getaddrinfo", "system") & (F.col("ip_is_v6") | F.col("ip_is_v4"))
    key = ["measurement_uid", "hostname", "ip_is_v6"]
    own = obs.filter(local).groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(
        F.array_sort(F.collect_list("dns_answer")).alias("dns_answers"),
        F.array_sort(F.collect_list("ip_asn")).alias("dns_answers_asns"),
        F.max(F.col("ip_is_bogon").cast("int")).alias("dns_answers_contain_bogon"),
    )
    out = obs.join(own, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key], "left").drop(*[f"_{c}" for c in key])
    out = _with_rates(out, obs)
    none = lambda c: F.coalesce(c, F.array().cast(own.schema[c].dataType))
    return out.withColumns({
        "dns_answers": none("dns_answers"),
        "dns_answers_asns": none("dns_answers_asns"),
        "dns_answers_contain_bogon": F.coalesce("dns_answers_contain_bogon", F.lit(0)),
    })


def full_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """(pattern, expected_countries, dns_blocking_scope) of the patterns that match a whole answer."""
    codes = F.array_distinct(F.flatten(F.collect_list(F.transform(F.split("expected_countries", ","), lambda c: F.trim(c)))))
    return fingerprints.filter("pattern_type = 'full'").groupBy("pattern").agg(
        F.array_sort(F.filter(codes, lambda c: c != "")).alias("expected_countries"), F.min("scope").alias("dns_blocking_scope")
    )


def control_evidence(ctrl: DataFrame) -> DataFrame:
    """One row a hostname, day, address and network: how often the control met each predicate of MAPS, and its DNS
    results. From it come both kinds of evidence, so that the control is read once."""
    return ctrl.groupBy(*KEY, "ip", "ip_asn").agg(
        *[F.count_if(F.expr(p)).alias(n) for n, p in MAPS.items()],
        F.count_if(F.col("dns_failure").isNotNull()).alias("ctrl_dns_failure_count"),
        F.count_if(F.col("dns_success") == 1).alias("ctrl_dns_success_count"),
    )


def _by_address(told: DataFrame, obs: DataFrame) -> DataFrame:
    known = told.filter("ip IS NOT NULL").select(*KEY, "ip", *MAPS, F.lit(0).alias("seen_valid"))
    seen = obs.filter("tls_is_certificate_valid = 1 AND ip IS NOT NULL").select(*KEY, "ip", *[F.lit(0).cast("long").alias(n) for n in MAPS], F.lit(1).alias("seen_valid"))
    return known.unionByName(seen).groupBy(*KEY, "ip").agg(*[F.sum(n).alias(n) for n in MAPS], F.max("seen_valid").alias("seen_valid"))


def _by_host(told: DataFrame) -> DataFrame:
    counts = ("ctrl_dns_failure_count", "ctrl_dns_success_count")
    return told.groupBy(*KEY).agg(
        *[F.sum(n).alias(n) for n in counts],
        F.collect_set(F.when((F.col("ctrl_dns_success_count") > 0) & (F.col("ip_asn") != 0), F.col("ip_asn"))).alias("_asns"),
    )


def address_evidence(ctrl: DataFrame, obs: DataFrame) -> DataFrame:
    """One row a hostname, day and address: how often the control met each predicate of MAPS, and whether the
    certificate of the address was valid for some probe (``seen_valid``)."""
    return _by_address(control_evidence(ctrl), obs)


def host_evidence(ctrl: DataFrame) -> DataFrame:
    """One row a hostname and day that the control knows: its DNS results and the networks of its answers."""
    return _by_host(control_evidence(ctrl))


def met(evidence: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Evidence as observations meet it: staged, counted, and sent to them if it has at most ``most`` rows (SMALL
    if not given), so that the far more numerous observations stay where they are."""
    told = staged(evidence, name)
    return F.broadcast(told) if told.count() <= (SMALL if most is None else most) else told


def report_rates(obs: DataFrame) -> DataFrame:
    """TCP failures and successes of each report by address family."""
    v4, v6 = is_ipv4(F.col("ip")), is_ipv6(F.col("ip"))
    failed, good = F.col("tcp_failure").isNotNull(), F.col("tcp_success") == 1
    return obs.groupBy(F.col("report_id").alias("_report_id")).agg(
        F.count_if(v6 & failed).alias("tcp_ipv6_failure_count"), F.count_if(v6 & good).alias("tcp_ipv6_success_count"),
        F.count_if(v4 & failed).alias("tcp_ipv4_failure_count"), F.count_if(v4 & good).alias("tcp_ipv4_success_count"),
    )


def _with_rates(rows: DataFrame, obs: DataFrame) -> DataFrame:
    rate = lambda v: safe_div(F.col(f"tcp_{v}_failure_count"), F.col(f"tcp_{v}_failure_count") + F.col(f"tcp_{v}_success_count"))
    rates = met(report_rates(obs), "report_rates")
    out = rows.join(rates, F.col("report_id").eqNullSafe(F.col("_report_id")), "left").drop("_report_id")
    return out.withColumns({"tcp_ipv6_failure_rate": rate("ipv6"), "tcp_ipv4_failure_rate": rate("ipv4")})


def with_flags(obs: DataFrame, by_ip: DataFrame, by_host: DataFrame, fingerprints: DataFrame | None = None) -> DataFrame:
    """Observations with the columns that the rules read, from :func:`address_evidence` and :func:`host_evidence`.
    Counts of what is not known are 0, rates stay NULL. The answers of a measurement's own resolver to a name are
    shared by its rows of that name and address family."""
    rows = obs.withColumns({"ip_is_v4": is_ipv4(F.col("ip")), "ip_is_v6": is_ipv6(F.col("ip"))})
    if fingerprints is None:
        rows = rows.withColumns({"expected_countries": F.array().cast("array<string>"), "dns_blocking_scope": F.lit("")})
    else:
        known = met(full_fingerprints(fingerprints), "fingerprints")
        rows = rows.join(known, rows.dns_answer == known.pattern, "left").drop("pattern")
        rows = rows.withColumns({
            "expected_countries": F.coalesce("expected_countries", F.array().cast("array<string>")), "dns_blocking_scope": F.coalesce("dns_blocking_scope", F.lit("")),
        })
    rows = _with_rates(rows.join(met(by_host.withColumn("_known", F.lit(True)), "host_evidence"), KEY, "left"), obs)
    # what lists and counts of a host say of a row is settled here, so that none of them is dealt with the row
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = rows.withColumns({
        "_asn_met": F.array_contains("_asns", F.col("ip_asn")),
        "ctrl_dns_success_rate": safe_div(n("ctrl_dns_success_count"), n("ctrl_dns_failure_count") + n("ctrl_dns_success_count")),
        "dns_blocking_country_consistent": (F.col("dns_blocking_scope") != "fp") & F.coalesce(F.array_contains("expected_countries", F.col("probe_cc")), F.lit(False)),
    }).drop("_asns")
    local = F.coalesce(F.col("dns_engine").isin("getaddrinfo", "system"), F.lit(False)) & (F.col("ip_is_v6") | F.col("ip_is_v4"))
    # an answer that is not the row's own address is looked up by a row of its own, which goes again
    at = lambda extra, c: F.struct(F.lit(extra).alias("extra"), F.col(c).alias("ip"))
    lookups = F.when(local & (F.col("dns_answer") != F.col("ip")), F.array(at(0, "ip"), at(1, "dns_answer"))).otherwise(F.array(at(0, "ip")))
    rows = rows.withColumn("_local", F.coalesce(local, F.lit(False))).withColumn("_at", F.explode(lookups))
    rows = rows.withColumns({"_ip": F.col("_at.ip"), "_extra": F.col("_at.extra")}).drop("_at")
    rows = rows.join(met(by_ip.withColumnRenamed("ip", "_ip"), "address_evidence"), [*KEY, "_ip"], "left")
    answer = F.col("_local") & F.coalesce(F.col("_ip") == F.col("dns_answer"), F.lit(False))
    here = F.col("_local") & (F.col("_extra") == 0)
    # what a row tells its measurement, a bit each, so that the answers and their counts are not dealt with it
    told = {
        "dns_tls_consistent": answer & ((F.col("ctrl_tls_success_ips") > 0) | ((F.col("seen_valid") > 0) & F.col("_known"))),
        "dns_tls_inconsistent": answer & (F.col("ctrl_tls_inconsistent_ips") > 0),
        "dns_answer_matches_ctrl": answer & (F.col("ctrl_dns_answers") > 0),
        "dns_answer_asn_matches_ctrl": here & F.col("_asn_met"),
    }
    bits = {c: 1 << i for i, c in enumerate(told)}
    tells = [F.when(cond, bits[c]).otherwise(0) for c, cond in told.items()]
    rows = rows.withColumns({
        "_answer": F.when(answer, 1).otherwise(0), "_bogon": F.when(here, F.col("ip_is_bogon").cast("int")), "_told": reduce(Column.bitwiseOR, tells),
        "ctrl_tls_success_count": n("ctrl_tls_success_ips"), "ctrl_tls_failing_count": n("ctrl_tls_failing_ips"),
        "ctrl_tcp_success_count": n("ctrl_tcp_success_ips"), "ctrl_tcp_failing_count": n("ctrl_tcp_failing_ips"),
    }).drop("_ip", "_local", "_known", "_asn_met", "seen_valid", *MAPS).repartition("measurement_uid")
    own = Window.partitionBy("measurement_uid", "hostname", "ip_is_v6")
    rows = rows.withColumns({
        "dns_answer_count": F.sum("_answer").over(own),
        "dns_answers_contain_bogon": F.coalesce(F.max("_bogon").over(own), F.lit(0)),
        "_told": F.bit_or("_told").over(own),
    }).filter("_extra = 0")
    # without an address both counts are 0, and a rate of nothing is NULL
    rate = lambda x: safe_div(F.col(f"ctrl_{x}_success_count"), F.col(f"ctrl_{x}_success_count") + F.col(f"ctrl_{x}_failing_count"))
    return rows.withColumns({
        **{c: F.col("_told").bitwiseAND(b) > 0 for c, b in bits.items()}, "ctrl_tls_success_rate": rate("tls"), "ctrl_tcp_success_rate": rate("tcp"),
    }).drop("_answer", "_bogon", "_told", "_extra")


def top_rule(layer: str) -> Column:
    """Rule with most evidence, then most blocked."""
    return F.max_by(f"{layer}_rule_id", F.struct(f"{layer}_evidence", f"{layer}_blocked", f"{layer}_rule_id"))


def roll_up(scored: DataFrame) -> DataFrame:
    """One verdict a measurement: highest scores, most frequent failures (the smallest of equals) and
    the winning rules."""
    keys = ["probe_asn", "probe_cc", "resolver_asn", "network_type", "test_name", "measurement_start_time", "measurement_uid", "probe_id"]
    return scored.groupBy(url_domain(F.col("input")).alias("domain"), "input", *keys).agg(
        F.mode("probe_analysis", True).alias("top_probe_analysis"),
        *[F.mode(f"{x}_failure", True).alias(f"top_{x}_failure") for x in ("dns", "tcp", "tls")],
        *[F.max(f"{x}_{s}").alias(f"{x}_{s}") for x in ("dns", "tcp", "tls") for s in ("blocked", "down", "ok")],
        *[top_rule(x).alias(f"top_{x}_rule_id") for x in ("dns", "tcp", "tls")],
        F.lit(VERSION).alias("analysis_rules_version"),
    )


def scored_rows(
    obs: DataFrame, ctrl: DataFrame, fingerprints: DataFrame | None = None, start=None, end=None, grain: str = "day", own: DataFrame | None = None
) -> DataFrame:
    """Observations (or ``own``, some of them) with flags and the scores of the three layers; the certificates of all
    of ``obs`` are evidence."""
    obs, ctrl, own = (with_day(between(x, start, end), grain) for x in (obs, ctrl, obs if own is None else own))
    told = staged(control_evidence(ctrl), "control_evidence")
    return score_layers(with_flags(own, _by_address(told, obs), _by_host(told), fingerprints))


def web_verdicts(
    obs: DataFrame,
    ctrl: DataFrame,
    fingerprints: DataFrame | None = None,
    start=None,
    end=None,
    probe_cc: tuple = (),
    test_name: tuple = ("web_connectivity",),
    measurement_uid: str | None = None,
    grain: str = "day",
) -> DataFrame:
    """The verdict of every measurement in (start, end]. Filters of probe and test apply to the
    experiment; other probes' certificates count whatever their country."""
    own = obs
    if probe_cc:
        own = own.filter(F.col("probe_cc").isin(*probe_cc))
    if test_name:
        own = own.filter(F.col("test_name").isin(*test_name))
    if measurement_uid is not None:
        own = own.filter(F.col("measurement_uid") == measurement_uid)
    return roll_up(scored_rows(obs, ctrl, fingerprints, start, end, grain, own))
