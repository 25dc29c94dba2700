"""Queries over the control side, the windows, the flags, the rules and the verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from netquill.operators import verdicts as V
from netquill.plans.catalog import query
from netquill.plans.standins import ctes, frame
from netquill.sources.io import staged

GRAIN = "month"

#: what the rules read, of observations o and control observations c
EVIDENCE = """,
c2 AS (SELECT *, date_trunc('month', measurement_start_time) AS measurement_day FROM c),
o2 AS (SELECT *, date_trunc('month', measurement_start_time) AS measurement_day, ip LIKE '%:%' AS ip_is_v6,
       ip NOT LIKE '%:%' AS ip_is_v4, coalesce(dns_engine IN ('system', 'getaddrinfo'), false) AS local FROM o),
cip AS (SELECT hostname, measurement_day, ip,
    count(*) FILTER (WHERE dns_success = 1) AS answers, count(*) FILTER (WHERE tls_success = 1) AS tls_ok,
    count(*) FILTER (WHERE tls_success = 0 AND tls_failure LIKE 'ssl\\_%' ESCAPE '\\') AS tls_bad,
    count(*) FILTER (WHERE tls_success = 0 AND tls_failure IS NOT NULL) AS tls_fail,
    count(*) FILTER (WHERE tcp_success = 1) AS tcp_ok, count(*) FILTER (WHERE tcp_success = 0) AS tcp_fail
  FROM c2 WHERE ip IS NOT NULL GROUP BY ALL),
casn AS (SELECT hostname, measurement_day, ip_asn, count(*) AS n FROM c2 WHERE dns_success = 1 AND ip_asn <> 0 GROUP BY ALL),
cc AS (SELECT hostname, measurement_day, count(*) FILTER (WHERE dns_failure IS NOT NULL) AS ctrl_dns_failure_count,
    count(*) FILTER (WHERE dns_success = 1) AS ctrl_dns_success_count FROM c2 GROUP BY ALL),
ot AS (SELECT DISTINCT hostname, measurement_day, ip FROM o2 WHERE tls_is_certificate_valid = 1),
good AS (SELECT cc.hostname, cc.measurement_day, u.ip FROM cc JOIN (
    SELECT hostname, measurement_day, ip FROM cip WHERE tls_ok > 0 UNION SELECT * FROM ot) u
    ON cc.hostname = u.hostname AND cc.measurement_day = u.measurement_day),
win AS (SELECT o2.*,
    coalesce(list(dns_answer) FILTER (WHERE local AND dns_answer IS NOT NULL) OVER own, []) AS dns_answers,
    coalesce(list(ip_asn) FILTER (WHERE local AND ip_asn IS NOT NULL) OVER own, []) AS dns_answers_asns,
    coalesce(max(ip_is_bogon) FILTER (WHERE local) OVER own, 0) AS dns_answers_contain_bogon,
    count(*) FILTER (WHERE ip_is_v6 AND tcp_failure IS NOT NULL) OVER rep AS v6_bad, count(*) FILTER (WHERE ip_is_v6 AND tcp_success = 1) OVER rep AS v6_ok,
    count(*) FILTER (WHERE ip_is_v4 AND tcp_failure IS NOT NULL) OVER rep AS v4_bad, count(*) FILTER (WHERE ip_is_v4 AND tcp_success = 1) OVER rep AS v4_ok
  FROM o2 WINDOW own AS (PARTITION BY measurement_uid, hostname, ip_is_v6), rep AS (PARTITION BY report_id)),
lists AS (SELECT cc.*, coalesce(g.l, []) AS l_good, coalesce(b.l_bad, []) AS l_bad, coalesce(b.l_ans, []) AS l_ans, coalesce(a.l, []) AS l_asn
  FROM cc LEFT JOIN (SELECT hostname, measurement_day, list(ip) AS l FROM good GROUP BY ALL) g USING (hostname, measurement_day)
  LEFT JOIN (SELECT hostname, measurement_day, list(ip) FILTER (WHERE tls_bad > 0) AS l_bad, list(ip) FILTER (WHERE answers > 0) AS l_ans FROM cip GROUP BY ALL) b USING (hostname, measurement_day)
  LEFT JOIN (SELECT hostname, measurement_day, list(ip_asn) AS l FROM casn GROUP BY ALL) a USING (hostname, measurement_day)),
fl AS (SELECT win.*,
    coalesce(list_has_any(l_good, dns_answers), false) AS dns_tls_consistent, coalesce(list_has_any(l_bad, dns_answers), false) AS dns_tls_inconsistent,
    coalesce(list_has_any(l_ans, dns_answers), false) AS dns_answer_matches_ctrl, coalesce(list_has_any(l_asn, dns_answers_asns), false) AS dns_answer_asn_matches_ctrl,
    CAST(ctrl_dns_success_count AS DOUBLE) / nullif(ctrl_dns_success_count + ctrl_dns_failure_count, 0) AS ctrl_dns_success_rate,
    coalesce(cip.tls_ok, 0) AS ctrl_tls_success_count, coalesce(cip.tls_fail, 0) AS ctrl_tls_failing_count,
    coalesce(cip.tcp_ok, 0) AS ctrl_tcp_success_count, coalesce(cip.tcp_fail, 0) AS ctrl_tcp_failing_count,
    CAST(cip.tls_ok AS DOUBLE) / nullif(cip.tls_ok + cip.tls_fail, 0) AS ctrl_tls_success_rate,
    CAST(cip.tcp_ok AS DOUBLE) / nullif(cip.tcp_ok + cip.tcp_fail, 0) AS ctrl_tcp_success_rate,
    CAST(v6_bad AS DOUBLE) / nullif(v6_bad + v6_ok, 0) AS tcp_ipv6_failure_rate,
    dns_answer = '10.0.0.17' AND probe_cc IN ('C1', 'C2') AS dns_blocking_country_consistent
  FROM win LEFT JOIN lists ON win.hostname = lists.hostname AND win.measurement_day = lists.measurement_day
  LEFT JOIN cip ON win.hostname = cip.hostname AND win.measurement_day = cip.measurement_day AND win.ip = cip.ip)
"""

BASE = ctes("O", "C") + EVIDENCE


# The rules as the specification lists them, written by hand and not from the library's table: for each layer
# the conditions in their order, with rule id, blocked, down, ok and evidence.
RULES_SQL = {
    "dns": """
    WHEN len(dns_answers) = 0 AND dns_failure IS NULL THEN ROW('no_dns_data', 0.0, 0.0, 0.0, 0)
    WHEN dns_blocking_country_consistent THEN ROW('country_consistent_blockpage', 1.0, 0.0, 0.0, 2)
    WHEN dns_tls_consistent THEN ROW('tls_consistent_answer', 0.0, 0.0, 1.0, 2)
    WHEN dns_answers_contain_bogon = 1 AND NOT dns_answer_matches_ctrl THEN ROW('bogon_not_in_ctrl', 0.95, 0.05, 0.0, 2)
    WHEN dns_answers_contain_bogon = 1 AND dns_answer_matches_ctrl THEN ROW('bogon_in_ctrl', 0.1, 0.9, 0.0, 2)
    WHEN dns_tls_inconsistent AND NOT dns_answer_matches_ctrl THEN ROW('tls_inconsistent_not_in_ctrl', 0.9, 0.05, 0.05, 2)
    WHEN dns_answer_matches_ctrl THEN ROW('answer_matches_ctrl', 0.0, 0.0, 0.9, 2)
    WHEN dns_answer_asn_matches_ctrl THEN ROW('answer_asn_matches_ctrl', 0.2, 0.0, 0.8, 2)
    WHEN dns_engine IN ('system', 'getaddrinfo') AND dns_failure IS NOT NULL AND ctrl_dns_success_rate <= 0.5 THEN ROW('dns_system_failure_ctrl_also_failing', 0.1, 0.9, 0.0, 2)
    WHEN dns_engine IN ('system', 'getaddrinfo') AND dns_failure IS NOT NULL AND ctrl_dns_success_rate > 0.5 THEN ROW('dns_system_failure_ctrl_ok', 0.9, 0.1, 0.0, 2)
    WHEN dns_engine IN ('system', 'getaddrinfo') AND dns_failure IS NOT NULL THEN ROW('dns_system_failure_no_ctrl', 0.5, 0.5, 0.0, 2)
    WHEN dns_engine IN ('system', 'getaddrinfo') AND dns_failure IS NULL THEN ROW('dns_system_answer_unmatched', 0.75, 0.0, 0.25, 2)""",
    "tcp": """
    WHEN tcp_success <> 1 AND tcp_failure IS NULL THEN ROW('no_tcp_data', 0.0, 0.0, 0.0, 0)
    WHEN tcp_failure IS NULL AND tcp_success = 1 THEN ROW('connect_ok', 0.0, 0.0, 1.0, 2)
    WHEN tcp_failure IS NOT NULL AND ip_is_v6 AND tcp_ipv6_failure_rate > 0.5 THEN ROW('ipv6_broken_probe', 0.0, 0.0, 0.0, 1)
    WHEN tcp_failure IS NOT NULL AND ctrl_tcp_success_rate > 0.5 AND ctrl_tcp_success_count > 0 THEN ROW('failure_ctrl_ok', 0.75, 0.25, 0.0, 2)
    WHEN dns_blocked > 0 AND dns_ok <= dns_blocked + dns_down THEN ROW('dns_untrusted', 0.0, 0.0, 0.0, 1)
    WHEN tcp_failure IS NOT NULL AND ctrl_tcp_success_rate <= 0.5 AND ctrl_tcp_failing_count > 0 THEN ROW('failure_ctrl_also_failing', 0.25, 0.75, 0.0, 2)""",
    "tls": """
    WHEN tls_is_certificate_valid IS NULL AND tls_failure IS NULL THEN ROW('no_tls_data', 0.0, 0.0, 0.0, 0)
    WHEN tls_is_certificate_valid = 1 THEN ROW('certificate_valid', 0.0, 0.0, 1.0, 2)
    WHEN tls_failure LIKE 'ssl!_%' ESCAPE '!' AND ctrl_tls_success_rate > 0.5 AND ctrl_tls_success_count > 0 THEN ROW('failure_ctrl_ok_ssl', 0.9, 0.1, 0.0, 2)
    WHEN tls_failure = 'connection_reset' AND ctrl_tls_success_rate > 0.5 AND ctrl_tls_success_count > 0 THEN ROW('failure_ctrl_ok_reset', 0.8, 0.2, 0.0, 2)
    WHEN tls_failure IS NOT NULL AND ctrl_tls_success_rate > 0.5 AND ctrl_tls_success_count > 0 THEN ROW('failure_ctrl_ok_other', 0.7, 0.3, 0.0, 2)
    WHEN dns_blocked > 0 AND dns_ok <= dns_blocked + dns_down THEN ROW('dns_untrusted', 0.0, 0.0, 0.0, 1)
    WHEN tcp_blocked > 0 AND tcp_ok <= tcp_blocked + tcp_down THEN ROW('tcp_blocked', 0.0, 0.0, 0.0, 1)
    WHEN tls_failure IS NOT NULL AND ctrl_tls_success_rate <= 0.5 AND ctrl_tls_failing_count > 0 THEN ROW('failure_ctrl_also_failing', 0.2, 0.8, 0.0, 2)""",
}


def scored_sql(base: str = BASE) -> str:
    out, last = base, "fl"
    kind = "STRUCT(rule_id VARCHAR, blocked DOUBLE, down DOUBLE, ok DOUBLE, evidence INTEGER)"
    for layer, cases in RULES_SQL.items():
        values = ", ".join(f"{layer}_s.{x} AS {layer}_{x}" for x in ("rule_id", "blocked", "down", "ok", "evidence"))
        out += f", {layer}0 AS (SELECT *, CAST(CASE {cases} ELSE ROW('none', 0.0, 0.0, 0.0, 0) END AS {kind}) AS {layer}_s FROM {last}), {layer}1 AS (SELECT *, {values} FROM {layer}0)"
        last = f"{layer}1"
    return out


SCORED = scored_sql()


def fingerprints(spark):
    return spark.createDataFrame(
        [
            ("isp block", "nat", "full", "10.0.0.17", "C1, C2"),
            ("same block", "isp", "full", "10.0.0.17", "C2"),
            ("cdn answer", "fp", "full", "93.184.3.7", "C1,C3"),
            ("body", "nat", "contains", "blocked", "C4"),
        ],
        "name string, scope string, pattern_type string, pattern string, expected_countries string",
    )


def inputs(spark, d):
    return frame(spark, d, "O"), frame(spark, d, "C")


#: what the flags and rules read of an observation, and what a verdict says of it beside
_READ = ["measurement_uid", "observation_idx", "report_id", "hostname", "ip", "ip_is_bogon", "ip_asn", "dns_engine", "dns_failure", "dns_answer", "tcp_success", "tcp_failure", "tls_failure", "tls_is_certificate_valid", "measurement_start_time", "probe_cc"]
_SAID = ["input", "test_name", "probe_asn", "resolver_asn", "probe_id", "probe_analysis", "network_type"]


def evidence(spark, d, *more):
    """Observations and control observations. The former are made once for the rows, the certificates and the rates of
    reports that are read of them."""
    o, c = inputs(spark, d)
    return staged(o.select(*_READ, *more), "observations"), c


@query("ctrl_counts", BASE + """
SELECT c2.hostname, c2.measurement_day, count(*) FILTER (WHERE dns_failure IS NOT NULL) AS ctrl_dns_failure_count,
  count(*) FILTER (WHERE dns_success = 1) AS ctrl_dns_success_count,
  count(DISTINCT ip) FILTER (WHERE ip_asn IN (3, 7, 11)) AS cloud_provider_ips_count,
  count(DISTINCT ip) FILTER (WHERE ip_asn NOT IN (3, 7, 11)) AS not_cloud_provider_ips_count
FROM c2 GROUP BY ALL""")
def ctrl_counts(spark, d):
    return V.control_counts(V.with_day(frame(spark, d, "C"), GRAIN), [3, 7, 11])


_LONG = " UNION ALL ".join(
    f"SELECT hostname, measurement_day, '{n}' AS map, ip, {c} AS n FROM cip WHERE {c} > 0"
    for n, c in zip(V.MAPS, ("answers", "tls_ok", "tls_bad", "tls_fail", "tcp_ok", "tcp_fail"))
)


@query("ctrl_maps", f"{BASE} {_LONG} UNION ALL SELECT hostname, measurement_day, 'ctrl_dns_answers_asns', CAST(ip_asn AS VARCHAR), n FROM casn")
def ctrl_maps(spark, d):
    maps = V.control_maps(V.with_day(frame(spark, d, "C"), GRAIN))
    entries = lambda m: F.transform(F.map_entries(m), lambda e: F.struct(F.lit(m).alias("map"), e["key"].cast("string").alias("ip"), e["value"].alias("n")))
    return maps.select("hostname", "measurement_day", F.inline(F.concat(*[entries(m) for m in [*V.MAPS, "ctrl_dns_answers_asns"]])))


@query("rate_map", BASE + """
SELECT hostname, measurement_day, 'tls' AS layer, ip, CAST(tls_ok AS DOUBLE) / (tls_ok + tls_fail) AS rate FROM cip WHERE tls_ok + tls_fail > 0
UNION ALL SELECT hostname, measurement_day, 'tcp', ip, CAST(tcp_ok AS DOUBLE) / (tcp_ok + tcp_fail) FROM cip WHERE tcp_ok + tcp_fail > 0""")
def rate_maps(spark, d):
    o, c = inputs(spark, d)
    base = V.control_baseline(c, o, grain=GRAIN)
    part = lambda x: base.select("hostname", "measurement_day", F.lit(x).alias("layer"), F.explode(f"ctrl_{x}_success_rates").alias("ip", "rate"))
    return part("tls").unionByName(part("tcp"))


@query("union_ips", BASE + " SELECT hostname, measurement_day, ip FROM good")
def union_ips(spark, d):
    o, c = inputs(spark, d)
    return V.control_baseline(c, o, grain=GRAIN).select("hostname", "measurement_day", F.explode("union_tls_consistent_ips").alias("ip"))


@query("exp_ctrl_join", BASE + """
SELECT measurement_uid, observation_idx, o2.hostname, coalesce(ctrl_dns_success_count, 0) AS ctrl_dns_success_count,
  coalesce(ctrl_dns_failure_count, 0) AS ctrl_dns_failure_count, cc.hostname IS NOT NULL AS has_ctrl
FROM o2 LEFT JOIN cc ON o2.hostname = cc.hostname AND o2.measurement_day = cc.measurement_day""")
def exp_ctrl_join(spark, d):
    o, c = inputs(spark, d)
    base = V.control_counts(V.with_day(c, GRAIN)).withColumn("has_ctrl", F.lit(True))
    rows = V.with_day(o, GRAIN).join(base, V.KEY, "left")
    n = lambda x: F.coalesce(x, F.lit(0)).alias(x)
    return rows.select("measurement_uid", "observation_idx", "hostname", n("ctrl_dns_success_count"), n("ctrl_dns_failure_count"), F.coalesce("has_ctrl", F.lit(False)).alias("has_ctrl"))


@query("win_answers", BASE + """
SELECT measurement_uid, observation_idx, array_to_string(list_sort(dns_answers), ',') AS answers,
  array_to_string(list_sort(dns_answers_asns), ',') AS asns FROM win""")
def win_answers(spark, d):
    w = V.with_windows(frame(spark, d, "O"))
    return w.select("measurement_uid", "observation_idx", F.array_join("dns_answers", ",").alias("answers"), F.array_join(F.col("dns_answers_asns").cast("array<string>"), ",").alias("asns"))


@query("win_bogon", BASE + " SELECT measurement_uid, observation_idx, dns_answers_contain_bogon FROM win")
def win_bogon(spark, d):
    return V.with_windows(frame(spark, d, "O")).select("measurement_uid", "observation_idx", "dns_answers_contain_bogon")


@query("win_tcp_rates", BASE + """
SELECT measurement_uid, observation_idx, v6_bad AS tcp_ipv6_failure_count, v4_bad AS tcp_ipv4_failure_count,
  CAST(v6_bad AS DOUBLE) / nullif(v6_bad + v6_ok, 0) AS tcp_ipv6_failure_rate, CAST(v4_bad AS DOUBLE) / nullif(v4_bad + v4_ok, 0) AS tcp_ipv4_failure_rate FROM win""")
def win_tcp_rates(spark, d):
    names = [f"tcp_ip{v}_failure_{x}" for v in ("v6", "v4") for x in ("count", "rate")]
    return V.with_windows(frame(spark, d, "O")).select("measurement_uid", "observation_idx", *names)


_FLAGS = ["dns_tls_consistent", "dns_tls_inconsistent", "dns_answer_matches_ctrl", "dns_answer_asn_matches_ctrl", "ctrl_dns_success_rate", "ctrl_tls_success_rate", "ctrl_tcp_success_rate", "ctrl_tls_success_count", "ctrl_tls_failing_count", "ctrl_tcp_success_count", "ctrl_tcp_failing_count"]


@query("flags", f"{BASE} SELECT measurement_uid, observation_idx, {', '.join(_FLAGS)} FROM fl")
def flags(spark, d):
    o, c = evidence(spark, d)
    o, c = V.with_day(o, GRAIN), V.with_day(c, GRAIN)
    return V.with_flags(o, V.address_evidence(c, o), V.host_evidence(c)).select("measurement_uid", "observation_idx", *_FLAGS)


def _score(layer):
    names = [f"{layer}_{x}" for x in ("rule_id", "blocked", "down", "ok", "evidence")]

    @query(f"score_{layer}", f"{SCORED} SELECT measurement_uid, observation_idx, {', '.join(names)} FROM tls1")
    def run(spark, d):
        o, c = evidence(spark, d)
        return V.scored_rows(o, c, fingerprints(spark), grain=GRAIN).select("measurement_uid", "observation_idx", *names)


for _layer in ("dns", "tcp", "tls"):
    _score(_layer)

_TOPS = ", ".join(
    f"arg_max({x}_rule_id, struct_pack(a := {x}_evidence, b := {x}_blocked, c := {x}_rule_id)) AS top_{x}_rule_id" for x in ("dns", "tcp", "tls")
)


@query("top_rule", f"{SCORED} SELECT measurement_uid, {_TOPS} FROM tls1 GROUP BY measurement_uid")
def top_rule(spark, d):
    o, c = evidence(spark, d)
    scored = V.scored_rows(o, c, fingerprints(spark), grain=GRAIN)
    return scored.groupBy("measurement_uid").agg(*[V.top_rule(x).alias(f"top_{x}_rule_id") for x in ("dns", "tcp", "tls")])


_MAXES = ", ".join(f"max({x}_{s}) AS {x}_{s}" for x in ("dns", "tcp", "tls") for s in ("blocked", "down", "ok"))


def _mode(col: str, name: str) -> str:
    """Most frequent value, the smallest of equals, as a scalar subquery over the measurement's rows."""
    return f"{name}_m AS (SELECT measurement_uid, {col} AS {name} FROM (SELECT measurement_uid, {col}, row_number() OVER (PARTITION BY measurement_uid ORDER BY count(*) DESC, {col}) AS r FROM tls1 WHERE {col} IS NOT NULL GROUP BY measurement_uid, {col}) WHERE r = 1)"


_MODES = ", ".join(_mode(c, n) for c, n in (("probe_analysis", "top_probe_analysis"), ("dns_failure", "top_dns_failure"), ("tcp_failure", "top_tcp_failure"), ("tls_failure", "top_tls_failure")))
_MODE_NAMES = ("top_probe_analysis", "top_dns_failure", "top_tcp_failure", "top_tls_failure")
def rolled_sql(scored: str) -> str:
    return f"""{scored}, {_MODES}, agg AS (
  SELECT regexp_extract(input, '^https://([^/]+)', 1) AS domain, input, probe_asn, probe_cc, resolver_asn, network_type, test_name,
    measurement_start_time, measurement_uid, probe_id, {_MAXES}, {_TOPS}, 2 AS analysis_rules_version
  FROM tls1 GROUP BY input, probe_asn, probe_cc, resolver_asn, network_type, test_name, measurement_start_time, measurement_uid, probe_id)
SELECT agg.*, {', '.join(_MODE_NAMES)} FROM agg {' '.join(f'LEFT JOIN {n}_m ON agg.measurement_uid = {n}_m.measurement_uid' for n in _MODE_NAMES)}"""


_ROLLED = rolled_sql(SCORED)


@query("verdict_rollup", _ROLLED)
def verdict_rollup(spark, d):
    o, c = evidence(spark, d, *_SAID)
    return V.roll_up(V.scored_rows(o, c, fingerprints(spark), grain=GRAIN))


@query("web_verdicts", _ROLLED)
@query("web_verdicts_whole", _ROLLED)
def web_verdicts(spark, d):
    """Verdicts of all countries."""
    o, c = evidence(spark, d, *_SAID)
    return V.web_verdicts(o, c, fingerprints(spark), grain=GRAIN)


@query("verified_ctrl", BASE + """
SELECT hostname, measurement_day, ip FROM o2 WHERE tls_is_certificate_valid = 1
GROUP BY ALL HAVING count(DISTINCT CASE WHEN probe_id <> '' THEN probe_id END) >= 2""")
def verified_ctrl(spark, d):
    good = V.consistent_ips(V.with_day(frame(spark, d, "O"), GRAIN), at_least_probes=2)
    return good.select("hostname", "measurement_day", F.explode("other_tls_consistent_ips").alias("ip"))
