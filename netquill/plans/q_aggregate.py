"""Queries over aggregates, lists, windows over categories and the documented extensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from netquill.functions import scalars as S
from netquill.operators import aggregate as A
from netquill.operators import extras as X
from netquill.operators import rules as R
from netquill.plans.catalog import SQL, query
from netquill.plans.standins import ctes, frame

VB, OB, OCB, MB = ctes("V"), ctes("O"), ctes("O", "C"), ctes("M")

OUTCOME = VB + """, l AS (SELECT date_trunc('day', measurement_start_time) AS measurement_start_day, probe_cc, v.*,
    CASE WHEN resolver_asn = probe_asn THEN 'dns_isp' ELSE 'dns_other' END AS isp,
    CASE WHEN top_dns_failure IN ('dns_nxdomain_error', 'android_dns_cache_no_data') THEN 'nxdomain' ELSE coalesce(top_dns_failure, 'got_answer') END AS dl FROM v),
e AS (SELECT measurement_start_day, probe_cc, 'dns' AS layer, isp || '.blocked.' || dl AS label, dns_blocked AS value FROM l
  UNION ALL SELECT measurement_start_day, probe_cc, 'dns', isp || '.down.' || dl, dns_down FROM l
  UNION ALL SELECT measurement_start_day, probe_cc, 'tcp', 'tcp.blocked.' || coalesce(top_tcp_failure, ''), tcp_blocked FROM l
  UNION ALL SELECT measurement_start_day, probe_cc, 'tcp', 'tcp.down.' || coalesce(top_tcp_failure, ''), tcp_down FROM l
  UNION ALL SELECT measurement_start_day, probe_cc, 'tls', 'tls.blocked.' || coalesce(top_tls_failure, ''), tls_blocked FROM l
  UNION ALL SELECT measurement_start_day, probe_cc, 'tls', 'tls.down.' || coalesce(top_tls_failure, ''), tls_down FROM l),
s AS (SELECT measurement_start_day, probe_cc, layer, label, sum(value) AS value FROM e GROUP BY ALL HAVING sum(value) > 0),
h AS (SELECT *, value / sum(value) OVER (PARTITION BY measurement_start_day, probe_cc, layer) AS share FROM s),
t AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY measurement_start_day, probe_cc, layer ORDER BY round(share, 12) DESC, label) = 1),
c AS (SELECT measurement_start_day, probe_cc, count(*) AS count, sum(dns_ok) AS d, sum(tcp_ok) AS p, sum(tls_ok) AS x FROM l GROUP BY ALL),
j AS (SELECT c.*, coalesce(td.share, 0) AS sd, coalesce(tp.share, 0) AS sp, coalesce(tx.share, 0) AS sx, coalesce(td.label, '') AS ld, coalesce(tp.label, '') AS lp, coalesce(tx.label, '') AS lx
  FROM c LEFT JOIN t td ON td.layer = 'dns' AND c.measurement_start_day = td.measurement_start_day AND c.probe_cc = td.probe_cc
  LEFT JOIN t tp ON tp.layer = 'tcp' AND c.measurement_start_day = tp.measurement_start_day AND c.probe_cc = tp.probe_cc
  LEFT JOIN t tx ON tx.layer = 'tls' AND c.measurement_start_day = tx.measurement_start_day AND c.probe_cc = tx.probe_cc),
k AS (SELECT *, CASE WHEN d > 0 THEN 1 - sd ELSE 0 END AS okd, CASE WHEN p > 0 THEN 1 - sp ELSE 0 END AS okp, CASE WHEN x > 0 THEN 1 - sx ELSE 0 END AS okx FROM j),
m2 AS (SELECT *, CASE WHEN x = 0 AND sx = 0 THEN least(okd, okp) ELSE least(okd, okp, okx) END AS ok_value FROM k),
f AS (SELECT *, greatest(sd, sp, sx, ok_value) AS outcome_value, CASE greatest(sd, sp, sx, ok_value) WHEN sd THEN ld WHEN sp THEN lp WHEN sx THEN lx ELSE 'ok' END AS outcome_label FROM m2)
SELECT measurement_start_day, probe_cc, count, CAST(ok_value AS DOUBLE) AS ok_value, outcome_label, CAST(outcome_value AS DOUBLE) AS outcome_value"""
_COUNTS = """, CASE WHEN outcome_label = 'ok' THEN count ELSE 0 END AS ok_count,
  CASE WHEN outcome_label LIKE '%.blocked.%' AND outcome_value < 0.9 THEN count ELSE 0 END AS anomaly_count,
  CASE WHEN outcome_label LIKE '%.blocked.%' AND outcome_value >= 0.9 THEN count ELSE 0 END AS confirmed_count,
  CASE WHEN outcome_label LIKE '%.down.%' THEN count ELSE 0 END AS failure_count FROM f"""


def outcomes(spark, d):
    return A.outcome_aggregation(frame(spark, d, "V"), "measurement_start_day", "probe_cc")


@query("outcome_agg", OUTCOME + " FROM f")
def outcome_agg(spark, d):
    return outcomes(spark, d).select("measurement_start_day", "probe_cc", "count", "ok_value", "outcome_label", "outcome_value")


@query("outcome_counts", OUTCOME + _COUNTS)
def outcome_counts(spark, d):
    return outcomes(spark, d)


_FAIL = """CASE WHEN dns_failure IS NOT NULL THEN 'dns_' || dns_failure WHEN tcp_failure IS NOT NULL THEN 'tcp_' || tcp_failure
  WHEN tls_handshake_last_operation = 'write_1' THEN 'tls_' || tls_failure || '_after_CH' WHEN tls_failure IS NULL AND tls_server_name IS NOT NULL THEN 'none' ELSE 'tls_' || tls_failure END"""
_FAILURES = f"""{OB} SELECT date_trunc('month', measurement_start_time) AS timestamp, {_FAIL} AS failure, probe_cc, count(*) AS observation_count FROM o
WHERE dns_failure IS NOT NULL OR tcp_failure IS NOT NULL OR tls_failure IS NOT NULL OR tls_server_name IS NOT NULL GROUP BY ALL"""


@query("failure_agg", _FAILURES)
@query("failure_agg_whole", _FAILURES)
def failure_agg(spark, d):
    return A.failure_aggregation(frame(spark, d, "O"), ("timestamp", "failure", "probe_cc"), "month")


@query("failure_class", OB + """, f AS (SELECT *, CASE WHEN dns_failure IS NOT NULL THEN 'dns' WHEN tcp_failure IS NOT NULL THEN 'tcp' WHEN tls_failure IS NOT NULL THEN 'tls' WHEN http_failure IS NOT NULL THEN 'https' ELSE 'ok' END AS c,
  coalesce(dns_failure, tcp_failure, tls_failure, http_failure) AS t FROM o)
SELECT probe_cc, probe_asn, hostname, resolver_asn, date_trunc('day', measurement_start_time) AS ts,
  CASE WHEN c = 'ok' THEN 'ok' WHEN starts_with(t, 'unknown_failure') THEN c || '.unknown_failure' ELSE c || '.' || t END AS failure_str, count(*) AS cnt FROM f GROUP BY ALL""")
def failure_class(spark, d):
    return A.failure_classes(frame(spark, d, "O"), ["probe_cc", "probe_asn", "hostname", "resolver_asn"])


@query("tls_consistency", OCB + """, a AS (SELECT ip, tls_server_name, ip_cc, ip_asn, ip_as_org_name, count(*) AS n, count(DISTINCT probe_cc || '/' || probe_asn) AS vp FROM o
  WHERE tls_failure IS NULL AND tls_server_name IS NOT NULL AND ip IS NOT NULL GROUP BY ALL),
b AS (SELECT ip, tls_server_name, count(*) AS n FROM c WHERE tls_success = 1 AND tls_server_name IS NOT NULL AND ip IS NOT NULL GROUP BY ALL)
SELECT coalesce(a.ip, b.ip) AS ip, coalesce(a.tls_server_name, b.tls_server_name) AS tls_server_name, CAST(sum(coalesce(a.n, 0) + coalesce(b.n, 0)) AS BIGINT) AS msmt_count, CAST(sum(coalesce(vp, 0)) AS BIGINT) AS vp_count,
  bool_or(b.n IS NOT NULL) AS in_ctrl, min(ip_cc) AS ip_cc, min(ip_asn) AS ip_asn, min(ip_as_org_name) AS ip_as_org_name
FROM a FULL JOIN b ON a.ip = b.ip AND a.tls_server_name = b.tls_server_name GROUP BY 1, 2""")
def tls_consistency(spark, d):
    return A.tls_consistency(frame(spark, d, "O"), frame(spark, d, "C"))


@query("all_outcomes", OUTCOME[: OUTCOME.index("t AS (SELECT * FROM h")].rstrip().rstrip(",") + """
SELECT measurement_start_day, probe_cc, layer, label, CAST(share AS DOUBLE) AS share, CAST(row_number() OVER (PARTITION BY measurement_start_day, probe_cc
  ORDER BY CASE layer WHEN 'dns' THEN 1 WHEN 'tcp' THEN 2 ELSE 3 END, round(share, 12) DESC, label) AS INTEGER) AS place FROM h""")
def all_outcomes(spark, d):
    v = frame(spark, d, "V").withColumn("measurement_start_day", F.date_trunc("day", "measurement_start_time"))
    return A.all_outcomes(v, ["measurement_start_day", "probe_cc"])


@query("rule_dist", f"{VB} " + " UNION ALL ".join(f"SELECT '{x}' AS layer, top_{x}_rule_id AS rule_id, count(*) AS n, count(*) FILTER (WHERE {x}_blocked > 0.5) AS n_blocked FROM v GROUP BY ALL" for x in ("dns", "tcp", "tls")))
def rule_dist(spark, d):
    v = frame(spark, d, "V")
    return A.rule_distribution(v, "dns").unionByName(A.rule_distribution(v, "tcp")).unionByName(A.rule_distribution(v, "tls"))


# blocked, down and ok of the DNS rules as the specification lists them, by hand
_DNS_WEIGHTS = """('no_dns_data', 0.0, 0.0, 0.0), ('country_consistent_blockpage', 1.0, 0.0, 0.0), ('tls_consistent_answer', 0.0, 0.0, 1.0), ('bogon_not_in_ctrl', 0.95, 0.05, 0.0),
  ('bogon_in_ctrl', 0.1, 0.9, 0.0), ('tls_inconsistent_not_in_ctrl', 0.9, 0.05, 0.05), ('answer_matches_ctrl', 0.0, 0.0, 0.9), ('answer_asn_matches_ctrl', 0.2, 0.0, 0.8),
  ('dns_system_failure_ctrl_also_failing', 0.1, 0.9, 0.0), ('dns_system_failure_ctrl_ok', 0.9, 0.1, 0.0), ('dns_system_failure_no_ctrl', 0.5, 0.5, 0.0),
  ('dns_system_answer_unmatched', 0.75, 0.0, 0.25), ('none', 0.0, 0.0, 0.0)"""


@query("reweight", f"""{VB}, r AS (SELECT * FROM (VALUES {_DNS_WEIGHTS}) t(rule_id, blocked, down, ok))
SELECT measurement_uid, top_dns_rule_id, CAST(blocked AS DOUBLE) AS dns_blocked_new, CAST(down AS DOUBLE) AS dns_down_new, CAST(ok AS DOUBLE) AS dns_ok_new FROM v LEFT JOIN r ON top_dns_rule_id = rule_id""")
def reweight(spark, d):
    out = R.reweight(frame(spark, d, "V"), R.rule_table(spark), "dns")
    return out.select("measurement_uid", "top_dns_rule_id", "dns_blocked_new", "dns_down_new", "dns_ok_new")


@query("vp_count", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers, count(DISTINCT (o_custkey, o_orderstatus)) AS n_pairs FROM orders GROUP BY ALL")
def vp_count(spark, d):
    return frame(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("n_customers"), F.count_distinct("o_custkey", "o_orderstatus").alias("n_pairs")
    )


@query("vp_sketch")
def vp_sketch(spark, d):
    """The same from mergeable sketches: one a month, united over all months."""
    monthly = frame(spark, d, "orders").groupBy("o_orderpriority", F.date_trunc("month", "o_orderdate").alias("m")).agg(F.hll_sketch_agg("o_custkey").alias("s"))
    return monthly.groupBy("o_orderpriority").agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("n_customers"))


@query("share_of_total", f"""{OB}, k AS (SELECT date_trunc('month', measurement_start_time) AS day, ip, {_FAIL} AS failure, count(*) AS n FROM o GROUP BY ALL)
SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY day, ip) AS share FROM k""")
def share_of_total(spark, d):
    rows = frame(spark, d, "O").select(F.date_trunc("month", "measurement_start_time").alias("day"), "ip", A.observed_failure().alias("failure"))
    return A.share_of_total(rows, ["day", "ip", "failure"], ["day", "ip"])


@query("topk_other", OB + """, k AS (SELECT probe_cc AS layer, hostname AS label, count(*) AS n FROM o GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY layer ORDER BY n DESC, label) AS r, count(*) OVER (PARTITION BY layer) AS c FROM k)
SELECT layer, CASE WHEN r <= 2 OR c <= 3 THEN label ELSE layer || '_other' END AS category, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY ALL""")
def topk_other(spark, d):
    return A.topk_other(frame(spark, d, "O").select(F.col("probe_cc").alias("layer"), F.col("hostname").alias("label")), "layer", "label")


@query("list_obs", """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-12-31'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 50""")
def list_obs(spark, d):
    """The second page and a half of a list; the limit is the feature."""
    out = A.list_observations(frame(spark, d, "orders"), {"o_orderstatus": "F", "o_orderpriority": None}, datetime(1996, 1, 1), datetime(2000, 12, 31), "o_totalprice", True, 50, 100, "o_orderkey", "o_orderdate")
    return out.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query("list_verdicts", f"""{VB} SELECT measurement_uid, measurement_start_time, probe_cc, probe_asn, domain, top_dns_failure AS dns_failure, top_tcp_failure AS tcp_failure, top_tls_failure AS tls_failure,
  dns_blocked + tcp_blocked + tls_blocked > 0.5 AS anomaly, dns_blocked + tcp_blocked + tls_blocked = 1.0 AS confirmed FROM v ORDER BY measurement_start_time, measurement_uid LIMIT 200 OFFSET 100""")
def list_verdicts(spark, d):
    """A page of verdicts; the limit is the feature."""
    return A.list_verdicts(frame(spark, d, "V"), 100, 200)


@query("time_grain", """SELECT 'hour' AS grain, date_trunc('hour', ts) AS start, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'day', date_trunc('day', ts), count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'week', date_trunc('week', ts + INTERVAL 1 DAY) - INTERVAL 1 DAY, count(*) FROM events GROUP BY ALL UNION ALL SELECT 'month', date_trunc('month', ts), count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'auto', date_trunc('day', ts), count(*) FROM events GROUP BY ALL""")
def time_grain(spark, d):
    out = None
    for g in ("hour", "day", "week", "month", "auto"):
        part = frame(spark, d, "events").groupBy(S.time_grain(F.col("ts").cast("timestamp"), g).alias("start")).agg(F.count("*").alias("n")).select(F.lit(g).alias("grain"), "start", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("set_ops", """SELECT 'both' AS op, k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL
SELECT 'only_customer', k FROM (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) UNION ALL
SELECT 'union', k FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)""")
def set_ops(spark, d):
    """Union, intersection and difference of two key sets."""
    c = frame(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("bal"))
    s = frame(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_acctbal").alias("bal"))
    tag = lambda name, df: df.select(F.lit(name).alias("op"), "k")
    both = c.select("k").intersect(s.select("k"))
    only = c.filter("bal > 9000").select("k").distinct().join(s.filter("bal > 5000"), "k", "left_anti")
    return tag("both", both).unionByName(tag("only_customer", only)).unionByName(tag("union", c.select("k").unionByName(s.select("k")).distinct()))


CELL = VB + """, long AS (""" + " UNION ALL ".join(f"SELECT probe_cc, date_trunc('hour', measurement_start_time) AS ts, '{x}' AS layer, top_{x}_rule_id AS rule_id FROM v" for x in ("dns", "tcp", "tls")) + """),
st AS (SELECT probe_cc, ts, layer, rule_id, count(*) AS n FROM long GROUP BY ALL)"""


@query("cell_state", CELL + """, cell AS (SELECT probe_cc, date_trunc('hour', measurement_start_time) AS ts, count(DISTINCT measurement_uid) AS n_measurements, count(DISTINCT nullif(probe_id, '')) AS n_probes FROM v GROUP BY ALL)
SELECT st.*, n_measurements, n_probes FROM st JOIN cell USING (probe_cc, ts)""")
def cell_state(spark, d):
    return X.cell_state(frame(spark, d, "V"), ["probe_cc"])


# the outcome of each rule as the specification lists it, by hand and not from the library's table
_RULE_ROWS = """
  ('dns', 'no_dns_data', 'unknown'), ('dns', 'country_consistent_blockpage', 'blocked'), ('dns', 'tls_consistent_answer', 'ok'), ('dns', 'bogon_not_in_ctrl', 'blocked'),
  ('dns', 'bogon_in_ctrl', 'down'), ('dns', 'tls_inconsistent_not_in_ctrl', 'blocked'), ('dns', 'answer_matches_ctrl', 'ok'), ('dns', 'answer_asn_matches_ctrl', 'ok'),
  ('dns', 'dns_system_failure_ctrl_also_failing', 'down'), ('dns', 'dns_system_failure_ctrl_ok', 'blocked'), ('dns', 'dns_system_failure_no_ctrl', 'unknown'),
  ('dns', 'dns_system_answer_unmatched', 'blocked'), ('dns', 'none', 'unknown'),
  ('tcp', 'no_tcp_data', 'unknown'), ('tcp', 'connect_ok', 'ok'), ('tcp', 'ipv6_broken_probe', 'unknown'), ('tcp', 'failure_ctrl_ok', 'blocked'), ('tcp', 'dns_untrusted', 'unknown'),
  ('tcp', 'failure_ctrl_also_failing', 'down'), ('tcp', 'none', 'unknown'),
  ('tls', 'no_tls_data', 'unknown'), ('tls', 'certificate_valid', 'ok'), ('tls', 'failure_ctrl_ok_ssl', 'blocked'), ('tls', 'failure_ctrl_ok_reset', 'blocked'),
  ('tls', 'failure_ctrl_ok_other', 'blocked'), ('tls', 'dns_untrusted', 'unknown'), ('tls', 'tcp_blocked', 'unknown'), ('tls', 'failure_ctrl_also_failing', 'down'), ('tls', 'none', 'unknown')"""


@query("cell_verdict", f"""{CELL}, r AS (SELECT * FROM (VALUES {_RULE_ROWS}) t(layer, rule_id, outcome)),
x AS (SELECT st.*, coalesce(outcome, 'unknown') AS outcome FROM st LEFT JOIN r USING (layer, rule_id)),
g AS (SELECT probe_cc, ts, layer, outcome, sum(n) AS no, arg_max(rule_id, struct_pack(a := n, b := rule_id)) AS rule_id FROM x GROUP BY ALL)
SELECT probe_cc, ts, layer, arg_max(outcome, struct_pack(a := no, b := outcome)) AS outcome, arg_max(rule_id, struct_pack(a := no, b := outcome)) AS rule_id, CAST(max(no) AS DOUBLE) / sum(no) AS share FROM g GROUP BY ALL""")
def cell_verdict(spark, d):
    return X.cell_verdict(X.cell_state(frame(spark, d, "V"), ["probe_cc"]), R.rule_table(spark), ["probe_cc"]).drop("total")


@query("presentation_states", SQL["cell_verdict"].replace("SELECT probe_cc, ts, layer, arg_max(outcome,", "SELECT probe_cc, ts, layer, CASE WHEN total < 2 THEN 'insufficient' WHEN outcome = 'blocked' AND rule_id IN ('country_consistent_blockpage', 'bogon_not_in_ctrl') THEN 'blocked' WHEN outcome = 'blocked' THEN 'likely_blocked' WHEN rule_id = 'dns_system_failure_no_ctrl' THEN 'impaired' WHEN outcome IN ('down', 'ok') THEN outcome ELSE 'insufficient' END AS state FROM (SELECT probe_cc, ts, layer, sum(no) AS total, arg_max(outcome,") + ")")
def presentation_states(spark, d):
    """What to show of each hour and layer, by the kind of evidence."""
    cells = X.cell_verdict(X.cell_state(frame(spark, d, "V"), ["probe_cc"]), R.rule_table(spark), ["probe_cc"])
    return X.presentation(cells, least=2).select("probe_cc", "ts", "layer", "state")


@query("profile", f"""{VB} SELECT probe_cc, domain, max(dns_blocked) AS max_score, count(*) FILTER (WHERE dns_blocked > 0.5) AS n_over, count(*) AS n,
  arg_max(measurement_uid, struct_pack(a := dns_blocked, b := measurement_uid)) AS witness FROM v GROUP BY ALL""")
def profile(spark, d):
    return X.profile(frame(spark, d, "V"), ["probe_cc", "domain"], "dns_blocked", "measurement_uid", 0.5)


@query("confound", f"""{MB} SELECT domain, count(DISTINCT software_version) AS n_inner, count(DISTINCT probe_asn) AS n_outer, count(*) AS n,
  count(DISTINCT software_version) = 1 AND count(DISTINCT probe_asn) > 1 AS software_suspect FROM m GROUP BY ALL""")
def confound(spark, d):
    return X.confound(frame(spark, d, "M"), "domain", "software_version", "probe_asn")


@query("strata_sample", f"""{MB}, r AS (SELECT probe_cc, platform, event_id, row_number() OVER (PARTITION BY probe_cc, platform ORDER BY md5('design-1:' || CAST(event_id AS VARCHAR)), event_id) AS r, count(*) OVER (PARTITION BY probe_cc, platform) AS stratum_size FROM m)
SELECT probe_cc, platform, event_id, stratum_size, CAST(stratum_size AS DOUBLE) / least(stratum_size, 20) AS weight FROM r WHERE r <= 20""")
def strata_sample(spark, d):
    """A stratified draw; the fixed number a stratum is the feature."""
    rows = frame(spark, d, "M").select("probe_cc", "platform", "event_id")
    return X.strata_sample(rows, ["probe_cc", "platform"], "event_id", 20, "design-1")


@query("arrival_lag", f"""{MB}, x AS (SELECT probe_cc, date_diff('second', date_trunc('second', measurement_start_time), date_trunc('second', measurement_start_time) + (event_id % 7 + 1) * INTERVAL 30 MINUTE) AS lag FROM m)
SELECT probe_cc, quantile_cont(lag, 0.5) AS p50, quantile_cont(lag, 0.9) AS p90, count(*) AS n FROM x GROUP BY ALL""")
def arrival_lag(spark, d):
    m = frame(spark, d, "M").withColumn("bucket", F.expr("measurement_start_time + (event_id % 7 + 1) * INTERVAL '30' MINUTE"))
    return X.arrival_lag(m, ["probe_cc"], "measurement_start_time", "bucket")
