"""Raw measurements to verdicts, in one chain: lines of JSON, flattened and paired in the row, with control
observations, networks as of the day, and the rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquill.operators import observations as B
from netquill.operators import verdicts as V
from netquill.plans.catalog import query
from netquill.plans.q_verdicts import EVIDENCE, GRAIN, fingerprints, rolled_sql, scored_sql
from netquill.plans.standins import frame
from netquill.sources.io import read_jsonl, scratch_path


def _address(v: str) -> str:
    """Address of a line by its part and supplier, in SQL of either engine: bogons, IPv6 and IPv4."""
    return f"""CASE WHEN {v}s % 17 = 0 THEN concat('10.0.0.', {v}s % 60) WHEN {v}s % 10 = 0 THEN concat('2a02:0:', {v}p % 100, '::7')
      ELSE concat('93.184.', {v}p % 200, '.7') END"""


def lines_of_json(spark: SparkSession, d: str) -> DataFrame:
    """(value): a measurement an order as a line of JSON. Each line of the order is a connection of its own
    transaction; those with number 4 failed in DNS, those with 5 had no query, those with 6 a second answer."""
    flat = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))
    lines = frame(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(flat)).alias("lines"))
    rows = lines.join(frame(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(frame(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    a = _address("x.")
    at = "CASE WHEN contains(a, ':') THEN concat('[', a, ']:443') ELSE concat(a, ':443') END"
    rows = rows.withColumns({
        "l": F.expr(f"transform(lines, (x, i) -> named_struct('n', x.n, 'p', x.p, 's', x.s, 't', i + 1L, 'a', {a}))"),
        "host": F.expr("concat('h', l_orderkey % 40, '.example')"),
    }).withColumn("l", F.expr(f"transform(l, x -> named_struct('n', x.n, 'p', x.p, 's', x.s, 't', x.t, 'a', x.a, 'at', {at.replace('a,', 'x.a,').replace('(a', '(x.a')}))"))
    ends = lambda keep: f"array_distinct(transform(filter(l, x -> {keep}), x -> named_struct('a', x.a, 'at', x.at)))"
    keys = f"""named_struct(
      'blocking', CASE l_orderkey % 3 WHEN 0 THEN 'dns' WHEN 1 THEN 'tcp_ip' END,
      'control_failure', CASE WHEN l_orderkey % 13 = 0 THEN 'generic_timeout_error' END,
      'queries', transform(filter(l, x -> x.n <> 5), x -> named_struct('hostname', concat('h', x.p % 40, '.example'), 'query_type', 'A', 'engine', CASE x.p % 3 WHEN 0 THEN 'system' WHEN 1 THEN 'getaddrinfo' ELSE 'udp' END,
        'failure', CASE WHEN x.n = 4 THEN 'dns_nxdomain_error' END, 'transaction_id', x.t, 't', 0.5D,
        'answers', CASE WHEN x.n = 4 THEN NULL WHEN x.n = 6 THEN array(named_struct('ipv4', CASE WHEN NOT contains(x.a, ':') THEN x.a END, 'ipv6', CASE WHEN contains(x.a, ':') THEN x.a END), named_struct('ipv4', concat('8.8.', x.p % 200, '.8'), 'ipv6', CAST(NULL AS STRING)))
          ELSE array(named_struct('ipv4', CASE WHEN NOT contains(x.a, ':') THEN x.a END, 'ipv6', CASE WHEN contains(x.a, ':') THEN x.a END)) END)),
      'tcp_connect', transform(l, x -> named_struct('ip', x.a, 'port', 443, 'status', named_struct('success', x.s % 3 > 0, 'failure', CASE WHEN x.s % 3 = 0 THEN 'unknown_failure: read: connection refused' END), 'transaction_id', x.t, 't', 1D)),
      'tls_handshakes', transform(l, x -> named_struct('address', x.at, 'server_name', CASE WHEN x.n <> 5 THEN concat('h', x.p % 40, '.example') END, 'failure', CASE x.p % 5 WHEN 0 THEN 'ssl_invalid_hostname' WHEN 1 THEN 'connection_reset' END, 'no_tls_verify', x.p % 7 = 0, 'transaction_id', x.t, 't', 2D)),
      'control', named_struct('dns', named_struct('failure', CASE WHEN l_orderkey % 11 = 0 THEN 'dns_nxdomain_error' END, 'addrs', array_distinct(transform(filter(l, x -> x.s % 3 = 0), x -> x.a))),
        'tcp_connect', map_from_entries(transform({ends('x.s % 3 = 1')}, e -> struct(e.at, named_struct('failure', CASE WHEN length(e.a) % 3 = 0 THEN 'connection_refused' END)))),
        'tls_handshake', map_from_entries(transform({ends('x.s % 3 > 0')}, e -> struct(e.at, named_struct('failure', CASE WHEN length(e.a) % 2 = 0 THEN 'ssl_invalid_hostname' END, 'server_name', host)))),
        'http_request', named_struct('body_length', l_orderkey % 1000)))"""
    text = lambda e, n: F.expr(e).alias(n)
    return rows.select(F.to_json(F.struct(
        text("CAST(l_orderkey AS STRING)", "measurement_uid"), text("concat('r', o_custkey % 50)", "report_id"), text("concat('https://', host, '/p?', l_orderkey % 3)", "input"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("measurement_start_time"), F.lit("web_connectivity").alias("test_name"),
        text("concat('C', c_nationkey % 6)", "probe_cc"), text("concat('AS', 100 + o_custkey % 9)", "probe_asn"), text("CASE WHEN o_custkey % 4 > 0 THEN concat('p', o_custkey % 200) END", "probe_id"),
        text("CASE o_custkey % 3 WHEN 0 THEN '[scrubbed]' WHEN 1 THEN '' ELSE concat('93.184.', o_custkey % 200, '.9') END", "resolver_ip"), F.lit("AS55").alias("resolver_asn"), F.lit("told").alias("resolver_network_name"),
        text("CASE WHEN o_custkey % 3 = 0 THEN map('network_type', 'wifi') END", "annotations"), text(keys, "test_keys"),
    )).alias("value"))


def raw_measurements(spark: SparkSession, d: str) -> DataFrame:
    """The lines as files, read as measurements are."""
    path = scratch_path(spark, "lines")
    lines_of_json(spark, d).write.option("compression", "gzip").text(path)
    return read_jsonl(spark, path)


def networks(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dated ranges of IPv4, with longer ones inside, prefixes of IPv6 and names of networks, by nation."""
    k = F.col("n_nationkey").cast("long")
    nations = frame(spark, d, "nation").filter("n_nationkey < 25")
    dated = nations.select(k.alias("k"), F.explode(F.array(F.lit("1994-01-01"), F.lit("1996-01-01"))).alias("on")).withColumn("more", F.when(F.col("on") < "1995", 0).otherwise(1000))
    base = (93 << 24) + (184 << 16)
    each = lambda first, size, length, asn: (
        F.col("on").cast("timestamp").alias("snapshot"), F.expr(f"{base} + {first} * 256").alias("first"), F.expr(f"{base} + {first} * 256 + {size} * 256 - 1").alias("last"),
        F.lit(length).alias("prefix_len"), F.expr(f"more + {asn}").alias("asn"), F.expr("concat('org', k)").alias("org"), F.expr("concat('A', k)").alias("as_cc"), F.expr("concat('N', k)").alias("cc"),
    )
    ranges = dated.select(*each("k * 8", 8, 21, "500 + k")).unionByName(dated.filter("k % 2 = 0").select(*each("(k * 8 + 3)", 1, 24, "600 + k")))
    bits = lambda text, n: F.lit(f"{int(text, 16):0128b}"[:n])
    six = dated.filter("k < 1").select(F.col("on").cast("timestamp").alias("snapshot"), F.explode(F.array(
        F.struct(bits("2a02" + "0" * 28, 32).alias("prefix"), F.lit(900).alias("asn")), F.struct(bits("2a0200000005" + "0" * 20, 48).alias("prefix"), F.lit(905).alias("asn")),
    )).alias("x"), "more")
    prefixes = six.select("snapshot", "x.prefix", (F.col("x.asn") + F.col("more")).cast("long").alias("asn"), F.lit("six").alias("org"), F.lit("V").alias("as_cc"), F.lit("V6").alias("cc"))
    named = nations.filter("n_nationkey < 8").select((100 + k).alias("asn"), F.explode(F.array(F.lit("1993-01-01"), F.lit("1996-01-01"))).alias("on"))
    names = named.select("asn", F.expr("concat('org', asn, substring(on, 4, 1))").alias("org_name"), F.lit("X").alias("cc"), F.to_date("on").alias("changed"), F.expr("concat('n', asn)").alias("aut_name"))
    return ranges, prefixes, names


_MORE = "CASE WHEN measurement_start_time >= TIMESTAMP '1996-01-01' THEN 1000 ELSE 0 END"


def _asn(ip: str) -> str:
    """Network of an address of the stand-in, in the checking SQL."""
    x = f"CAST(split_part({ip}, '.', 3) AS BIGINT)"
    return f"""CASE WHEN {ip} LIKE '10.%' THEN 64666 WHEN {ip} LIKE '2a02:0:5::%' THEN {_MORE} + 905 WHEN {ip} LIKE '2a02:%' THEN {_MORE} + 900
      WHEN {ip} LIKE '93.%' AND {x} % 8 = 3 AND {x} // 8 % 2 = 0 THEN {_MORE} + 600 + {x} // 8 WHEN {ip} LIKE '93.%' THEN {_MORE} + 500 + {x} // 8 WHEN {ip} IS NOT NULL THEN 0 END"""


RAW = f"""
WITH l AS (SELECT l_orderkey AS k, CAST(l_orderkey AS VARCHAR) AS measurement_uid, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, o_custkey AS u, c_nationkey AS c,
    o_orderdate AS measurement_start_time, 'h' || (l_orderkey % 40) || '.example' AS host, {_address('l_').replace('l_s ', 'l_suppkey ').replace('l_p ', 'l_partkey ')} AS a,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS t
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
w AS (SELECT *, max(s % 3 = 0) OVER same AS resolved, max(s % 3 = 1) OVER same AS in_tcp, max(s % 3 > 0) OVER same AS in_tls, row_number() OVER same AS copy FROM l WINDOW same AS (PARTITION BY k, a ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
both_answers AS (SELECT *, 0 AS extra FROM w UNION ALL SELECT *, 1 FROM w WHERE n = 6),
rows AS (SELECT *, CASE WHEN extra = 1 THEN '8.8.' || (p % 200) || '.8' ELSE a END AS ip FROM both_answers),
o AS (SELECT measurement_uid, CAST(row_number() OVER (PARTITION BY k ORDER BY n = 5, t, extra) AS INTEGER) AS observation_idx, 'r' || (u % 50) AS report_id,
    CASE WHEN n <> 5 THEN 'h' || (p % 40) || '.example' WHEN resolved THEN host END AS hostname, 'https://' || host || '/p?' || (k % 3) AS input, ip,
    CASE WHEN ip LIKE '10.%' THEN 1 ELSE 0 END AS ip_is_bogon, {_asn('ip')} AS ip_asn,
    CASE WHEN n <> 5 THEN CASE p % 3 WHEN 0 THEN 'system' WHEN 1 THEN 'getaddrinfo' ELSE 'udp' END END AS dns_engine, CASE WHEN n = 4 THEN 'dns_nxdomain_error' END AS dns_failure,
    CASE WHEN n NOT IN (4, 5) THEN ip END AS dns_answer, CASE WHEN extra = 0 THEN CASE WHEN s % 3 > 0 THEN 1 ELSE 0 END END AS tcp_success, CASE WHEN extra = 0 AND s % 3 = 0 THEN 'connection_refused' END AS tcp_failure,
    CASE WHEN extra = 0 THEN CASE p % 5 WHEN 0 THEN 'ssl_invalid_hostname' WHEN 1 THEN 'connection_reset' END END AS tls_failure,
    CASE WHEN extra = 1 OR p % 7 = 0 THEN NULL WHEN p % 5 = 0 THEN 0 WHEN p % 5 > 1 THEN 1 END AS tls_is_certificate_valid,
    CASE WHEN extra = 0 THEN CASE WHEN n <> 5 THEN 'h' || (p % 40) || '.example' ELSE '' END END AS tls_server_name,
    'web_connectivity' AS test_name, measurement_start_time, 'C' || (c % 6) AS probe_cc, CAST(100 + u % 9 AS BIGINT) AS probe_asn,
    CASE u % 3 WHEN 0 THEN 55 WHEN 1 THEN 0 ELSE {_asn("('93.184.' || (u % 200) || '.9')")} END AS resolver_asn, CASE WHEN u % 4 > 0 THEN 'p' || (u % 200) ELSE '' END AS probe_id,
    CASE k % 3 WHEN 0 THEN 'dns' WHEN 1 THEN 'tcp_ip' END AS probe_analysis, CASE WHEN u % 3 = 0 THEN 'wifi' ELSE 'unknown' END AS network_type, u FROM rows),
c0 AS (SELECT DISTINCT measurement_uid, k, host AS hostname, measurement_start_time, NULL AS ip, CASE WHEN k % 11 = 0 THEN 'dns_nxdomain_error' END AS dns_failure, CAST(NULL AS INTEGER) AS dns_success, CAST(NULL AS INTEGER) AS tcp_success, NULL AS tcp_failure, CAST(NULL AS INTEGER) AS tls_success, NULL AS tls_failure,
    q AS http FROM l, (VALUES (0), (1)) t(q) WHERE k % 13 <> 0 AND (q = 1 OR k % 11 = 0)
  UNION ALL SELECT measurement_uid, k, host, measurement_start_time, a, NULL, CASE WHEN resolved THEN 1 END, CASE WHEN in_tcp THEN CASE WHEN length(a) % 3 = 0 THEN 0 ELSE 1 END END, CASE WHEN in_tcp AND length(a) % 3 = 0 THEN 'connection_refused' END,
    CASE WHEN in_tls THEN CASE WHEN length(a) % 2 = 0 THEN 0 ELSE 1 END END, CASE WHEN in_tls AND length(a) % 2 = 0 THEN 'ssl_invalid_hostname' END, 0 FROM w WHERE copy = 1 AND k % 13 <> 0),
c AS (SELECT * EXCLUDE (dns_failure, http), CASE WHEN http = 0 THEN dns_failure END AS dns_failure, {_asn('ip')} AS ip_asn FROM c0)"""

_OBS = ["measurement_uid", "observation_idx", "report_id", "hostname", "ip", "ip_is_bogon", "ip_asn", "dns_engine", "dns_failure", "dns_answer", "tcp_success", "tcp_failure", "tls_failure", "tls_is_certificate_valid", "tls_server_name", "probe_asn", "resolver_asn", "probe_analysis", "network_type"]


@query("raw_observations", f"""{RAW} SELECT {', '.join(_OBS)}, CASE WHEN ip LIKE '10.%' OR ip LIKE '8.8.%' THEN 'ZZ' WHEN ip LIKE '2a02:%' THEN 'V6' WHEN ip IS NOT NULL THEN 'N' || (CAST(split_part(ip, '.', 3) AS BIGINT) // 8) END AS ip_cc,
  CASE WHEN probe_asn < 108 THEN 'org' || probe_asn || CASE WHEN measurement_start_time >= TIMESTAMP '1996-01-01' THEN '6' ELSE '3' END ELSE '' END AS probe_as_org_name FROM o""")
def raw_observations(spark, d):
    """Every connection of every line of JSON, with networks as of the day."""
    own = B.raw_observation_rows(raw_measurements(spark, d), *networks(spark, d), columns=tuple(_OBS))
    return own.select(*_OBS, "ip_cc", "probe_as_org_name")


@query("raw_control", f"{RAW} SELECT measurement_uid, hostname, ip, ip_asn, dns_failure, dns_success, tcp_success, tcp_failure, tls_success, tls_failure FROM c")
def raw_control(spark, d):
    """What the control saw, with networks as of the day."""
    control = B.raw_control_rows(raw_measurements(spark, d), *networks(spark, d)[:2])
    return control.select("measurement_uid", "hostname", "ip", "ip_asn", "dns_failure", "dns_success", "tcp_success", "tcp_failure", "tls_success", "tls_failure")


@query("raw_verdicts", rolled_sql(scored_sql(RAW + EVIDENCE)))
def raw_verdicts(spark, d):
    """From lines of JSON to a verdict a measurement."""
    own, control = B.raw_verdict_inputs(raw_measurements(spark, d), *networks(spark, d), columns=V.OBSERVED)
    return V.web_verdicts(own, control, fingerprints(spark), grain=GRAIN)
