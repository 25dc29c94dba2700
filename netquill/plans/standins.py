"""Measurement-shaped tables derived from the driver's tables.

Each text is valid in Spark and in DuckDB, so a query and the SQL that checks it read the same rows.
The test tables spread over years, so the month plays the part of the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: measurements: one row an event
M = """
SELECT event_id, user_id, event_type, value, props, ts AS measurement_start_time,
  ts + (event_id % 7 - 3) * INTERVAL '30' MINUTE AS upload_time,
  CONCAT(CAST(CAST(EXTRACT(YEAR FROM ts + (event_id % 7 - 3) * INTERVAL '30' MINUTE) AS BIGINT) * 10000000000
    + CAST(EXTRACT(MONTH FROM ts + (event_id % 7 - 3) * INTERVAL '30' MINUTE) AS BIGINT) * 100000000
    + CAST(EXTRACT(DAY FROM ts + (event_id % 7 - 3) * INTERVAL '30' MINUTE) AS BIGINT) * 1000000
    + CAST(EXTRACT(HOUR FROM ts + (event_id % 7 - 3) * INTERVAL '30' MINUTE) AS BIGINT) * 10000
    + CAST(EXTRACT(MINUTE FROM ts + (event_id % 7 - 3) * INTERVAL '30' MINUTE) AS BIGINT) * 100
    + CAST(FLOOR(EXTRACT(SECOND FROM ts)) AS BIGINT) AS STRING), '_', CAST(event_id AS STRING)) AS measurement_uid,
  CASE user_id % 5 WHEN 0 THEN 'IT' WHEN 1 THEN 'DE' WHEN 2 THEN 'FR' WHEN 3 THEN 'ES' ELSE 'US' END AS probe_cc,
  100 + user_id % 7 AS probe_asn,
  CASE WHEN event_id % 3 = 0 THEN 100 + user_id % 7 ELSE 900 + event_id % 2 END AS resolver_asn,
  CASE user_id % 3 WHEN 0 THEN '3.20.0' WHEN 1 THEN '3.21.1' ELSE '3.22.0' END AS software_version,
  'probe-cli' AS software_name, 'amd64' AS architecture, event_type AS platform, '3.2' AS engine_version,
  CASE WHEN user_id % 9 = 0 THEN '' ELSE CONCAT('p', CAST(user_id AS STRING)) END AS probe_id,
  CONCAT('d', CAST(event_id % 6 AS STRING), '.example') AS domain
FROM {events}
"""

_IP = """CASE WHEN {k} % 17 = 0 THEN CONCAT('10.0.0.', CAST({k} AS STRING))
  WHEN {k} % 10 = 0 THEN CONCAT('2001:470:0:', CAST({k} AS STRING), '::1')
  ELSE CONCAT('93.184.', CAST({k} AS STRING), '.7') END"""


def _ip(key: str) -> str:
    return _IP.replace("{k}", key)


#: observations: one row a measurement and address
O = f"""
SELECT CAST(l_orderkey AS STRING) AS measurement_uid, CAST(l_linenumber AS BIGINT) AS observation_idx,
  CONCAT('r', CAST(o_custkey % 50 AS STRING)) AS report_id,
  CONCAT('h', CAST(l_partkey % 40 AS STRING), '.example') AS hostname,
  CONCAT('https://h', CAST(l_orderkey % 40 AS STRING), '.example/p?', CAST(l_orderkey % 3 AS STRING)) AS input,
  {_ip('(l_suppkey % 60)')} AS ip,
  CASE WHEN l_suppkey % 60 % 17 = 0 THEN 1 ELSE 0 END AS ip_is_bogon,
  l_suppkey % 30 AS ip_asn,
  CASE CAST(l_quantity AS BIGINT) % 4 WHEN 0 THEN 'system' WHEN 1 THEN 'getaddrinfo' WHEN 2 THEN 'udp' END AS dns_engine,
  CASE WHEN l_linenumber = 4 THEN 'dns_nxdomain_error' WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN 'generic_timeout_error' END AS dns_failure,
  CASE WHEN l_linenumber IN (4, 7) OR (l_linenumber = 6 AND l_returnflag = 'R') THEN NULL ELSE {_ip('(l_suppkey % 60)')} END AS dns_answer,
  CASE WHEN l_linenumber = 5 THEN NULL WHEN l_returnflag = 'R' AND CAST(l_quantity AS BIGINT) % 5 < 2 THEN 0 ELSE 1 END AS tcp_success,
  CASE WHEN l_linenumber <> 5 AND l_returnflag = 'R' AND CAST(l_quantity AS BIGINT) % 5 = 0 THEN 'connection_refused'
       WHEN l_linenumber <> 5 AND l_returnflag = 'R' AND CAST(l_quantity AS BIGINT) % 5 = 1 THEN 'generic_timeout_error' END AS tcp_failure,
  CASE WHEN l_linenumber = 5 OR l_returnflag = 'R' THEN NULL
       WHEN l_returnflag = 'A' AND CAST(l_quantity AS BIGINT) % 7 = 0 THEN 'ssl_invalid_hostname'
       WHEN l_returnflag = 'A' AND CAST(l_quantity AS BIGINT) % 7 = 1 THEN 'connection_reset'
       WHEN l_returnflag = 'A' AND CAST(l_quantity AS BIGINT) % 7 = 2 THEN 'generic_timeout_error' END AS tls_failure,
  CASE WHEN l_linenumber = 5 OR l_returnflag = 'R' THEN NULL
       WHEN l_returnflag = 'A' AND CAST(l_quantity AS BIGINT) % 7 = 0 THEN 0
       WHEN l_returnflag = 'A' AND CAST(l_quantity AS BIGINT) % 7 < 3 THEN NULL
       WHEN l_suppkey % 3 = 0 THEN 1 END AS tls_is_certificate_valid,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE CONCAT('h', CAST(l_partkey % 40 AS STRING), '.example') END AS tls_server_name,
  CASE WHEN l_linenumber % 3 = 1 THEN 'write_1' ELSE 'read_2' END AS tls_handshake_last_operation,
  CONCAT('K', CAST(l_suppkey % 8 AS STRING)) AS ip_cc, CONCAT('org', CAST(l_suppkey % 30 AS STRING)) AS ip_as_org_name,
  CASE WHEN l_discount > 0.05 THEN 'http_timeout' END AS http_failure,
  'web_connectivity' AS test_name, o_orderdate AS measurement_start_time,
  CONCAT('C', CAST(c_nationkey % 6 AS STRING)) AS probe_cc, CAST(o_custkey % 9 AS BIGINT) AS probe_asn,
  CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey % 9 AS BIGINT) ELSE 77 END AS resolver_asn,
  CASE WHEN o_custkey % 4 = 0 THEN '' ELSE CONCAT('p', CAST(o_custkey % 200 AS STRING)) END AS probe_id,
  CASE WHEN l_tax > 0.06 THEN 'dns' WHEN l_tax > 0.04 THEN 'false' END AS probe_analysis,
  CONCAT('3.', CAST(o_custkey % 4 AS STRING)) AS software_version,
  CASE o_custkey % 3 WHEN 0 THEN 'wifi' WHEN 1 THEN 'mobile' ELSE 'unknown' END AS network_type,
  CONCAT('https://h', CAST(l_partkey % 40 AS STRING), '.example/', CAST(l_linenumber AS STRING)) AS http_url,
  l_orderkey AS order_key
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey
"""

#: control observations of all lines; four hosts have none
C = f"""
SELECT CAST(l_orderkey AS STRING) AS measurement_uid, CAST(l_linenumber AS BIGINT) AS observation_idx,
  CONCAT('h', CAST(l_partkey % 45 + 4 AS STRING), '.example') AS hostname,
  CASE WHEN l_linenumber = 6 THEN NULL ELSE {_ip('((l_suppkey + l_partkey % 2) % 60)')} END AS ip,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE (l_suppkey + l_partkey % 2) % 30 END AS ip_asn,
  CONCAT('org', CAST(l_suppkey % 30 AS STRING)) AS ip_as_org_name, CONCAT('K', CAST(l_suppkey % 8 AS STRING)) AS ip_cc,
  CASE WHEN l_linenumber = 6 THEN 'dns_nxdomain_error' END AS dns_failure,
  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_tax < 0.06 THEN 1 END AS dns_success,
  CASE WHEN l_linenumber IN (3, 6) THEN NULL WHEN CAST(l_quantity AS BIGINT) % 3 = 0 THEN 0 ELSE 1 END AS tcp_success,
  CASE WHEN l_linenumber IN (3, 6) THEN NULL WHEN CAST(l_quantity AS BIGINT) % 3 = 0 THEN 'connection_refused' END AS tcp_failure,
  CASE WHEN l_linenumber IN (3, 6) THEN NULL WHEN l_partkey % 5 = 0 THEN 0 WHEN l_partkey % 5 < 3 THEN 1 END AS tls_success,
  CASE WHEN l_linenumber IN (3, 6) OR l_partkey % 5 <> 0 THEN NULL WHEN l_returnflag = 'A' THEN 'ssl_invalid_hostname' ELSE 'connection_reset' END AS tls_failure,
  CONCAT('h', CAST(l_partkey % 45 + 4 AS STRING), '.example') AS tls_server_name,
  o_orderdate AS measurement_start_time
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
"""

#: verdicts: one row an event, the score going to the layer that the event type names
V = f"""
SELECT measurement_uid, measurement_start_time, probe_cc, probe_asn, resolver_asn, domain, probe_id, event_id, software_version,
  CASE WHEN event_type IN ('click', 'view') THEN x ELSE 0.0 END AS dns_blocked,
  CASE WHEN event_type = 'view' THEN (1 - x) / 2 ELSE 0.0 END AS dns_down,
  CASE WHEN event_type IN ('signup', 'purchase') THEN 1.0 ELSE 0.0 END AS dns_ok,
  CASE WHEN event_type = 'error' THEN x ELSE 0.0 END AS tcp_blocked,
  CASE WHEN event_type = 'error' THEN 1 - x ELSE 0.0 END AS tcp_down,
  CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END AS tcp_ok,
  CASE WHEN event_type = 'purchase' AND x > 0.5 THEN x ELSE 0.0 END AS tls_blocked,
  CASE WHEN event_type = 'purchase' AND x > 0.9 THEN 0.1 ELSE 0.0 END AS tls_down,
  CASE WHEN event_type = 'signup' THEN 1.0 ELSE 0.0 END AS tls_ok,
  CASE WHEN event_type = 'click' THEN CASE event_id % 3 WHEN 0 THEN 'dns_nxdomain_error' WHEN 1 THEN 'android_dns_cache_no_data' ELSE 'dns_refused_error' END END AS top_dns_failure,
  CASE WHEN event_type = 'error' THEN CASE event_id % 2 WHEN 0 THEN 'connection_refused' ELSE 'generic_timeout_error' END END AS top_tcp_failure,
  CASE WHEN event_type = 'purchase' AND x > 0.5 THEN 'connection_reset' END AS top_tls_failure,
  CASE WHEN event_type IN ('click', 'view') THEN CASE WHEN x > 0.6 THEN 'bogon_not_in_ctrl' ELSE 'dns_system_failure_ctrl_ok' END ELSE 'answer_matches_ctrl' END AS top_dns_rule_id,
  CASE WHEN event_type = 'error' THEN CASE WHEN x > 0.5 THEN 'failure_ctrl_ok' ELSE 'failure_ctrl_also_failing' END ELSE 'connect_ok' END AS top_tcp_rule_id,
  CASE WHEN event_type = 'purchase' AND x > 0.5 THEN 'failure_ctrl_ok_reset' WHEN event_type = 'signup' THEN 'certificate_valid' ELSE 'no_tls_data' END AS top_tls_rule_id
FROM (SELECT m.*, CASE WHEN value < 100 THEN value / 100 ELSE 1.0 END AS x FROM ({M}) m) w
"""

#: measurement targets by country code, a stand-in for dated address ranges: (day, first, last, length, asn, org, cc)
RANGES = """
SELECT CAST('1995-01-01' AS TIMESTAMP) AS snapshot, CAST(n_nationkey * 100 AS BIGINT) AS first, CAST(n_nationkey * 100 + 79 AS BIGINT) AS last,
  16 AS prefix_len, CAST(500 + n_nationkey AS BIGINT) AS asn, n_name AS org, CONCAT('N', CAST(n_nationkey AS STRING)) AS cc FROM {nation}
UNION ALL SELECT CAST('1995-01-01' AS TIMESTAMP), CAST(n_nationkey * 100 + 20 AS BIGINT), CAST(n_nationkey * 100 + 39 AS BIGINT),
  24, CAST(600 + n_nationkey AS BIGINT), n_name, CONCAT('N', CAST(n_nationkey AS STRING)) FROM {nation}
UNION ALL SELECT CAST('1998-01-01' AS TIMESTAMP), CAST(n_nationkey * 100 AS BIGINT), CAST(n_nationkey * 100 + 89 AS BIGINT),
  16, CAST(700 + n_nationkey AS BIGINT), n_name, CONCAT('Q', CAST(n_nationkey AS STRING)) FROM {nation}
"""

TEXTS = {"M": M, "O": O, "C": C, "V": V, "RANGES": RANGES}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in or a table as a DataFrame."""
    if name not in TEXTS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = TEXTS[name]
    used = [t for t in TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def ctes(*names: str) -> str:
    """``WITH`` clause for the checking SQL: the stand-ins as m, o, c, v, ranges."""
    parts = [f"{n.lower()} AS ({TEXTS[n].format(**{t: t for t in TABLES})})" for n in names]
    return "WITH " + ", ".join(parts)
