"""Queries over raw measurements: nested stand-ins of lines and events, exploded, paired and checked."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill import schemas
from netquill.functions import scalars as S
from netquill.operators import detect as D
from netquill.operators import enrich as E
from netquill.operators import extras as X
from netquill.operators import flatten as L
from netquill.operators import observations as B
from netquill.operators import quality as Q
from netquill.plans.catalog import query
from netquill.plans.q_detect import OPTIONS, WALK
from netquill.plans.standins import ctes, frame

VB, MB = ctes("V"), ctes("M")

#: a line's place in its order; equal lines are interchangeable
LINES = "WITH l AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS measurement_uid, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS pos FROM lineitem)"
_NAME = "concat('h', x.p % 40, '.example')"
_ADDRESS = "concat('93.184.', x.p % 200, '.7')"


def whole(kind: str, **own: str) -> str:
    """``named_struct`` of every field of ``kind``, in SQL: the given ones, and NULL for the others."""
    return "named_struct(" + ", ".join(
        f"'{f.name}', CAST({own.get(f.name, 'NULL')} AS {f.dataType.simpleString()})" for f in T._parse_datatype_string(kind).fields
    ) + ")"


def measurements(spark, d):
    """A measurement an order; each line is a query, a connection, a handshake with two events, and a request."""
    flat = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))
    rows = frame(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(flat)).alias("lines"))
    url = lambda x: f"concat('https://h', {x}.p % 40, '.example/', {x}.n)"
    inner = lambda kind, name: T._parse_datatype_string(kind)[name].dataType
    a_query, a_request = schemas._QUERY, schemas._REQUEST
    own = dict(transaction_id="i + 1L")
    answer = whole(inner(a_query, "answers").elementType.simpleString(), ipv4=_ADDRESS)
    request = whole(inner(a_request, "request").simpleString(), url=url("x"), method="'GET'", headers_list="array(array('Accept', '*/*'))")
    response = whole(
        inner(a_request, "response").simpleString(), code="200", body="CASE WHEN x.s % 3 <> 0 THEN concat('body', x.p) END",
        headers_list=f"array(array('LOCATION', CASE WHEN i % 2 = 1 THEN {url('lines[i - 1]')} END))",
    )
    arrays = {
        "queries": whole(a_query, hostname=_NAME, query_type="'A'", engine="'system'", t="0D", answers=f"array({answer})", **own),
        "tcp_connect": whole(
            schemas._TCP, ip=f"CASE x.p % 5 WHEN 0 THEN '[scrubbed]' WHEN 1 THEN 'oops' ELSE {_ADDRESS} END", port="443", t="CAST(x.n AS DOUBLE)",
            status="named_struct('success', x.s % 2 = 0, 'failure', CASE WHEN x.s % 2 = 1 THEN 'unknown_failure: read: connection refused' END)", **own,
        ),
        "tls_handshakes": whole(
            schemas._TLS, address=f"concat({_ADDRESS}, ':443')", server_name=_NAME, tls_version="'TLSv1.3'", failure="CASE x.s % 4 WHEN 0 THEN 'ssl_unknown_authority' WHEN 1 THEN 'connection_reset' END",
            no_tls_verify="x.s % 3 = 0", peer_certificates="transform(sequence(0, x.n % 3), k -> named_struct('format', 'base64', 'data', base64(CAST(concat('c', x.p, k) AS BINARY))))", t="CAST(x.n AS DOUBLE)", **own,
        ),
        "network_events": f"""array({whole(schemas._EVENT, operation="'write'", num_bytes="x.n", t="x.n", **own)}, {whole(schemas._EVENT, operation="'read'", num_bytes="x.p % 10", t="x.n + 0.5D", **own)})""",
        "requests": whole(
            a_request, network="CASE WHEN x.n % 2 = 0 THEN 'quic' ELSE 'tcp' END", address=f"concat({_ADDRESS}, ':443')", t="x.n + 1D", t0="x.n", request=request,
            response=f"CASE WHEN x.s % 7 <> 0 THEN {response} END", **own,
        ),
    }
    made = {n: F.expr(f"transform(lines, (x, i) -> {text})") for n, text in arrays.items()}
    made["network_events"] = F.flatten(made["network_events"])
    # as reading gives them, with every field of a measurement; lines of JSON themselves are read by the raw queries
    keys = F.struct(F.lit(None).cast("string").alias("client_resolver"), *[made[n].alias(n) for n in B.ARRAYS])
    return rows.select(F.col("l_orderkey").cast("string").alias("measurement_uid"), F.lit("2024-01-01 00:00:00").alias("measurement_start_time"), F.lit("web_connectivity").alias("test_name"), keys.alias("test_keys"))


_IP = "'93.184.' || (l_partkey % 200) || '.7'"
_AT = "TIMESTAMP '2024-01-01' + to_seconds({})"


@query("tcp_explode", f"""{LINES} SELECT measurement_uid, pos, CASE WHEN l_partkey % 5 = 0 THEN 'scrubbed' ELSE {_IP} END AS ip, 443 AS port, l_suppkey % 2 = 0 AS success,
  CASE WHEN l_suppkey % 2 = 1 THEN 'connection_refused' END AS failure, CAST(pos + 1 AS BIGINT) AS transaction_id, {_AT.format('l_linenumber')} AS ts FROM l WHERE l_partkey % 5 <> 1""")
def tcp_explode(spark, d):
    return L.explode_tcp(measurements(spark, d))


@query("http_explode", f"""{LINES}, u AS (SELECT *, 'https://h' || (l_partkey % 40) || '.example/' || l_linenumber AS url FROM l),
n AS (SELECT *, lead(url) OVER w AS before, lead(l_suppkey) OVER w AS s FROM u WINDOW w AS (PARTITION BY measurement_uid ORDER BY pos))
SELECT measurement_uid, pos, {_IP} AS ip, 443 AS port, url AS request_url, 'GET' AS method, CASE WHEN l_linenumber % 2 = 0 THEN 'udp' ELSE 'tcp' END AS network, CAST(1 AS DOUBLE) AS runtime,
  CASE WHEN l_suppkey % 7 <> 0 THEN 200 END AS status_code, CASE WHEN l_suppkey % 7 <> 0 AND l_suppkey % 3 <> 0 THEN CAST(length('body' || l_partkey) AS INTEGER) END AS body_length,
  CASE WHEN l_suppkey % 7 <> 0 AND l_suppkey % 3 <> 0 THEN sha1('body' || l_partkey) END AS body_sha1,
  CASE WHEN pos % 2 = 0 AND s % 7 <> 0 THEN before END AS redirect_from, {_AT.format('l_linenumber + 1')} AS ts FROM n""")
def http_explode(spark, d):
    return L.explode_http(measurements(spark, d)).drop("alpn", "failure", "location", "server", "transaction_id")


@query("tls_explode", f"""{LINES} SELECT measurement_uid, pos, {_IP} AS ip, 443 AS port, 'h' || (l_partkey % 40) || '.example' AS server_name,
  CASE l_suppkey % 4 WHEN 0 THEN 'ssl_unknown_authority' WHEN 1 THEN 'connection_reset' END AS failure,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL WHEN l_suppkey % 4 = 0 THEN false WHEN l_suppkey % 4 > 1 THEN true END AS is_certificate_valid, CAST(l_linenumber % 3 + 1 AS INTEGER) AS chain_length,
  CASE WHEN l_linenumber % 3 > 0 THEN sha256('c' || l_partkey || '1') ELSE '' END || CASE WHEN l_linenumber % 3 > 1 THEN ',' || sha256('c' || l_partkey || '2') ELSE '' END AS chain,
  CAST(0.5 AS DOUBLE) AS time, CAST(CASE WHEN l_partkey % 10 > 0 THEN 1 ELSE 0 END AS BIGINT) AS read_count, CAST(l_partkey % 10 AS BIGINT) AS read_bytes, CAST(1 AS BIGINT) AS write_count,
  CAST(l_linenumber AS BIGINT) AS write_bytes, CASE WHEN l_partkey % 10 > 0 THEN 'read_1' ELSE 'write_1' END AS last_operation FROM l""")
def tls_explode(spark, d):
    """Handshakes with their events by transaction id, and the digests of their chains."""
    rows = L.explode_tls(measurements(spark, d))
    names = ("measurement_uid", "pos", "ip", "port", "server_name", "failure", "is_certificate_valid", "chain_length")
    return rows.select(*names, F.array_join("chain_fingerprints", ",").alias("chain"), "handshake.*")


@query("web_observations", f"""{LINES}, c AS (SELECT *, CASE WHEN l_partkey % 5 <> 1 THEN 443 END AS tcp_port FROM l)
SELECT measurement_uid, {_IP} AS ip, 443 AS port, 'h' || (l_partkey % 40) || '.example' AS hostname, {_IP} AS dns_answer, CASE WHEN l_partkey % 5 = 0 THEN 'scrubbed' WHEN l_partkey % 5 > 1 THEN {_IP} END AS tcp_ip,
  CASE WHEN l_partkey % 5 <> 1 AND l_suppkey % 2 = 1 THEN 'connection_refused' END AS tcp_failure, CASE l_suppkey % 4 WHEN 0 THEN 'ssl_unknown_authority' WHEN 1 THEN 'connection_reset' END AS tls_failure,
  CASE WHEN l_partkey % 10 > 0 THEN 'read_1' ELSE 'write_1' END AS tls_handshake_last_operation, CASE WHEN l_suppkey % 7 <> 0 THEN 200 END AS http_status_code, CAST(pos + 1 AS BIGINT) AS transaction_id, pos + 1 AS observation_idx FROM c""")
def web_observations(spark, d):
    """From the nested measurement to one row a connection: exploded, paired by transaction id, assembled."""
    out = B.observations(measurements(spark, d), ("web_connectivity",))
    return out.select("measurement_uid", "ip", "port", "hostname", "dns_answer", "tcp_ip", "tcp_failure", "tls_failure", "tls_handshake_last_operation", "http_status_code", "transaction_id", "observation_idx")


@query("web_observations_platform", f"""{LINES} SELECT measurement_uid, 'h' || (l_partkey % 40) || '.example' AS hostname, pos + 1 AS observation_idx, CASE WHEN l_orderkey % 2 = 0 THEN NULL ELSE 't' || (l_orderkey % 3) END AS target_id FROM l""")
def web_observations_platform(spark, d):
    """The same connections as those of a messaging test, whose hosts are no named ones, and of a map of targets."""
    m = measurements(spark, d)
    even = F.col("measurement_uid").cast("long") % 2 == 0
    chat = B.observations(m.filter(even).withColumn("test_name", F.lit("telegram")), ("telegram",))
    lookups = F.create_map(F.concat(F.lit("t"), (F.col("measurement_uid").cast("long") % 3).cast("string")), F.struct(*[f"test_keys.{n}" for n in B.ALL]))
    keyed = m.filter(~even).withColumns({"test_name": F.lit("tor"), "test_keys": F.struct(lookups.alias("targets"))})
    tor = B.observations(keyed, ("tor",))
    part = lambda df: df.select("measurement_uid", "hostname", "observation_idx", "target_id")
    return part(chat).unionByName(part(tor))


@query("hint_hosts", """SELECT CAST(l_orderkey AS VARCHAR) AS measurement_uid, 'a' || (l_suppkey % 9) AS ip, CASE WHEN l_linenumber % 2 = 0 THEN 'own' ELSE h.hint END AS hostname FROM lineitem LEFT JOIN
  (SELECT l_orderkey AS k, 'a' || (l_suppkey % 9) AS a, min('h' || (l_partkey % 7)) AS hint FROM lineitem WHERE l_linenumber > 2 GROUP BY ALL) h ON l_orderkey = k AND a = 'a' || (l_suppkey % 9)""")
def hint_hosts(spark, d):
    li = frame(spark, d, "lineitem")
    uid, ip = F.col("l_orderkey").cast("string").alias("measurement_uid"), F.concat(F.lit("a"), (F.col("l_suppkey") % 9).cast("string")).alias("ip")
    rows = li.select(uid, ip, F.when(F.col("l_linenumber") % 2 == 0, "own").alias("hostname"))
    return L.hint_hostnames(rows, li.filter("l_linenumber > 2").select(uid, ip, F.concat(F.lit("h"), (F.col("l_partkey") % 7).cast("string")).alias("hint"))).select("measurement_uid", "ip", "hostname")


@query("hfm_check", """WITH r AS (SELECT CAST(event_id AS VARCHAR) AS measurement_uid, CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'connection_reset' ELSE 'missing_response' END
  WHEN 'click' THEN 'missing_response_body' WHEN 'view' THEN 'malformed_request' WHEN 'signup' THEN 'missing_requests' END AS hfm_failure FROM events) SELECT *, hfm_failure IS NULL AS hfm_success FROM r""")
def hfm_check(spark, d):
    """A failed request with a response counts by its response."""
    request = """named_struct('failure', CASE WHEN event_id % 2 = 0 THEN 'connection_reset' END,
      'response', CASE WHEN event_type <> 'error' THEN named_struct('body', CASE WHEN event_type <> 'click' THEN 'x' END) END,
      'request', named_struct('headers_list', CASE WHEN event_type <> 'view' THEN array(array('a', 'b')) END))"""
    rows = frame(spark, d, "events").select(F.col("event_id").cast("string").alias("measurement_uid"), F.expr(f"named_struct('requests', CASE WHEN event_type = 'signup' THEN filter(array({request}), x -> false) ELSE array({request}) END)").alias("test_keys"))
    return L.header_field_check(rows)


@query("gate", "SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'IT' WHEN 1 THEN 'DE' ELSE 'FR' END AS probe_cc FROM events WHERE event_type <> 'error' AND user_id % 3 < 2")
def gate(spark, d):
    cc = F.when(F.col("user_id") % 3 == 0, "IT").when(F.col("user_id") % 3 == 1, "DE").otherwise("FR")
    rows = frame(spark, d, "events").select("event_id", cc.alias("probe_cc"), F.when(F.col("event_type") != "error", F.col("props")).alias("test_keys"))
    return L.gate(rows, ("IT", "DE")).drop("test_keys")


@query("probe_meta", """SELECT CAST(event_id AS VARCHAR) AS measurement_uid, 100 + user_id % 7 AS probe_asn, CASE WHEN event_type = 'view' THEN 'linux' ELSE 'unknown' END AS platform, 'unknown' AS origin,
  CASE WHEN user_id % 4 IN (0, 1) THEN '' ELSE '9.9.9.' || (user_id % 4) END AS resolver_ip, CASE WHEN user_id % 4 = 0 THEN event_id % 50 ELSE 0 END AS resolver_asn, event_id % 50 AS resolver_asn_probe,
  user_id % 4 = 0 AS resolver_is_scrubbed FROM events""")
def probe_meta(spark, d):
    ip = F.when(F.col("user_id") % 4 == 0, "[scrubbed]").when(F.col("user_id") % 4 == 1, "").otherwise(F.concat(F.lit("9.9.9."), (F.col("user_id") % 4).cast("string")))
    number = lambda c: F.concat(F.lit("AS"), c.cast("string"))
    rows = frame(spark, d, "events").select(
        F.col("event_id").cast("string").alias("measurement_uid"), number(100 + F.col("user_id") % 7).alias("probe_asn"), F.lit("IT").alias("probe_cc"),
        F.when(F.col("event_type") == "view", F.create_map(F.lit("platform"), F.lit("linux"))).alias("annotations"), ip.alias("resolver_ip"), number(F.col("event_id") % 50).alias("resolver_asn"),
        F.lit("net").alias("resolver_network_name"), F.lit("").alias("probe_id"), F.struct(F.lit(None).cast("string").alias("client_resolver")).alias("test_keys"),
    )
    return L.probe_meta(rows).select("measurement_uid", "probe_asn", "platform", "origin", "resolver_ip", "resolver_asn", "resolver_asn_probe", "resolver_is_scrubbed")


@query("ip6_prefixes", """WITH s AS (SELECT o_orderkey, o_custkey % 16 AS a, o_custkey % 300 AS b, o_custkey % 5 AS k FROM orders)
SELECT o_orderkey, CASE WHEN k = 0 THEN 64666 WHEN k = 1 OR a > 11 THEN 0 WHEN b < 64 AND a < 8 THEN 200 + a ELSE 100 + a END AS asn, CASE WHEN k = 0 OR k = 1 OR a > 11 THEN 'ZZ' ELSE 'N' || a END AS cc FROM s""")
def ip6_prefixes(spark, d):
    """IPv6 addresses against prefixes of 32 digits, some of them with a longer one inside, of the row's day."""
    a, b, k = F.col("o_custkey") % 16, F.col("o_custkey") % 300, F.col("o_custkey") % 5
    hexed = lambda c: F.lower(F.hex(c))
    ip = F.when(k == 0, F.lit("fe80::1")).when(k == 1, "none").otherwise(F.concat(F.lit("2a0"), hexed(a), F.lit(":0:"), hexed(b), F.lit("::7")))
    rows = frame(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("measurement_start_time"), ip.alias("ip"))
    n = frame(spark, d, "nation").filter("n_nationkey < 12").select(F.col("n_nationkey").alias("a"))
    short = E.ipv6_bits(F.concat(F.lit("2a0"), hexed(F.col("a")), F.lit("::")))
    made = lambda size, first: n.filter("a < 8" if size > 32 else "true").select(F.lit("1970-01-01").cast("timestamp").alias("snapshot"), F.expr(f"a + {first}").alias("asn"), F.concat(F.lit("N"), F.col("a").cast("string")).alias("cc"), F.substring(short, 1, size).alias("prefix"), F.lit("").alias("org"), F.lit("").alias("as_cc"))
    return E.enrich_address(rows, frame(spark, d, "RANGES").withColumn("as_cc", F.col("cc")), made(32, 100).unionByName(made(42, 200))).select("o_orderkey", "asn", "cc")


@query("platform_targets", """SELECT event_id, CASE event_type WHEN 'view' THEN CASE event_id % 3 WHEN 0 THEN 'telegram/web' WHEN 1 THEN 'telegram/dc_pool' END WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN 'whatsapp/web' WHEN 1 THEN 'whatsapp/endpoints' END
  WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 'signal/chat' WHEN 1 THEN 'signal/cdn' END END AS target_id FROM events""")
def platform_targets(spark, d):
    names = {"view": ("telegram", "web.telegram.org", "", "x.example"), "click": ("whatsapp", "web.whatsapp.com", "e{}.whatsapp.net", "e.whatsapp.net"), "error": ("signal", "chat.signal.org", "cdn{}.signal.org", "cdnx.signal.org")}
    host = platform = F.lit(None).cast("string")
    k = F.col("event_id") % 3
    for kind, (p, exact, pattern, other) in names.items():
        here = F.col("event_type") == kind
        platform = F.when(here, F.lit(p)).otherwise(platform)
        host = F.when(here, F.when(k == 0, exact).when(k == 1, F.replace(F.lit(pattern), F.lit("{}"), (F.col("event_id") % 12).cast("string"))).otherwise(other)).otherwise(host)
    return frame(spark, d, "events").select("event_id", E.platform_target(platform, host, F.lit("149.154.167.50")).alias("target_id"))


@query("fp_by_address", """WITH f AS (SELECT 'a' || (s_suppkey % 20) AS pattern, 'fp' || s_suppkey AS name, s_suppkey AS position FROM supplier WHERE s_suppkey % 20 < 15), b AS (SELECT pattern, arg_min(name, position) AS fingerprint FROM f GROUP BY pattern)
SELECT o_orderkey, 'a' || (o_custkey % 20) AS dns_answer, fingerprint FROM orders LEFT JOIN b ON pattern = 'a' || (o_custkey % 20)""")
def fp_by_address(spark, d):
    key = lambda c: F.concat(F.lit("a"), (F.col(c) % 20).cast("string"))
    kind = F.when(F.col("s_suppkey") % 20 < 15, "full").otherwise("contains")
    fps = frame(spark, d, "supplier").select(kind.alias("pattern_type"), key("s_suppkey").alias("pattern"), F.concat(F.lit("fp"), F.col("s_suppkey").cast("string")).alias("name"), F.col("s_suppkey").alias("position"))
    return E.first_by_address(frame(spark, d, "orders").select("o_orderkey", key("o_custkey").alias("dns_answer")), fps).select("o_orderkey", "dns_answer", "fingerprint")


@query("asn_flatten", "SELECT c_custkey AS asn, 'org' || k AS org_name, 'N' || c_nationkey AS cc, DATE '2020-01-01' + CAST(k * 31 AS INTEGER) AS changed, 'n' || k AS aut_name, 's' AS source FROM customer, unnest(range(0, 3)) AS t(k)")
def asn_flatten(spark, d):
    """A line of JSON a network, with three changes each."""
    entry = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.array(
        F.concat(F.lit("org"), k.cast("string")), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), k * 31), "yyyyMMdd"), F.concat(F.lit("n"), k.cast("string")), F.lit("s")))
    text = frame(spark, d, "customer").select(F.to_json(F.create_map(F.col("c_custkey").cast("string"), entry)).alias("value"))
    return E.asn_flatten(text)


@query("clear_changes", "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-05' OR ts > TIMESTAMP '2024-01-20'")
def clear_changes(spark, d):
    """What is left after a range of change points is cleared."""
    return D.clear_changes(frame(spark, d, "events").select("event_id", "ts"), datetime(2024, 1, 5), datetime(2024, 1, 20))


@query("hier_scores", """WITH p AS (SELECT 'a.' || (event_id % 3) || '.' || (event_id % 4) AS t, 'a.' || (event_id % 3) || '.' || (event_id % 5) AS g FROM events),
s AS (SELECT sum(CASE WHEN t = g THEN 3 ELSE 2 END) AS b, sum(3) AS n FROM p) SELECT CAST(b AS DOUBLE) / n AS precision, CAST(b AS DOUBLE) / n AS recall FROM s""")
def hier_scores(spark, d):
    label = lambda n: F.concat(F.lit("a."), (F.col("event_id") % 3).cast("string"), F.lit("."), (F.col("event_id") % n).cast("string"))
    return X.hierarchical_scores(frame(spark, d, "events").select(label(4).alias("t"), label(5).alias("g")), "t", "g")


@query("event_fields", """SELECT event_id, event_type = 'view' AS ongoing, CASE WHEN event_id % 2 = 0 THEN 'dns,tcp' ELSE 'tcp' END AS layers,
  CASE WHEN user_id % 20 >= 10 THEN 'national' WHEN user_id % 20 >= 3 THEN 'regional' ELSE 'local' END AS size_band FROM events""")
def event_fields(spark, d):
    labels = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("tcp.x"), F.lit("dns.y"), F.lit("tcp.z"))).otherwise(F.array(F.lit("tcp.x")))
    rows = frame(spark, d, "events").select("event_id", labels.alias("labels"), F.when(F.col("event_type") != "view", F.col("ts")).alias("ended"), (F.col("user_id") % 20).alias("n_networks"))
    return X.event_fields(rows).select("event_id", "ongoing", F.array_join("layers", ",").alias("layers"), "size_band")


@query("cell_histograms", f"""{VB} SELECT probe_cc, date_trunc('hour', measurement_start_time) AS ts, 'dns' AS layer, top_dns_rule_id AS rule_id, count(*) AS n FROM v GROUP BY ALL
  UNION ALL SELECT probe_cc, date_trunc('hour', measurement_start_time), 'tcp', top_tcp_rule_id, count(*) FROM v GROUP BY ALL UNION ALL SELECT probe_cc, date_trunc('hour', measurement_start_time), 'tls', top_tls_rule_id, count(*) FROM v GROUP BY ALL""")
def cell_histograms(spark, d):
    state = X.cell_state(frame(spark, d, "V"), ["probe_cc"])
    return X.cell_histograms(state, ["probe_cc"]).select("probe_cc", "ts", "layer", F.explode("rules").alias("rule_id", "n"))


@query("fp_canaries", """SELECT s_suppkey, 'pattern' AS problem FROM supplier WHERE s_suppkey % 4 = 0 UNION ALL SELECT s_suppkey, 'country' FROM supplier WHERE s_suppkey % 5 = 0""")
def fp_canaries(spark, d):
    """Fingerprints of an unknown kind, and those with anything but country codes."""
    fps = frame(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, "glob").otherwise("full").alias("pattern_type"), F.when(F.col("s_suppkey") % 5 == 0, "IT, Italy").otherwise("IT,DE").alias("expected_countries"))
    tag = lambda df, name: df.select("s_suppkey", F.lit(name).alias("problem"))
    return tag(Q.unsupported_patterns(fps), "pattern").unionByName(tag(Q.bad_countries(fps), "country"))


@query("test_groups", "SELECT CASE WHEN event_type IN ('view', 'click') THEN 'websites' ELSE '' END AS test_group, count(*) AS n FROM events GROUP BY ALL")
def test_groups(spark, d):
    name = F.when(F.col("event_type") == "view", "web_connectivity").when(F.col("event_type") == "click", "http_requests").otherwise(F.col("event_type"))
    return frame(spark, d, "events").groupBy(S.test_group(name).alias("test_group")).agg(F.count("*").alias("n"))


@query("missing_signals", f"""{MB}, x AS (SELECT probe_asn, CAST(floor(event_id % 4) AS INTEGER) AS s FROM m WHERE event_type <> 'error' OR probe_asn % 2 = 0),
k AS (SELECT a.probe_asn, t.s FROM (SELECT DISTINCT probe_asn FROM m) a, unnest(range(0, 5)) AS t(s)) SELECT probe_asn, 's' || s AS signal FROM k WHERE (probe_asn, s) NOT IN (SELECT probe_asn, s FROM x)""")
def missing_signals(spark, d):
    """The expected signals that a network never gave."""
    m = frame(spark, d, "M")
    seen = m.filter("event_type <> 'error' OR probe_asn % 2 = 0").select("probe_asn", F.concat(F.lit("s"), (F.col("event_id") % 4).cast("string")).alias("signal"))
    return D.missing_signals(m.select("probe_asn").distinct(), seen, "probe_asn", tuple(f"s{k}" for k in range(5)))


# the walk of a warm-up: the state is found once and then kept, and no change is emitted
_WARM = (
    WALK.replace("FROM v GROUP BY ALL)", "FROM v WHERE measurement_start_time > TIMESTAMP '2024-01-20' - INTERVAL 30 DAY AND measurement_start_time < TIMESTAMP '2024-01-20' GROUP BY ALL)")
    .replace("WHEN ep > 0.7 AND st <> 'blk' OR en > 0.7 AND st <> 'ok' THEN 0", "WHEN st = 'unk' AND (ep > 0.7 OR en > 0.7) THEN 0")
    .replace("CASE WHEN st = 'ok' AND ep > 0.7 AND ch <> 1 THEN 1 WHEN st = 'blk' AND en > 0.7 AND ch <> -1 THEN -1 ELSE 0 END AS emitted", "0 AS emitted")
)


@query("warmed_state", f"""{_WARM}, k AS (SELECT probe_cc, probe_asn, domain, signal, max(ts) AS ts FROM points GROUP BY ALL),
e AS (SELECT probe_cc, probe_asn, domain, signal, arg_max(st, i) AS st, arg_max(p, i) AS p, arg_max(n, i) AS n FROM walk GROUP BY ALL)
SELECT k.probe_cc, k.probe_asn, k.domain, k.signal, k.ts, coalesce(st, 'unk') AS current_state, coalesce(p, 0) AS s_pos, coalesce(n, 0) AS s_neg, 0 AS last_change
FROM k LEFT JOIN e ON k.probe_cc = e.probe_cc AND k.probe_asn = e.probe_asn AND k.domain = e.domain AND k.signal = e.signal""")
def warmed_state(spark, d):
    """Which state a warm-up of thirty days before a start leaves."""
    return D.warm_up(frame(spark, d, "V"), datetime(2024, 1, 20), **OPTIONS).select(*D.KEY, "signal", "ts", "current_state", "s_pos", "s_neg", "last_change")
