"""Unit tests of operators that the driver tables cannot show."""

import gzip
import io
import json
import tarfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from netquill import schemas
from netquill.functions import scalars as S
from netquill.operators import aggregate as A
from netquill.operators import detect as D
from netquill.operators import enrich as E
from netquill.operators import extras as X
from netquill.operators import flatten as L
from netquill.operators import observations as B
from netquill.operators import quality as Q
from netquill.operators import rules as R
from netquill.operators import text as T
from netquill.operators import verdicts as V
from netquill.schemas import MEASUREMENT, TEST_NAMES
from netquill.sources import io as IO

DAY = datetime(2024, 1, 1, 5)


def test_bogons_and_addresses(spark):
    cases = {
        "10.1.2.3": True, "8.8.8.8": False, "100.64.0.1": True, "224.0.0.1": True, "::1": True, "2001:db8::5": True, "2002:a00:1::": True,
        "2001:0:a00::1": True, "2606:4700::1111": False, "fe80::1": True, "2002:808:808::": False, "not an ip": False, "300.1.1.1": False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "ip string")
    got = {r.ip: r.b for r in df.select("ip", S.is_bogon(F.col("ip")).alias("b")).collect()}
    assert got == cases
    assert len(S.BOGON_V4) == 13 and len(S.v6_bogons()) == 40


def test_ipv6_agrees_with_the_standard_library(spark):
    import ipaddress

    texts = ["::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::3:4:5:6:7:8", ":1::2", "1:2", "1:::2", "1::2::3", "12345::", "1:2:3:4:5:6:7:8:9", "g::1", "2001:470:0:50::1", ":", ""]
    got = {r.ip: (r.v, r.h) for r in spark.createDataFrame([(x,) for x in texts], "ip string").select("ip", S.is_ipv6(F.col("ip")).alias("v"), S.ipv6_hex(F.col("ip")).alias("h")).collect()}
    for x in texts:
        try:
            want = f"{int(ipaddress.IPv6Address(x)):032x}"
        except ValueError:
            want = None
        assert got[x] == (want is not None, want), x


def test_scalars(spark):
    df = spark.createDataFrame([("[2001:db8::1]:443", "unknown_failure: connect: no route to host", "AS12", bytes([0xE9]))], "a string, f string, n string, b binary")
    host, port = S.host_port(F.col("a"))
    r = df.select(host.alias("h"), port.alias("p"), S.normal_failure(F.col("f")).alias("f"), S.decoded(F.col("b")).alias("t"), S.test_group(F.lit("web_connectivity")).alias("g")).first()
    assert (r.h, r.p, r.f, r.t, r.g) == ("2001:db8::1", 443, "host_unreachable", "é", "websites")
    assert S.as_number("AS12") == 12


def obs(spark, **kw):
    base = dict(
        measurement_uid="m", observation_idx=1, report_id="r", hostname="h", input="https://h/", ip="1.2.3.4", ip_is_bogon=0, ip_asn=7, dns_engine="system", dns_failure=None,
        dns_answer="1.2.3.4", tcp_success=None, tcp_failure=None, tls_failure=None, tls_is_certificate_valid=None, tls_server_name="h", http_failure=None,
        test_name="web_connectivity", measurement_start_time=DAY, probe_cc="IT", probe_asn=1, resolver_asn=1, probe_id="p", probe_analysis=None, software_version="3", network_type="wifi",
    )
    row = base | kw
    schema = "measurement_uid string, observation_idx long, report_id string, hostname string, input string, ip string, ip_is_bogon int, ip_asn long, dns_engine string, dns_failure string, dns_answer string, tcp_success int, tcp_failure string, tls_failure string, tls_is_certificate_valid int, tls_server_name string, http_failure string, test_name string, measurement_start_time timestamp, probe_cc string, probe_asn long, resolver_asn long, probe_id string, probe_analysis string, software_version string, network_type string"
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in schema.split(", "))], schema)


def ctrl(spark, *rows):
    schema = "hostname string, ip string, ip_asn long, dns_failure string, dns_success int, tcp_success int, tcp_failure string, tls_success int, tls_failure string, measurement_start_time timestamp"
    keys = [c.split()[0] for c in schema.split(", ")]
    full = [{"hostname": "h", "measurement_start_time": DAY} | r for r in rows]
    return spark.createDataFrame([tuple(r.get(k) for k in keys) for r in full], schema)


OK = {"ip": "1.2.3.4", "ip_asn": 7, "dns_success": 1, "tcp_success": 1, "tls_success": 1}
CASES = [
    ("dns", dict(dns_answer=None, ip=None), [], "no_dns_data", (0, 0, 0)),
    ("dns", {}, [OK], "tls_consistent_answer", (0, 0, 1)),
    ("dns", dict(ip="10.0.0.1", dns_answer="10.0.0.1", ip_is_bogon=1), [OK], "bogon_not_in_ctrl", (0.95, 0.05, 0)),
    ("dns", dict(ip="10.0.0.1", dns_answer="10.0.0.1", ip_is_bogon=1), [{"ip": "10.0.0.1", "dns_success": 1}], "bogon_in_ctrl", (0.1, 0.9, 0)),
    ("dns", dict(dns_answer=None, ip=None, dns_failure="x"), [OK], "dns_system_failure_ctrl_ok", (0.9, 0.1, 0)),
    ("dns", dict(dns_answer=None, ip=None, dns_failure="x"), [], "dns_system_failure_no_ctrl", (0.5, 0.5, 0)),
    ("dns", dict(ip="9.9.9.9", dns_answer="9.9.9.9", ip_asn=1), [OK], "dns_system_answer_unmatched", (0.75, 0, 0.25)),
    ("tcp", {}, [OK], "none", (0, 0, 0)),
    ("tcp", dict(ip="2001:470::1", dns_answer="2001:470::1", tcp_success=0, tcp_failure="x"), [], "ipv6_broken_probe", (0, 0, 0)),
    ("tls", dict(tls_failure="ssl_invalid_hostname", tls_is_certificate_valid=0), [OK], "failure_ctrl_ok_ssl", (0.9, 0.1, 0)),
    ("tls", dict(tls_failure="connection_reset"), [OK], "failure_ctrl_ok_reset", (0.8, 0.2, 0)),
]


@pytest.mark.parametrize("layer,row,control,rule,scores", CASES)
def test_hand_cases(spark, layer, row, control, rule, scores):
    r = V.scored_rows(obs(spark, **row), ctrl(spark, *control)).first()
    assert r[f"{layer}_rule_id"] == rule
    assert tuple(r[f"{layer}_{x}"] for x in ("blocked", "down", "ok")) == pytest.approx(scores)


def test_rows_without_evidence_do_not_win(spark):
    rows = obs(spark).unionByName(obs(spark, observation_idx=2, ip=None, dns_answer=None, dns_engine=None, hostname="other"))
    assert V.web_verdicts(rows, ctrl(spark, OK)).first().top_dns_rule_id == "tls_consistent_answer"


def test_answers_other_than_the_row_s_address_are_evidence(spark):
    """A name among the answers, and the answers of other rows of the measurement, count for all its rows of the name."""
    rows = obs(spark, dns_answer="cdn.example").unionByName(obs(spark, observation_idx=2, ip="9.9.9.9", dns_answer="9.9.9.9", ip_asn=1))
    named = ctrl(spark, {"ip": "cdn.example", "dns_success": 1})
    flags = V.with_flags(V.with_day(rows), V.address_evidence(V.with_day(named), V.with_day(rows)), V.host_evidence(V.with_day(named))).collect()
    assert len(flags) == 2 and all((r.dns_answer_count, r.dns_answer_matches_ctrl, r.dns_tls_consistent) == (2, True, False) for r in flags)
    other = ctrl(spark, {"ip": "9.9.9.9", "tls_success": 0, "tls_failure": "ssl_x", "ip_asn": 5, "dns_success": None})
    flags = V.with_flags(V.with_day(rows), V.address_evidence(V.with_day(other), V.with_day(rows)), V.host_evidence(V.with_day(other))).collect()
    assert all((r.dns_tls_inconsistent, r.dns_answer_matches_ctrl, r.dns_answer_asn_matches_ctrl) == (True, False, False) for r in flags)
    assert {r.ip: (r.ctrl_tls_failing_count, r.ctrl_tls_success_rate) for r in flags} == {"1.2.3.4": (0, None), "9.9.9.9": (1, 0.0)}


def test_certificates_seen_by_probes_need_a_control(spark):
    seen = obs(spark, tls_is_certificate_valid=1)
    none = ctrl(spark, {"hostname": "elsewhere"})
    assert V.scored_rows(seen, none).first().dns_rule_id == "dns_system_answer_unmatched"
    assert V.scored_rows(seen, ctrl(spark, {"dns_failure": "x"})).first().dns_rule_id == "tls_consistent_answer"


def test_verdicts_carry_no_maps_and_meet_once(spark):
    """Evidence is joined in long form, and rows are dealt by measurement once, for answers and verdict."""
    plan = V.web_verdicts(obs(spark), ctrl(spark, OK))._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan and "collect_list" not in plan and plan.count("RepartitionByExpression") == 1


def test_rule_set_is_sound(spark):
    table = R.rule_table(spark)
    assert R.lint(table).count() == 0
    bad = table.withColumn("blocked", F.when(F.col("rule_id") == "connect_ok", 0.5).otherwise(F.col("blocked")))
    assert R.lint(bad).count() > 0
    assert [len(R.RULES[x]) for x in ("dns", "tcp", "tls")] == [12, 6, 8]


def points(spark, values, start=DAY):
    rows = [("IT", 1, "d", start + timedelta(hours=i), y, 5) for i, y in enumerate(values)]
    s = spark.createDataFrame(rows, "probe_cc string, probe_asn long, domain string, ts timestamp, y double, n long")
    return s.select(*D.KEY, "ts", F.col("y").alias("tcp_blocked"), F.lit(0.0).alias("tls_blocked"), F.lit(0.0).alias("dns_isp_blocked"), F.lit(0.0).alias("dns_other_blocked"), F.col("n").alias("count"), F.lit(0).alias("count_isp_resolver"), F.lit(0).alias("count_other_resolver"))


def test_step_series_gives_one_change_each_way(spark):
    series = points(spark, [0.0] * 40 + [1.0] * 40 + [0.0] * 40)
    changes, _, steps = D.detect_changes(series, trace=True)
    got = [(r.change_dir, r.current_state) for r in changes.filter("signal = 'tcp_blocked'").orderBy("ts").collect()]
    assert got == [(1, "ok"), (-1, "blk")]
    assert steps.filter("signal = 'tcp_blocked' AND is_changepoint").count() == 2
    assert D.detect_changes(series, warmup=True)[0].count() == 0


def test_resumed_run_equals_one_run(spark):
    values = [0.0] * 30 + [1.0] * 30
    whole = D.detect_changes(points(spark, values))
    a = D.detect_changes(points(spark, values[:37]))
    b = D.detect_changes(points(spark, values[37:], DAY + timedelta(hours=37)), a[1])
    key = lambda df: sorted(map(tuple, df.select("signal", "ts", "change_dir", "s_pos").collect()))
    assert key(whole[0]) == key(a[0].unionByName(b[0]))
    assert D.clear_changes(whole[0], DAY, DAY + timedelta(days=30)).count() == 0


def test_streams_equal_their_batches(spark, tmp_path):
    from netquill.streaming.twins import cusum_stream, volume_stream

    pts = D.long_form(points(spark, [0.0] * 40 + [1.0] * 40)).withColumn("probe_asn", F.col("probe_asn").cast("long"))
    pts.coalesce(1).write.parquet(f"{tmp_path}/points")
    stream = spark.readStream.schema(pts.schema).parquet(f"{tmp_path}/points")
    q = cusum_stream(stream).writeStream.format("memory").queryName("cusum_twin").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = D.fold(pts).select("signal", F.inline("r.changes")).select("signal", "ts", "change_dir", "s_pos")
    assert sorted(map(tuple, spark.table("cusum_twin").select("signal", "ts", "change_dir", "s_pos").collect())) == sorted(map(tuple, want.collect()))

    rows = [(DAY + timedelta(seconds=i), "IT", 1, "e", "s", "1", "p", "a") for i in range(10)] + [(DAY, "IT", 2, "e", "s", "1", "p", "a")] * 2
    m = spark.createDataFrame(rows, "measurement_start_time timestamp, probe_cc string, probe_asn long, engine_version string, software_name string, software_version string, platform string, architecture string")
    m.coalesce(1).write.parquet(f"{tmp_path}/m")
    stream = spark.readStream.schema(m.schema).parquet(f"{tmp_path}/m")
    q = volume_stream(stream, 5).writeStream.format("memory").queryName("volume_twin").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = Q.volume_anomalies(m, threshold=5).select("ts", "probe_cc", "probe_asn", "total")
    assert spark.table("volume_twin").collect() == want.collect() and want.count() == 1


MSMT = {
    "measurement_uid": "u1", "input": "https://h.example/", "measurement_start_time": "2024-01-01 00:00:00", "probe_asn": "AS137", "probe_cc": "IT", "resolver_asn": "AS15", "resolver_ip": "[scrubbed]",
    "resolver_network_name": "net", "test_name": "web_connectivity", "annotations": {"platform": "linux"},
    "test_keys": {
        "queries": [{"hostname": "h.example", "query_type": "A", "engine": "system", "transaction_id": 1, "t": 1.5, "answers": [{"answer_type": "A", "ipv4": "1.2.3.4", "asn": 5}, {"answer_type": "A", "ipv4": "1.2.3.5"}]}, {"hostname": "h.example", "failure": "dns_nxdomain_error", "answers": None}],
        "tcp_connect": [{"ip": "1.2.3.4", "port": 443, "status": {"success": True}, "transaction_id": 1}, {"ip": "[scrubbed]", "port": 443, "status": {"success": False, "failure": "timed_out"}}, {"ip": "oops", "port": 1, "status": {"success": False}}],
        "tls_handshakes": [{"address": "1.2.3.4:443", "server_name": "h.example", "transaction_id": 0, "t": 4.0, "no_tls_verify": False, "peer_certificates": [{"data": "QQ==", "format": "base64"}, {"data": "Qg==", "format": "base64"}]}],
        "network_events": [{"operation": "connect", "t": 1.0}, {"operation": "write", "num_bytes": 10, "t": 2.0}, {"operation": "read", "num_bytes": 20, "t": 3.0}, {"operation": "tls_handshake_done", "t": 4.0}],
        "requests": [
            {"address": "1.2.3.4:443", "network": "quic", "t": 9.0, "t0": 7.0, "request": {"url": "https://h.example/b", "method": "GET"}, "response": {"code": 200, "body": "hi", "headers_list": [["SERVER", "x"]]}},
            {"address": "1.2.3.4:443", "network": "tcp", "request": {"url": "https://h.example/", "method": "GET"}, "response": {"code": 302, "headers_list": [["location", "https://h.example/b"]]}},
        ],
        "control": {"dns": {"addrs": ["1.2.3.4", "1.2.3.9"]}, "tcp_connect": {"1.2.3.4:443": {"status": True}}, "tls_handshake": {"1.2.3.4:443": {"status": True}, "1.2.3.7:443": {"status": False, "failure": "ssl_x"}}},
    },
}


@pytest.fixture(scope="module")
def msmts(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "20240101_IT_webconnectivity.n0.0.jsonl.gz"
    with gzip.open(path, "wt") as f:
        f.write(json.dumps(MSMT) + "\n{broken\n")
    return IO.read_jsonl(spark, str(path)).cache()


def test_reading_keeps_bad_lines_apart(msmts):
    assert msmts.count() == 2 and msmts.filter("_corrupt_record IS NOT NULL").count() == 1
    assert L.gate(msmts, ("IT",)).count() == 1 and L.gate(msmts, ("DE",)).count() == 0


def test_flattening(msmts):
    m = L.gate(msmts)
    dns = L.explode_dns(m).orderBy("query_pos", "answer_pos").collect()
    assert [(r.answer, r.answer_asn, r.failure) for r in dns] == [("1.2.3.4", 5, None), ("1.2.3.5", 0, None), (None, 0, "dns_nxdomain_error")]
    assert [r.ip for r in L.explode_tcp(m).orderBy("pos").collect()] == ["1.2.3.4", "scrubbed"]
    t = L.explode_tls(m).first()
    assert (t.ip, t.port, t.is_certificate_valid, t.chain_length, len(t.chain_fingerprints)) == ("1.2.3.4", 443, True, 2, 1)
    assert (t.handshake.read_count, t.handshake.write_bytes, t.handshake.last_operation, t.handshake.time) == (1, 10, "read_1", 3.0)
    h = L.explode_http(m).orderBy("pos").collect()
    assert (h[0].network, h[0].redirect_from, h[0].server, h[0].runtime, h[0].body_length) == ("udp", "https://h.example/", "x", 2.0, 2)
    assert h[1].redirect_from is None and h[1].location == "https://h.example/b"
    p = L.probe_meta(m).first()
    assert (p.probe_asn, p.platform, p.origin, p.resolver_ip, p.resolver_asn, p.resolver_is_scrubbed, p.probe_id) == (137, "linux", "unknown", "", 15, True, "")
    c = L.control_of(m).orderBy("observation_idx").collect()
    assert [(r.ip, r.tcp_success, r.tls_success, r.dns_success) for r in c] == [("1.2.3.4", True, True, True), ("1.2.3.7", None, False, None), ("1.2.3.9", None, None, True)]


def test_pairing_by_transaction(spark, msmts):
    side = lambda ps: [{"pos": p, "ip": ip, "transaction_id": t} for p, ip, t in ps]
    got = L.pair_record({"dns": side([(0, "a", 0), (1, "b", 7)]), "tcp": side([(0, "a", 7), (1, "a", 2), (2, "c", 0)]), "tls": side([(0, "c", 0)]), "http": side([(0, None, None)])})
    # the second DNS row takes its TCP row by id out of turn only if the first has not taken it by address
    assert got == [(0, 0, None, None), (1, None, None, None), (None, 1, None, None), (None, 2, 0, None), (None, None, None, 0)]
    out = B.observations(msmts, ("web_connectivity",)).select("dns_query_pos", "dns_answer_pos", "tcp_pos", "tls_pos", "http_pos", "observation_idx")
    assert [tuple(r) for r in out.orderBy("observation_idx").collect()] == [
        (0, 0, 0, 0, 0, 1), (0, 1, None, None, None, 2), (1, None, None, None, None, 3), (None, None, 1, None, None, 4), (None, None, None, None, 1, 5),
    ]


def test_other_tests_flatten(spark, msmts):
    hirl = spark.createDataFrame([("a", ["abcd / HTTP/1.1"] * 5, ["x"] + ["abcd / HTTP/1.1"] * 4), ("b", [], []), ("c", ["q"] * 5, ["q"] * 2)], "measurement_uid string, sent array<string>, received array<string>")
    got = {r.measurement_uid: (r.hirl_failure, r.hirl_received_0) for r in L.request_line_check(hirl).collect()}
    assert got == {"a": (None, "x"), "b": ("missing_sent", None), "c": ("missing_received_2", None)}
    assert L.header_field_check(L.gate(msmts)).first().hfm_failure == "malformed_request"
    with pytest.raises(ValueError):
        B.observations(msmts, ("nothing",))


def test_observations_of_every_test(spark, msmts):
    """The branches of all tests give rows of one shape; other tests give nothing."""
    one = B.observations(msmts, ("web_connectivity",)).orderBy("observation_idx").collect()
    assert [(r.ip, r.port, r.hostname, r.transaction_id) for r in one[:2]] == [("1.2.3.4", 443, "h.example", 1), ("1.2.3.5", None, "h.example", None)]
    assert (one[0].tls_handshake_last_operation, one[0].http_status_code, one[0].platform, one[0].resolver_is_scrubbed) == ("read_1", 200, "linux", True)
    assert B.observations(msmts, ("browser_web", "stunreachability")).count() == 0 and set(B.BRANCHES) == set(TEST_NAMES)
    chat = B.observations(msmts.withColumn("test_name", F.lit("telegram")), ("telegram",)).filter("target_id IS NOT NULL").collect()
    assert {r.target_id for r in chat} <= {"telegram/dc_pool"} and B.observations(msmts, ("web_connectivity",), probe_cc=("DE",)).count() == 0
    assert L.control_of(L.gate(msmts).withColumn("test_keys", F.expr("""named_struct('control', named_struct('dns', test_keys.control.dns, 'tcp_connect', test_keys.control.tcp_connect,
        'tls_handshake', test_keys.control.tls_handshake, 'http_request', named_struct('failure', CAST(NULL AS STRING), 'body_length', 7L)))"""))).filter("http_success AND http_response_body_length = 7").count() == 1


def raw(spark, test, keys, **more):
    """A measurement as a line of JSON, read back."""
    row = {"measurement_uid": "u", "measurement_start_time": "2024-01-01 00:00:00", "test_name": test, "test_keys": keys} | more
    lines = spark.createDataFrame([(json.dumps(row),)], "value string")
    return lines.select(F.from_json("value", MEASUREMENT).alias("m")).select("m.*")


def test_measurements_are_flattened_in_the_row(spark):
    """No shuffle, one scan for all tests, and Python for the pairing alone."""
    plan = B.observations(raw(spark, "tor", {}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_many_answers_stay_apart(spark):
    """5 000 answers of one query, then one of another, and a connection that no answer names."""
    address = lambda i: f"20.{i >> 16}.{i >> 8 & 255}.{i & 255}"
    queries = [{"hostname": "h", "answers": [{"ipv4": address(i)} for i in range(5000)]}, {"hostname": "g", "answers": [{"ipv4": "30.0.0.1"}]}]
    ends = [{"ip": address(i), "port": 443, "status": {"success": True}} for i in range(4999, -1, -1)] + [{"ip": "40.0.0.1", "port": 1, "status": {"success": False}}]
    got = B.observations(raw(spark, "urlgetter", {"queries": queries, "tcp_connect": ends})).orderBy("observation_idx").collect()
    assert [r.observation_idx for r in got] == list(range(1, 5003))
    assert all((r.dns_answer, r.tcp_ip, r.tcp_pos) == (address(i), address(i), 4999 - i) for i, r in enumerate(got[:5000]))
    assert [(r.hostname, r.ip, r.port) for r in got[5000:]] == [("g", "30.0.0.1", None), (None, "40.0.0.1", 1)]


def test_targets_and_lookups_are_numbered_on(spark):
    tcp = lambda ip: [{"ip": ip, "port": 9, "status": {"success": True}}]
    tor = B.observations(raw(spark, "tor", {"targets": {"b": {"tcp_connect": tcp("1.1.1.1") + tcp("1.1.1.2")}, "a": {"tcp_connect": tcp("1.1.1.1")}}}))
    assert [(r.observation_idx, r.target_id, r.ip) for r in tor.orderBy("observation_idx").collect()] == [(1, "b", "1.1.1.1"), (2, "b", "1.1.1.2"), (3, "a", "1.1.1.1")]
    keys = {"bootstrap": {"queries": [{"hostname": "d", "answers": [{"ipv4": "2.2.2.2"}]}]}, "lookups": {"x": {"tcp_connect": tcp("2.2.2.2"), "queries": [{"hostname": "e", "failure": "dns_nxdomain_error"}]}}}
    check = B.observations(raw(spark, "dnscheck", keys)).orderBy("observation_idx").collect()
    assert [(r.observation_idx, r.hostname, r.ip, r.dns_failure, r.tcp_ip) for r in check] == [(1, "d", "2.2.2.2", None, None), (2, "e", None, "dns_nxdomain_error", None), (3, None, "2.2.2.2", None, "2.2.2.2")]


def test_encrypted_hello_checks(spark):
    shake = lambda name, t: {"address": "5.5.5.5:443", "server_name": name, "t": t}
    two = B.observations(raw(spark, "echcheck", {"control": shake("c", 1.0), "target": shake("s", 2.0)})).orderBy("observation_idx").collect()
    assert [(r.tls_server_name, r.tls_echconfig, r.ip, r.hostname) for r in two] == [("c", "", "5.5.5.5", "c"), ("s", "GREASE", "5.5.5.5", "s")]
    listed = B.observations(raw(spark, "echcheck", {"control": shake("c", 1.0), "target": shake("s", 2.0), "tls_handshakes": [shake("l", 3.0)]})).collect()
    assert [r.tls_server_name for r in listed] == ["l"]


def test_single_row_tests(spark):
    browser = B.observations(raw(spark, "browser_web", {"failure": "unknown_failure: read: connection refused"}, test_runtime=2.5)).first()
    assert (browser.observation_idx, browser.http_failure, browser.http_runtime, browser.ip, browser.target_id) == (1, "connection_refused", 2.5, None, None)
    header = B.observations(raw(spark, "http_header_field_manipulation", {"requests": []})).first()
    assert (header.hfm_failure, header.hfm_success, header.hirl_success) == ("missing_requests", False, None)
    line = B.observations(raw(spark, "http_invalid_request_line", {"sent": ["abcd / HTTP/1.1"] * 5, "received": ["x"] + ["abcd / HTTP/1.1"] * 4})).first()
    assert (line.hirl_success, line.hirl_received_0, line.hfm_success) == (True, "x", None)


def test_names_of_addresses_that_the_control_resolved(spark):
    tcp = [{"ip": ip, "port": 443, "status": {"success": True}} for ip in ("6.6.6.6", "7.7.7.7")]
    keys = {"tcp_connect": tcp, "blocking": False, "control": {"dns": {"addrs": ["6.6.6.6"]}}}
    got = B.observations(raw(spark, "web_connectivity", keys, input="https://Site.example/")).orderBy("observation_idx").collect()
    assert [(r.ip, r.hostname, r.probe_analysis) for r in got] == [("6.6.6.6", "site.example", "false"), ("7.7.7.7", None, "false")]


def test_names_and_ids_come_in_the_specified_order(spark):
    rows = [("u.example", "s.example", 5, 7, 0, 0), (None, "s.example", 5, 0, 0, 9), (None, "8.8.8.8", 5, 0, 3, 9), (None, "", 5, None, None, None)]
    df = spark.createDataFrame(rows, "u string, tls_server_name string, dns_transaction_id long, tcp_transaction_id long, tls_transaction_id long, http_transaction_id long")
    df = df.select("*", F.concat(F.lit("https://"), "u", F.lit("/")).alias("http_request_url"), *[F.lit(None).cast("string").alias(c) for c in ("dns_answer", "dns_hostname", "tcp_ip", "tls_ip", "http_ip")], *[F.lit(None).cast("int").alias(c) for c in ("tcp_port", "tls_port", "http_port")])
    assert [(r.hostname, r.transaction_id) for r in L.assemble(df).collect()] == [("u.example", 7), ("s.example", 9), (None, 3), (None, None)]


def test_control_results_without_a_failure_are_successes(spark):
    control = {"dns": {"failure": "dns_name_error", "addrs": ["1.1.1.1", "9.9.9.9", "2.2.2.2"]}, "tcp_connect": {"1.1.1.1:443": {"failure": None}, "3.3.3.3:80": {"status": True, "failure": "unknown_failure: timed out"}},
               "tls_handshake": {"1.1.1.1:443": {"failure": None, "server_name": "n"}}, "http_request": {"failure": None, "body_length": 7}}
    made = lambda **k: L.control_of(raw(spark, "web_connectivity", {"control": control} | k.pop("keys", {}), **({"input": "https://a.example/x"} | k)))
    got = made().orderBy("observation_idx").collect()
    assert [(r.observation_idx, r.ip, r.port, r.dns_failure, r.dns_success, r.tcp_failure, r.tcp_success, r.tls_success, r.tls_server_name, r.http_success) for r in got] == [
        (0, None, None, "dns_name_error", None, None, None, None, None, None), (1, "1.1.1.1", 443, None, True, None, True, True, "n", None),
        (2, "3.3.3.3", 80, None, None, "unknown_failure: timed out", False, None, None, None), (3, "2.2.2.2", None, None, True, None, None, None, None, None),
        (4, "9.9.9.9", None, None, True, None, None, None, None, None), (5, None, None, None, None, None, None, None, None, True),
    ]
    assert {r.hostname for r in got} == {"a.example"} and got[0].measurement_start_time == datetime(2024, 1, 1)
    assert made(keys={"control_failure": "timeout"}).count() == 0 and made(input="no host").count() == 0 and made(keys={"control": None}).count() == 0


def test_enrichment_of_both_families(spark):
    rows = spark.createDataFrame([(a, DAY) for a in ("8.8.8.8", "10.0.0.1", "2606:4700::1", "2606:4700:5::1", "2a00::1", "x", None)], "ip string, measurement_start_time timestamp")
    number = int.from_bytes(bytes([8, 8, 8, 0]), "big")
    ranges = spark.createDataFrame([(DAY, number, number + 255, 24, 15169, "G", "US", "US")], "snapshot timestamp, first long, last long, prefix_len int, asn long, org string, as_cc string, cc string")
    bits = f"{0x26064700:032b}"
    prefixes = spark.createDataFrame([(DAY, bits, 13335, "C", "US", "US"), (DAY, bits + f"{5:016b}", 5, "D", "DE", "DE")], "snapshot timestamp, prefix string, asn long, org string, as_cc string, cc string")
    got = {r.ip: (r.asn, r.as_cc, r.cc) for r in E.enrich_address(rows, ranges, prefixes).collect()}
    assert got == {"8.8.8.8": (15169, "US", "US"), "10.0.0.1": (64666, "ZZ", "ZZ"), "2606:4700::1": (13335, "US", "US"), "2606:4700:5::1": (5, "DE", "DE"), "2a00::1": (0, "", "ZZ"), "x": (0, "", "ZZ"), None: (0, "", "ZZ")}


def test_snapshots_of_many_dates(spark):
    """50 000 snapshot dates; a day before all of them takes the oldest."""
    dates = spark.range(50_000).select(F.date_add(F.lit("1900-01-03").cast("date"), (F.col("id") * 2).cast("int")).alias("snapshot"))
    days = [datetime(1899, 1, 1, 7), datetime(1900, 1, 3, 1), datetime(1900, 1, 4, 23), datetime(2024, 5, 5, 5), datetime(2400, 1, 1)]
    got = {r.day: r.snapshot for r in E.asof_snapshot(spark.createDataFrame([(x,) for x in days], "day timestamp"), dates, "day").collect()}
    first = datetime(1900, 1, 3)
    want = lambda x: (first + timedelta(days=max(0, min(49_999, (x - first).days // 2)) * 2)).date()
    assert got == {x: want(x) for x in days}


def test_ranges_of_any_shape(spark):
    """Nested, crossing, repeated and adjoining ranges of both families, beside a try of every range."""
    import ipaddress
    import random

    rng = random.Random(6)
    four = [(DAY, lo, min(lo + rng.choice([0, 1, 255, 70_000, 1 << 21]), (1 << 32) - 1), rng.randrange(8, 33)) for lo in (rng.choice([8 << 24, 9 << 24, 223 << 24]) + rng.randrange(1 << 20) for _ in range(60))]
    four += [(DAY, 0, (1 << 32) - 1, 0), (DAY, 9 << 24, (10 << 24) - 1, 8), (DAY, (9 << 24) + 5, (9 << 24) + 5, 32), (DAY, (9 << 24) + 5, (9 << 24) + 5, 32)]
    six = [(DAY, f"{int(ipaddress.ip_address('2a00::')) | rng.randrange(1 << 6) << 90:0128b}"[: rng.randrange(12, 50)]) for _ in range(60)] + [(DAY, "001")]
    named = lambda rows, at: [(*r, at + i, f"o{i}", "A", "C") for i, r in enumerate(rows)]
    ranges = spark.createDataFrame(named(four, 1), "snapshot timestamp, first long, last long, prefix_len int, asn long, org string, as_cc string, cc string")
    prefixes = spark.createDataFrame(named(six, 1000), "snapshot timestamp, prefix string, asn long, org string, as_cc string, cc string")
    ips = [str(ipaddress.ip_address(max(0, min(x + d, (1 << 32) - 1)))) for _, lo, hi, _ in four for x in (lo, hi) for d in (-1, 0, 1)]
    ips += [str(ipaddress.ip_address(int(p.ljust(128, fill), 2))) for _, p in six for fill in "01"]
    got = {r.ip: r.asn for r in E.enrich_address(spark.createDataFrame([(x, DAY) for x in ips], "ip string, measurement_start_time timestamp"), ranges, prefixes).collect()}

    def want(ip):
        n = ipaddress.ip_address(ip)
        if n.version == 4:
            met = [(-w, lo, str({"asn": a, "org": o}), a) for _, lo, hi, w, a, o, _, _ in named(four, 1) if lo <= int(n) <= hi]
        else:
            met = [(-len(p), "", str({"asn": a}), a) for _, p, a, *_ in named(six, 1000) if f"{int(n):0128b}".startswith(p)]
        return min(met)[-1] if met else 0

    bogon = {r.ip for r in spark.createDataFrame([(x,) for x in set(ips)], "ip string").filter(S.is_bogon(F.col("ip"))).collect()}
    assert got == {x: 64666 if x in bogon else want(x) for x in ips} and len(bogon) < len(set(ips)) - 50


def test_reads_are_pruned_by_day(spark, tmp_path):
    df = spark.createDataFrame([(k, DAY + timedelta(days=k)) for k in range(40)], "k int, measurement_start_time timestamp")
    IO.write_partitioned(df, f"{tmp_path}/p")
    got = IO.read_partitioned(spark, f"{tmp_path}/p", DAY + timedelta(days=29), DAY + timedelta(days=33))
    assert sorted(r.k for r in got.collect()) == [30, 31, 32, 33]
    assert got.select(F.input_file_name()).distinct().count() == 4 and "PartitionFilters: [isnotnull(bucket" in got._jdf.queryExecution().toString()


def test_as_of_join(spark):
    days = lambda *n: [DAY + timedelta(days=k) for k in n]
    history = spark.createDataFrame([("a", d, v) for d, v in zip(days(0, 10, 95), ("x", "y", "z"))], "k string, changed timestamp, v string")
    rows = spark.createDataFrame([(i, "a", d) for i, d in enumerate(days(-5, 0, 9, 10, 94, 95, 400))] + [(7, "b", DAY), (8, "a", DAY), (9, None, DAY)], "i int, k string, day timestamp")
    got = {r.i: r.v for r in E.asof_join(rows, history, "k", "day", "changed", ["v"]).collect()}
    assert got == {0: "x", 1: "x", 2: "x", 3: "y", 4: "y", 5: "z", 6: "z", 7: None, 8: "x", 9: None}


def test_archives(spark, tmp_path):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        for name, body in (("x/u9.post", {"format": "json", "content": {"input": "i", "probe_cc": "IT"}}), ("y.post", {"format": "yaml", "content": ""}), ("z.txt", {})):
            data = json.dumps(body).encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    (tmp_path / "a.tar.gz").write_bytes(buf.getvalue())
    rows = IO.parse_posts(IO.read_post_archives(spark, f"{tmp_path}/*.tar.gz")).collect()
    assert [(r.measurement_uid, r.input, r.probe_cc) for r in rows] == [("u9", "i", "IT")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "k int, measurement_start_time timestamp")
    for _ in range(2):
        IO.write_partitioned(df, f"{tmp_path}/t")
    IO.write_partitioned(df.filter("k = 2"), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    IO.write_csv({"t": df}, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv/t").count() == 2
    with pytest.raises(ValueError):
        IO.refresh(df, f"{tmp_path}/ref", 10, 20)
    assert IO.refresh(df, f"{tmp_path}/ref", 1, 20) == 2 and spark.read.parquet(f"{tmp_path}/ref").count() == 2
    # the table is replaced while it is read from, and a count out of bounds leaves it as it is
    assert IO.refresh(spark.read.parquet(f"{tmp_path}/ref").filter("k = 2"), f"{tmp_path}/ref", 0, 20) == 1
    with pytest.raises(ValueError):
        IO.refresh(df, f"{tmp_path}/ref", 10, 20)
    assert [r.k for r in spark.read.parquet(f"{tmp_path}/ref").collect()] == [2] and not (tmp_path / "ref__old").exists()
    raw = spark.createDataFrame([("t", "2024-01-01", "IT", "{}"), ("t", "2024-01-02", "IT", "{}")], "test string, day string, cc string, body string")
    IO.repartition_raw(raw.filter("day = '2024-01-01'"), f"{tmp_path}/raw")
    IO.repartition_raw(raw, f"{tmp_path}/raw", raw.filter("day = '2024-01-01'"))
    assert spark.read.json(f"{tmp_path}/raw").count() == 2
    (tmp_path / "it.csv").write_text("url,category_code\nhttps://a.example/x,NEWS\n")
    assert [(r.domain, r.cc) for r in IO.read_test_lists(spark, f"{tmp_path}/*.csv").collect()] == [("a.example", "IT")]


def test_quality(spark):
    a, b = spark.createDataFrame([("x", "int"), ("y", "int"), ("z", "int")], "name string, type string"), spark.createDataFrame([("x", "int"), ("y", "string"), ("w", "int")], "name string, type string")
    assert {(r.name, r.change) for r in Q.schema_drift(a, b).collect()} == {("y", "type changed"), ("z", "missing"), ("w", "extra")}
    fp = spark.createDataFrame([("full", "IT, DE"), ("glob", "IT"), ("full", "Italy")], "pattern_type string, expected_countries string")
    assert Q.unsupported_patterns(fp).count() == 1 and Q.bad_countries(fp).count() == 1


def test_enrichment(spark):
    rows = spark.createDataFrame([(5, DAY), (0, DAY), (64600, DAY), (9, DAY)], "probe_asn long, measurement_start_time timestamp")
    meta = E.asn_flatten(spark.createDataFrame([('{"5": [["Old","IT","20200101","n1","s"],["New","FR","20230101","n2","s"],["Later","ES","20250101","n3","s"]]}',)], "value string"))
    got = {r.probe_asn: (r.org_name, r.cc, r.aut_name) for r in E.enrich_asn(rows, meta).collect()}
    assert got == {5: ("New", "FR", "n2"), 0: ("Unknown", "ZZ", "Unknown"), 64600: ("Private use (RFC1930)", "ZZ", "Private use (RFC1930)"), 9: ("", "", "")}


def test_patterns_beyond_one_block(spark):
    """Patterns met in several blocks match as they do in one; too many snapshot dates are an error."""
    texts = spark.createDataFrame([(k, f"page {k} of host{k % 7}.example", f"v{k % 3}") for k in range(40)], "id int, body string, server string")
    kinds = ("full", "prefix", "contains", "regexp")
    rows = [(f"n{k}", "nat", "body", kinds[k % 4], [f"page {k} of host{k % 7}.example", f"page {k} ", f"host{k % 7}.", f"^page {k % 5}\\b"][k % 4]) for k in range(40)]
    rows += [(f"h{k}", "isp", "header.server", "regexp", f"^v{k}$") for k in range(5)]
    patterns = spark.createDataFrame(rows, "name string, scope string, location_found string, pattern_type string, pattern string")
    one, many = (sorted(map(tuple, E.match_fingerprints(texts, patterns, "body", "id", {"server": "server"}, n).collect())) for n in (10_000, 4))
    assert one == many and {x[1][0] for x in one} == {"n", "h"}
    hosts = spark.createDataFrame([("pattern", f"^host{k}\\.", f"t{k}") for k in range(7)] + [("exact", "host3.example", "x")], "kind string, value string, target string")
    names = texts.select("id", F.regexp_extract("body", r"\S+$", 0).alias("hostname"))
    rules = spark.createDataFrame([("example", "exact")], "rule string, kind string")
    one, many = (sorted(map(tuple, E.resolve_targets(names, hosts, rules, max_patterns=n).collect())) for n in (10_000, 2))
    assert one == many and {x[-1] for x in one} == {"x", *(f"t{k}" for k in range(7) if k != 3)}


def test_extras(spark):
    df = spark.createDataFrame([("a.b.c", "a.b.d"), ("x", "x")], "t string, g string")
    r = X.hierarchical_scores(df, "t", "g").first()
    assert (r.precision, r.recall) == (3 / 4, 3 / 4)
    ev = spark.createDataFrame([(["dns.x", "tcp.y", "dns.z"], None, 12)], "labels array<string>, ended timestamp, n_networks int")
    e = X.event_fields(ev).first()
    assert (e.ongoing, e.layers, e.size_band) == (True, ["dns", "tcp"], "national")
    cells = [("blocked", "bogon_not_in_ctrl", 10), ("blocked", "failure_ctrl_ok", 10), ("unknown", "dns_system_failure_no_ctrl", 9), ("unknown", "none", 9), ("down", "bogon_in_ctrl", 3), ("ok", "connect_ok", 3), ("ok", "connect_ok", 2), (None, None, None)]
    v = spark.createDataFrame(cells, "outcome string, rule_id string, total int")
    assert [r.state for r in X.presentation(v).collect()] == ["blocked", "likely_blocked", "impaired", "insufficient", "down", "ok", "insufficient", "insufficient"]
    now = datetime(2024, 3, 5, 17, 30)
    assert S.time_window(now=now) == (datetime(2024, 2, 4), datetime(2024, 3, 5)) and S.time_window(DAY, now=now)[0] == DAY
    hashes = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 7, 1), (4, 1 << 20, 1 << 5)], "doc_id long, simhash_high long, simhash_low long")
    assert {(r.a, r.b) for r in T.near_by_simhash(hashes).collect()} == {(1, 2), (2, 3), (1, 4), (2, 4)}


def test_outcome_ties_and_paging(spark):
    v = spark.createDataFrame([("u", DAY, 1, 1, "x", None, None, 0.1, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0)], "measurement_uid string, measurement_start_time timestamp, probe_asn long, resolver_asn long, top_dns_failure string, top_tcp_failure string, top_tls_failure string, dns_blocked double, dns_down double, dns_ok double, tcp_blocked double, tcp_down double, tcp_ok double, tls_blocked double, tls_down double, tls_ok double")
    r = A.outcome_aggregation(v).first()
    assert (r.outcome_label, r.outcome_value, r.confirmed_count) == ("dns_isp.blocked.x", 1.0, 1)


@pytest.mark.parametrize(
    "kind, pattern, literal",
    [
        ("contains", "abc", "abc"), ("prefix", "ab", None), ("regexp", "abc.*defg", "defg"), ("regexp", "abcd?e", "abc"), ("regexp", "ab|cdef", None), ("regexp", "(abcdef)?xyz", "xyz"),
        ("regexp", "[abc]def{2}", None), ("regexp", r"a\.bc+", "a.bc"), ("regexp", r"\x41bcd", None), ("regexp", r"\bword\b", "word"), ("regexp", "(?i)abc", None), ("regexp", "[]abc]defg", None),
        ("regexp", "[^]abc]defg", None), ("regexp", "^start$", "start"), ("regexp", "a{3}bcd", "bcd"), ("regexp", "", None),
    ],
)
def test_literals_that_every_match_holds(kind, pattern, literal):
    assert E.required_literal(kind, pattern) == literal


def test_many_patterns_meet_texts_by_their_literals(spark):
    """5 000 patterns equal a try of each, and none that has a literal meets every text."""
    import random

    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 6)))
    texts = [(i, " ".join(word() for _ in range(60))) for i in range(200)] + [(900, None), (901, "")]
    rows = []
    for i in range(5000):
        kind = ("contains", "prefix", "regexp")[i % 3]
        a, b = word(), word()
        pattern = {"contains": f"{a} {b}", "prefix": f"{a} {b}", "regexp": f"{a}[a-c]? {b}+"}[kind]
        rows.append((f"n{i}", "nat", "body", kind, pattern))
    patterns = spark.createDataFrame(rows, "name string, scope string, location_found string, pattern_type string, pattern string")
    df = spark.createDataFrame(texts, "id long, text string")
    got = E.match_fingerprints(df, patterns, "text", "id", max_patterns=2000)
    import re

    test = {"contains": lambda p, t: p in t, "prefix": lambda p, t: t.startswith(p), "regexp": lambda p, t: re.search(p, t, re.S)}
    want = sorted((i, n) for i, t in texts if t is not None for n, _, _, kind, p in rows if test[kind](p, t))
    assert sorted((r.id, r.name) for r in got.collect()) == want
    long = patterns.filter(F.length("pattern") > 6).filter("pattern_type <> 'regexp'")
    assert "NestedLoop" not in E.match_fingerprints(df, long, "text", "id")._jdf.queryExecution().executedPlan().toString()


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    """A day with most rows becomes several files; a rerun leaves the same rows."""
    rows = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("x"), (F.lit(DAY) + F.when(F.col("id") % 10 < 8, F.expr("INTERVAL 0 DAYS")).otherwise(F.make_dt_interval((F.col("id") % 7).cast("int")))).alias("measurement_start_time"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        for _ in range(2):
            IO.write_partitioned(rows, f"{tmp_path}/days")
            IO.repartition_raw(rows.select(F.lit("t").alias("test"), F.date_format("measurement_start_time", "yyyy-MM-dd").alias("day"), F.lit("IT").alias("cc"), "x"), f"{tmp_path}/raw{_}")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = list((tmp_path / "days").glob("**/bucket_date=2024-01-01/*.parquet"))
    assert len(files) >= 4 and len(list((tmp_path / "raw0").glob("**/day=2024-01-01/**/*.json.gz"))) >= 4
    assert spark.read.parquet(f"{tmp_path}/days").count() == 200_000 and spark.read.json(f"{tmp_path}/raw1").count() == 200_000


def test_versions_are_published_whole_or_not_at_all(spark, tmp_path):
    from netquill.sources import versions as VS

    root = f"{tmp_path}/ref"
    table = lambda n: spark.range(n)
    assert VS.read(spark, root, "table") is None
    assert VS.refresh(table(5), root, "a", 1, 10) == 5
    held = VS.read(spark, root, "table")
    with pytest.raises(ValueError):
        VS.refresh(table(50), root, "b", 1, 10)
    assert VS.current(spark, root) == "a" and VS.read(spark, root, "table").count() == 5
    assert VS.refresh(table(7), root, "c", 1, 10) == 7 and VS.refresh(table(9), root, "c", 1, 10) == 7
    assert VS.committed(spark, root) == ["a", "c"] and VS.read(spark, root, "table").count() == 7
    assert held.count() == 5  # a frame stays on the version it was read from
    with pytest.raises(RuntimeError):
        VS.publish(spark, root, "d", "a")
    (tmp_path / "ref/log/000000000002").write_text("half")  # an entry that is still being written
    assert VS.current(spark, root) == "c"


def test_a_reader_meets_no_gap_while_a_table_is_refreshed(spark, tmp_path):
    import threading

    from netquill.sources import versions as VS

    root, seen, failed, done = f"{tmp_path}/live", set(), [], threading.Event()
    VS.refresh(spark.range(1), root, "v1", 0, 100)

    def watch():
        while not done.is_set():
            try:
                seen.add(VS.read(spark, root, "table").count())
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=watch)
    reader.start()
    for n in range(2, 6):
        VS.refresh(spark.range(n), root, f"v{n}", 0, 100)
    done.set()
    reader.join()
    assert not failed and seen <= set(range(1, 6)) and VS.read(spark, root, "table").count() == 5


def test_the_detector_s_store_is_replayed_and_cleared(spark, tmp_path):
    from netquill.operators import detector_store as DS
    from netquill.sources import versions as VS

    values = [0.0] * 30 + [1.0] * 30 + [0.0] * 40
    hour = lambda n: DAY + timedelta(hours=n)
    rows = lambda df: sorted(map(repr, df.collect()))
    changes = lambda df: sorted((r.signal, r.ts, r.change_dir, r.s_pos) for r in df.collect())
    whole = D.detect_changes(points(spark, values))[0]
    root = f"{tmp_path}/store"
    DS.run_detector(points(spark, values[:50]), root, "a")
    late = points(spark, values[50:], hour(50))
    # a run that fails between its two tables leaves the version before it
    VS.stage(whole.limit(0), root, "b", "changes")
    assert VS.current(spark, root) == "a"
    one = DS.run_detector(late, root, "b")
    two = DS.run_detector(late, root, "b")
    assert [rows(x) for x in one] == [rows(x) for x in two] and VS.committed(spark, root) == ["a", "b"]
    assert changes(DS.load(spark, root)[0]) == changes(whole) and len(changes(whole)) > 1
    # keys without new points keep their state
    other = late.withColumn("domain", F.lit("elsewhere"))
    state = DS.run_detector(other, root, "c")[1]
    assert {r.domain for r in state.select("domain").distinct().collect()} == {"d", "elsewhere"}
    cleared, left = DS.clear(spark, root, "d", hour(40), hour(200))
    assert all(c[1] < hour(40) for c in changes(cleared)) and left.count() == 0
    assert rows(DS.clear(spark, root, "d", hour(0), hour(1))[0]) == rows(cleared)
    with pytest.raises(ValueError):
        DS.clear(spark, f"{tmp_path}/none", "x", DAY, DAY)


def test_unreadable_input_is_counted_and_kept(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"measurement_uid":"a","test_keys":{"failure":"x"}}\n{broken\n{"measurement_uid":"b"}\n')
    good, counters = IO.read_counted(spark, f"{tmp_path}/in.jsonl", f"{tmp_path}/lost", name="one")
    assert [r.measurement_uid for r in good.collect()] == ["a"] and counters.get == {"rows": 3, "unreadable": 1, "empty": 1}
    lost = spark.read.parquet(f"{tmp_path}/lost").collect()
    assert sorted((r.reason, r.line) for r in lost) == [("empty", None), ("unreadable", "{broken")] and all(r.file.endswith("in.jsonl") for r in lost)


def test_late_hours_within_the_watermark_are_ordered(spark, tmp_path):
    """Hours out of order over batches, and a stored state to begin from, give the changes of the batch detector."""
    import random

    from netquill.streaming.twins import detector_stream

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        values = [0.0] * 30 + [1.0] * 25 + [0.0] * 25
        pts = D.long_form(points(spark, values)).withColumn("probe_asn", F.col("probe_asn").cast("long"))
        start = DAY + timedelta(hours=20)
        state = D.detect_changes(points(spark, values[:20]))[1].withColumn("probe_asn", F.col("probe_asn").cast("long"))
        rows = [r for r in pts.filter(F.col("ts") >= F.lit(start)).collect()]
        end = DAY + timedelta(hours=500)  # closes the hours before it
        rng = random.Random(1)
        hours = sorted({r.ts for r in rows}, key=lambda t: t.timestamp() + rng.uniform(0, 4) * 3600)
        for k in range(4):
            batch = set(hours[k * len(hours) // 4 : (k + 1) * len(hours) // 4])
            own = [r for r in rows if r.ts in batch]
            if k == 3:
                own += [("IT", 1, "end", end, "tcp_blocked", 0.0, 1.0)]
            spark.createDataFrame(own, pts.schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        stream = spark.readStream.schema(pts.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        found = detector_stream(stream, state, watermark="6 hours").writeStream.format("memory").queryName("late_hours").outputMode("append")
        q = found.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        assert q.awaitTermination(200) and q.exception() is None
        want = D.detect_changes(points(spark, values))[0].filter(F.col("ts") >= F.lit(start)).select("signal", "ts", "change_dir", "s_pos")
        key = lambda df: sorted((r.signal, r.ts, r.change_dir, round(r.s_pos, 9)) for r in df.collect())
        assert key(spark.table("late_hours")) == key(want) and want.count() > 1
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_an_archive_is_read_as_a_stream(spark, tmp_path):
    """40 MB of posts in one archive take a few MB at a time, and archives are partitions of their own."""
    import os
    import tracemalloc

    from netquill.sources import archives as AR

    for name, n in (("big", 80), ("small", 3)):
        with tarfile.open(tmp_path / f"{name}.tar.gz", "w:gz", compresslevel=1) as tar:
            for i in range(n):
                data = json.dumps({"format": "json", "content": {"input": os.urandom(250_000).hex()}}).encode()
                info = tarfile.TarInfo(f"{name}{i}.post")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
    tracemalloc.start()
    seen = sum(b.num_rows for b in AR.PostReader([]).read(AR.InputPartition(f"file:{tmp_path}/big.tar.gz")))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 80 and peak < 16 << 20
    rows = IO.read_post_archives(spark, f"{tmp_path}/*.tar.gz")
    assert rows.rdd.getNumPartitions() == 2 and rows.select("measurement_uid").distinct().count() == 83


def test_only_chosen_files_are_read(spark, tmp_path):
    named = ["20240101_05_IT_webconnectivity.n0.0", "20240101_05_DE_webconnectivity.n0.0", "20240101_06_IT_tor.n0.0", "20240102_07_webconnectivity.n0.0", "20240103_05_IT_webconnectivity.n0.0"]
    for i, name in enumerate(named):
        (tmp_path / f"raw/{i % 2}").mkdir(parents=True, exist_ok=True)
        with gzip.open(tmp_path / f"raw/{i % 2}/{name}.jsonl.gz", "wt") as f:
            for cc in ("IT", "DE"):
                if f"_{'DE' if cc == 'IT' else 'IT'}_" not in name:
                    f.write(json.dumps({"measurement_uid": f"{name} {cc}", "probe_cc": cc, "test_keys": {}}) + "\n")
    index = IO.file_index(spark, f"{tmp_path}/raw").collect()
    assert len(index) == 5 and all(r.size > 0 for r in index)
    got = IO.read_selected(spark, f"{tmp_path}/raw", datetime(2024, 1, 1), datetime(2024, 1, 3), ("IT",), ("webconnectivity",))
    assert sorted(r.measurement_uid for r in got.collect()) == [f"{named[0]} IT", f"{named[3]} IT"]
    assert {r.f.rsplit("/", 1)[-1] for r in got.select(F.input_file_name().alias("f")).distinct().collect()} == {f"{named[k]}.jsonl.gz" for k in (0, 3)}
    assert IO.read_selected(spark, f"{tmp_path}/raw", datetime(2030, 1, 1)).count() == 0


def test_dense_hours_between_bounds(spark):
    rows = [("a", DAY), ("a", DAY + timedelta(hours=3)), ("b", datetime(1970, 1, 1)), ("b", DAY + timedelta(minutes=5))]
    df = spark.createDataFrame(rows, "k string, measurement_start_time timestamp")
    got = X.dense_hours(df, ["k"], start=DAY, end=DAY + timedelta(hours=4)).collect()
    assert sorted((r.k, (r.ts - DAY).seconds // 3600, r.n) for r in got) == [(k, h, int(h in on)) for k, on in (("a", (0, 3)), ("b", (0,))) for h in range(5)]


def test_observations_make_only_what_is_read(spark):
    """Columns of handshakes are made of rows, so a digest that nobody reads is not made; and no array is cast to
    the type it has."""
    from netquill.plans.q_raw import measurements, web_observations

    d = "/root/testdata/sf0.001"
    plan = web_observations(spark, d)._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2(" not in plan
    import re

    assert not re.search(r"cast\(\w+\([^)]*\) as array<struct", plan) and " as array<struct<hostname" not in plan
    kinds = measurements(spark, d).schema["test_keys"].dataType
    assert kinds["queries"].dataType.simpleString() == "array<" + schemas._QUERY + ">"
