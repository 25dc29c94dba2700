"""Small cases for the findings of the review: what is dealt, and how often."""

import json
import re
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from test_library import OK, ctrl, obs

from netquill.operators import flatten as L
from netquill.operators import observations as B
from netquill.operators import verdicts as V
from netquill.plans import registry
from netquill.schemas import MEASUREMENT


def hashed(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_observations_are_dealt_once(spark):
    """Small evidence goes to the observations: they are shuffled by measurement and by nothing else (F12, F13, F17)."""
    rows, control = obs(spark), ctrl(spark, OK)
    assert hashed(V.web_verdicts(rows, control)) == hashed(V.scored_rows(rows, control)) == 1


@pytest.mark.parametrize("most", [0, 1 << 19])
def test_large_evidence_gives_the_same_flags(spark, monkeypatch, most):
    """Evidence of more rows than are sent is joined by a shuffle, with the same flags; networks of failed answers
    and addresses that the control saw in several networks count once."""
    monkeypatch.setattr(V, "SMALL", most)
    rows = obs(spark).unionByName(obs(spark, observation_idx=2, ip="9.9.9.9", dns_answer="9.9.9.9", ip_asn=9, tls_is_certificate_valid=1))
    rows = rows.unionByName(obs(spark, observation_idx=3, hostname=None, report_id=None)).unionByName(obs(spark, observation_idx=4, ip=None, dns_answer=None, hostname="other"))
    control = ctrl(spark, OK, OK | {"ip_asn": 8}, {"ip": "9.9.9.9", "ip_asn": 9, "tcp_success": 0}, {"dns_failure": "x"}, {"ip": "1.2.3.4", "tls_success": 0, "tls_failure": "ssl_x"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = V.scored_rows(rows, control)
        assert (hashed(plan) == 1) == (most > 0)
        got = {r.observation_idx: r for r in plan.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 4
    names = ["dns_answer_count", "dns_tls_consistent", "dns_tls_inconsistent", "dns_answer_matches_ctrl", "dns_answer_asn_matches_ctrl", "ctrl_dns_success_rate", "ctrl_tls_success_count", "ctrl_tls_failing_count", "ctrl_tcp_failing_count", "ctrl_tcp_success_rate"]
    show = lambda i: tuple(got[i][n] for n in names)
    assert show(1) == (2, True, True, True, True, pytest.approx(2 / 3), 2, 1, 0, 1.0)
    assert show(2) == (2, True, True, True, True, pytest.approx(2 / 3), 0, 0, 1, 0.0)
    assert show(3) == (1, False, False, False, False, None, 0, 0, 0, None)
    assert show(4) == (0, False, False, False, False, None, 0, 0, 0, None)


def test_control_rows_meet_in_windows(spark):
    """Endpoints of either layer, an address that two endpoints share, answers no endpoint has, failures and the
    control's own request (F19)."""
    tcp = spark.createDataFrame([("m", "1.1.1.1:443", True, None), ("m", "1.1.1.1:80", False, "x"), ("n", "[2001::1]:443", True, None), ("o", None, True, None)], "measurement_uid string, endpoint string, tcp_success boolean, tcp_failure string")
    tls = spark.createDataFrame([("m", "1.1.1.1:443", False, "ssl_x", "s"), ("m", "3.3.3.3:443", True, None, "s"), ("o", None, True, None, "s")], "measurement_uid string, endpoint string, tls_success boolean, tls_failure string, tls_server_name string")
    dns = spark.createDataFrame([("m", "h", None, ["1.1.1.1", "2.2.2.2", "2.2.2.2"]), ("n", "i", "dns_x", None), ("p", "j", None, [])], "measurement_uid string, hostname string, failure string, addrs array<string>")
    http = spark.createDataFrame([("m", "u", None, 5)], "measurement_uid string, http_request_url string, http_failure string, http_response_body_length int")
    out = L.control_rows(tcp, tls, dns, http)
    names = ["measurement_uid", "observation_idx", "hostname", "ip", "port", "tcp_success", "tls_success", "dns_success", "dns_failure", "http_success"]
    got = sorted((tuple(r[n] for n in names) for r in out.collect()), key=str)
    assert [r for r in got if r[0] != "o"] == [
        ("m", 0, "h", "1.1.1.1", 80, False, None, True, None, None), ("m", 1, "h", "1.1.1.1", 443, True, False, True, None, None), ("m", 2, "h", "3.3.3.3", 443, None, True, None, None, None),
        ("m", 3, "h", "2.2.2.2", None, None, None, True, None, None), ("m", 4, "h", None, None, None, None, None, None, True),
        ("n", 0, "i", None, None, None, None, False, "dns_x", None), ("n", 1, "i", "2001::1", 443, True, None, None, None, None),
    ]
    # endpoints without a name match nothing, nor do they match each other
    assert sorted((r[5] is None, r[6] is None, r[7]) for r in got if r[0] == "o") == [(False, True, None), (True, False, None)]
    # endpoints, names with their answers, and both by measurement
    assert hashed(registry.queries()["ctrl_rows"](spark, "/root/testdata/sf0.001")) == 3


def test_pairs_are_made_in_parts_of_a_size(spark, monkeypatch):
    """The rows are dealt once, in more parts if there are more of them (F22)."""
    monkeypatch.setattr(L, "PAIRED", 50)
    side = lambda n: spark.createDataFrame([(f"m{i % 97}", None if i % 11 == 0 else f"a{i % 3}", i) for i in range(n)], "measurement_uid string, ip string, pos int")
    few, many = (L.pair_by_address(side(n), side(n // 2), side(n // 3), side(n // 4)) for n in (60, 3000))
    assert hashed(few) == hashed(many) == 1
    parts = lambda df: int(re.search(r"hashpartitioning\(measurement_uid#\d+, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())[1])
    assert parts(few) == 4 and parts(many) == (3000 + 1500 + 1000 + 750) // 50
    monkeypatch.setattr(L, "PAIRED", 1 << 18)
    again = L.pair_by_address(side(3000), side(1500), side(1000), side(750))
    assert sorted(map(str, many.collect())) == sorted(map(str, again.collect()))


def test_control_rows_join_both_layers_and_leave_out_met_addresses(spark, monkeypatch):
    """ctrl_rows gets its endpoints by a full outer join of TCP and TLS, and the addresses that no endpoint has by
    an anti join (r04 F3)."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    made = {}
    monkeypatch.setattr(L, "staged", lambda df, name: made.setdefault(name, df))
    out = registry.queries()["ctrl_rows"](spark, "/root/testdata/sf0.001")
    assert "Join FullOuter" in plan(made["endpoints"])
    assert "Join LeftAnti" in plan(out) and "Join LeftOuter" in plan(out)


def staged_frames(monkeypatch):
    """What is staged by name, as it is made."""
    made = {}
    own = B.staged

    def keep(df, name):
        made[name] = df
        return own(df, name)

    monkeypatch.setattr(B, "staged", keep)
    return made


def raw_line(spark, uid, day, ip, **keys):
    tcp = [{"ip": ip, "port": 443, "status": {"success": True}, "transaction_id": 1, "t": 1.0}]
    row = {"measurement_uid": uid, "measurement_start_time": day, "test_name": "web_connectivity", "input": "https://h.example/", "probe_asn": "AS1", "test_keys": {"tcp_connect": tcp} | keys}
    return spark.createDataFrame([(json.dumps(row),)], "value string").select(F.from_json("value", MEASUREMENT).alias("m")).select("m.*")


def ranges_of(spark):
    ranges = [(day, 1 << 24, (2 << 24) - 1, 8, asn, "o", "A", "N") for day, asn in (("2024-01-01", 7), ("2024-02-01", 8))]
    text = "snapshot string, first long, last long, prefix_len int, asn long, org string, as_cc string, cc string"
    prefixes = spark.createDataFrame([], "snapshot timestamp, prefix string, asn long, org string, as_cc string, cc string")
    return spark.createDataFrame(ranges, text).withColumn("snapshot", F.col("snapshot").cast("timestamp")), prefixes


def test_raw_observations_stage_what_is_read(spark, monkeypatch):
    """No control is made, only the columns that are asked for are staged, and an address is looked up once a snapshot and
    not once a day (r04 F1)."""
    made = staged_frames(monkeypatch)
    days = ["2023-12-05", "2024-01-02", "2024-01-03", "2024-01-31", "2024-02-01", "2024-03-01", "2024-03-02", "x"]
    rows = [raw_line(spark, f"u{i}", f"{day} 00:00:00", "1.2.3.4") for i, day in enumerate(days)]
    rows += [raw_line(spark, "six", "2024-01-02 00:00:00", "2001:470::1"), raw_line(spark, "none", "2024-01-02 00:00:00", "[scrubbed]"), raw_line(spark, "bogon", "2024-01-02 00:00:00", "10.0.0.1")]
    out = B.raw_observation_rows(reduce(DataFrame.unionByName, rows), *ranges_of(spark), columns=("measurement_uid", "tcp_ip"))
    got = {r.measurement_uid: (r.tcp_ip, r.ip_asn, r.ip_cc) for r in out.collect()}
    assert "control" not in made and "tls_cipher_suite" not in made["observations"].columns
    assert sorted(map(tuple, made["addresses"].select("ip").collect())) == [("1.2.3.4",), ("1.2.3.4",), ("10.0.0.1",), ("2001:470::1",), ("scrubbed",)]
    # before the first snapshot the oldest one holds; a row without a day has no network
    assert [got[f"u{i}"][1] for i in range(8)] == [7, 7, 7, 7, 8, 8, 8, None]
    assert got["six"] == ("2001:470::1", 0, "ZZ") and got["none"] == ("scrubbed", 0, "ZZ") and got["bogon"] == ("10.0.0.1", 64666, "ZZ")


def test_columns_of_observations_are_small_methods(spark):
    """The JVM compiles no method of more than 8 000 bytes of code (r04 F1, F2)."""
    rows = B.observations(raw_line(spark, "u", "2024-01-01 00:00:00", "1.2.3.4"), ("web_connectivity",)).select(*V.OBSERVED[:5], "dns_failure", "tcp_failure", "tls_failure")
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(rows._jdf.queryExecution().executedPlan())
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code)), default=0) < 8000


def test_pairing_of_lists(spark):
    """Parts, empty and absent ones, queries without answers, connections to no address and ids of 0 (r04 F1, F2)."""
    kind = "struct<" + ",".join(f"{n}:array<{'string' if n.endswith('ip') else 'bigint' if n.endswith('tid') else 'int'}>" for n in ("dns_ip", "dns_tid", "answers", "tcp_ip", "tcp_tid", "tls_ip", "tls_tid", "http_ip", "http_tid")) + ">"
    one = (["a", "b", None], [1, 0], [2, 0], [None, "b", "a"], [1, 0, None], ["x"], [1], [None], [0])
    none = (None,) * 9
    rows = spark.createDataFrame([(0, [one, none, one]), (1, []), (2, None), (3, [none])], f"i int, p array<{kind}>").coalesce(1)
    got = {r.i: [tuple(x) for x in r.q] for r in rows.select("i", F.arrow_udf(L.paired, L.PAIRS)("p").alias("q")).collect()}
    pairs = lambda k: [(k, 0, 0, 2, 0, None), (k, 0, 1, 1, None, None), (k, 1, None, None, None, None), (k, None, None, None, None, 0)]
    assert got == {0: pairs(0) + pairs(2), 1: [], 2: [], 3: []}


def test_raw_verdicts_stage_what_is_read(spark, monkeypatch):
    """Observations are staged with the columns that verdicts read, and an address of both sides is looked up once a
    snapshot (r04 F2)."""
    made = staged_frames(monkeypatch)
    told = {"control": {"dns": {"addrs": ["1.2.3.4"]}, "tcp_connect": {"1.2.3.4:443": {"failure": None}}}}
    rows = raw_line(spark, "a", "2024-01-02 00:00:00", "1.2.3.4", **told).unionByName(raw_line(spark, "b", "2024-01-03 00:00:00", "1.2.3.4", **told))
    own, control = B.raw_verdict_inputs(rows, *ranges_of(spark), columns=V.OBSERVED)
    assert set(made["observations"].columns) <= {*V.OBSERVED, "resolver_ip", "resolver_as_org_name"}
    assert [tuple(r) for r in made["addresses"].select("ip").collect()] == [("1.2.3.4",)]
    assert [(r.ip_asn, r.tcp_success) for r in control.collect()] == [(7, 1), (7, 1)]
    assert [(r.measurement_uid, r.top_tcp_rule_id, r.tcp_ok) for r in V.web_verdicts(own, control).orderBy("measurement_uid").collect()] == [("a", "connect_ok", 1.0), ("b", "connect_ok", 1.0)]
