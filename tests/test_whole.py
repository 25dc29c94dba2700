"""Queries over all rows: small tables with the rows that the bounded queries leave out."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from netquill.operators import aggregate as A
from netquill.operators import detect as D
from netquill.operators import observations as B
from netquill.operators import text as X
from netquill.operators import verdicts as V
from netquill.plans import q_flatten, registry
from netquill.plans.standins import frame


@pytest.fixture
def table(spark, tmp_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return put


LINE = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint"


def test_dns_explode_keeps_orders_with_repeated_line_numbers(spark, table):
    d = table("lineitem", [(1, 1, 6, 2), (1, 1, 3, 9), (1, 1, 3, 9), (2, 3, 4, 1)], LINE)
    got = registry.queries()["dns_explode_whole"](spark, d).collect()
    assert sorted((r.measurement_uid, r.query_pos, r.answer, r.answer_asn) for r in got if r.answer) == [
        ("1", 0, "93.184.3.7", 0), ("1", 1, "93.184.3.7", 0), ("1", 2, "93.184.6.7", 2),
    ]
    assert [(r.measurement_uid, r.failure) for r in got if not r.answer] == [("2", "dns_server_misbehaving")]


def test_redirect_from_keeps_further_observations_of_an_index(spark, table):
    day = datetime(1995, 1, 1)
    lines = [(1, 1, 9, 1), (1, 2, 5, 1), (1, 2, 3, 1), (1, 2, 3, 1)]
    filled = [(*x, 1.0, 0.0, 0.0, "N", "O") for x in lines]
    table("lineitem", filled, LINE + ", l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    table("customer", [(1, 1)], "c_custkey bigint, c_nationkey bigint")
    d = table("orders", [(1, 1, day)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp")
    got = registry.queries()["redirect_from_whole"](spark, d).collect()
    url = "https://h{}.example/{}".format
    assert sorted((r.observation_idx, r.http_url, r.redirect_from or "") for r in got) == [
        (1, url(9, 1), url(3, 2)), (2, url(3, 2), ""), (2, url(3, 2), ""), (2, url(5, 2), ""),
    ]


EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
DETECTED = ("hourly_series", "cusum", "cusum_resume", "cusum_trace", "bernoulli_cusum", "alert_rows", "panel_summary")


def test_detection_reads_events_of_any_date(spark, table):
    """One key with two days of blocked hours between days of clear ones, in another year."""
    start = datetime(2031, 5, 1)
    d = table("events", [(6 * i, start + timedelta(hours=i), 5, "error" if 48 <= i < 96 else "signup", 99.0, "{}") for i in range(144)], EVENT)
    for name in DETECTED:
        assert registry.queries()[f"{name}_whole"](spark, d).count() > 0, name
    hours = registry.queries()["hourly_series_whole"](spark, d)
    assert hours.agg(F.sum("count")).first()[0] == 144
    changes = registry.queries()["cusum_whole"](spark, d).filter("signal = 'tcp_blocked'").orderBy("ts").collect()
    assert [c.change_dir for c in changes] == [1, -1]
    sql = registry.oracle_sql()
    assert all("TIMESTAMP '2024-01-02'" not in sql[n] for n in DETECTED if n in sql)


def test_series_bounds_are_strict(spark):
    start = datetime(2031, 5, 1)
    zero = [0.0] * 3
    rows = [("IT", 1, "d", start + timedelta(hours=i), 1, *zero) for i in range(4)]
    v = spark.createDataFrame(rows, "probe_cc string, probe_asn int, domain string, measurement_start_time timestamp, resolver_asn int, dns_blocked double, tcp_blocked double, tls_blocked double")
    got = D.hourly_series(v, start, start + timedelta(hours=3)).collect()
    assert sorted(r.ts for r in got) == [start + timedelta(hours=i) for i in (1, 2)]


def test_no_measurement_holds_all_events_of_a_user(spark, table):
    """One user has all events; each handshake is read with few of them, and windows stay as they were."""
    kinds = ["signup", "view", "purchase", "click", "purchase", "signup", "signup", "error", "purchase"]
    d = table("events", [(i, datetime(2024, 1, 3), 1, kinds[i % 9], 1.0, "{}") for i in range(9000)], EVENT)
    rows = q_flatten._handshakes(spark, d)
    assert rows.agg(F.max(F.size("events"))).first()[0] < 40
    got = {r.t: (r.n_events, r.first_t) for r in registry.queries()["hs_windows"](spark, d).collect()}
    want = {9 * i + k: (n, 9 * i + k - n + 1) for i in range(1000) for k, n in ((2, 3), (4, 2), (8, 3))}
    assert got == want


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_alerts_are_numbered_without_one_task_for_all(spark):
    start = datetime(2031, 5, 1)
    changes = [(start + timedelta(hours=i % 7), "IT", i, "d", "tcp_blocked", 1) for i in range(100)]
    df = spark.createDataFrame(changes, "ts timestamp, probe_cc string, probe_asn int, domain string, signal string, change_dir int")
    out = D.alert_rows(df)
    want = {(c[0], c[2]): k // 10 for k, c in enumerate(sorted(changes))}
    assert {(r.ts, r.probe_asn): r.batch for r in out.collect()} == want
    assert "row_number() windowspecdefinition(1," not in plan_of(out)
    assert "row_number() windowspecdefinition(ts" in plan_of(out)


def test_verdicts_and_failures_of_every_country(spark):
    d = "/root/testdata/sf0.001"
    countries = {r.probe_cc for r in frame(spark, d, "O").select("probe_cc").distinct().collect()}
    assert countries > {"C1", "C2", "C3"}
    for name in ("web_verdicts_whole", "failure_agg_whole"):
        assert {r.probe_cc for r in registry.queries()[name](spark, d).select("probe_cc").distinct().collect()} == countries, name


def test_verdicts_of_chosen_countries(spark):
    """Filters come before the windows over reports."""
    d = "/root/testdata/sf0.001"
    o, c = frame(spark, d, "O"), frame(spark, d, "C")
    got = V.web_verdicts(o, c, probe_cc=("C1", "C2"), grain="month")
    want = V.web_verdicts(o.filter("probe_cc IN ('C1', 'C2')"), c.limit(0).unionByName(c), grain="month")
    assert {r.probe_cc for r in got.select("probe_cc").distinct().collect()} == {"C1", "C2"}
    assert got.select("measurement_uid").distinct().count() == want.select("measurement_uid").distinct().count()


def test_failures_of_chosen_countries(spark):
    rows = [("C0", "a", None, None, None, None), ("C1", "a", None, None, None, None), ("C1", None, "b", None, None, None), ("C1", None, None, "c", "write_1", "h"),
            ("C1", None, None, None, "read_1", "h"), ("C1", None, None, None, "write_1", "h"), ("C1", None, None, None, None, None)]
    o = spark.createDataFrame(rows, "probe_cc string, dns_failure string, tcp_failure string, tls_failure string, tls_handshake_last_operation string, tls_server_name string")
    got = A.failure_aggregation(o, ("failure",), probe_cc=("C1",)).collect()
    assert sorted((str(r.failure), r.probe_cc, r.observation_count) for r in got) == [
        ("None", "C1", 1), ("dns_a", "C1", 1), ("none", "C1", 1), ("tcp_b", "C1", 1), ("tls_c_after_CH", "C1", 1),
    ]
    assert A.failure_aggregation(o, ("probe_cc",)).count() == 2


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_lists_of_a_host_are_not_dealt_with_the_rows(spark):
    d = "/root/testdata/sf0.001"
    o, c = (V.with_day(frame(spark, d, n), "month") for n in "OC")
    plan = V.with_flags(o, V.address_evidence(c, o), V.host_evidence(c))._jdf.queryExecution().optimizedPlan()
    dealt = [n for n in nodes(plan) if n.nodeName() == "RepartitionByExpression"]
    assert dealt and not [x for n in dealt for x in n.output().mkString(",").split(",") if x.startswith("_asns")]


def test_control_maps_are_made_once(spark):
    plan = registry.queries()["ctrl_maps"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert sum(n.nodeName() == "LogicalRelation" or "Relation" in n.nodeName() for n in nodes(plan)) <= 4


def test_simhash_deals_no_shingles(spark):
    """Texts of one key vote together; characters beyond the first plane are one each; short texts have no row."""
    from hashlib import md5

    rows = [(1, "abcdabcdx"), (1, "zzzzz"), (2, "a\U0001F600b\U0001F600c"), (3, "abc"), (4, None), (None, "wxyz")]
    out = X.simhash(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {}
    for k in (1, 2, None):
        bits = [int(md5(t[i : i + 4].encode()).hexdigest()[16:], 16) for d, t in rows if d == k and t for i in range(len(t) - 3)]
        full = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in bits) > len(bits))
        want[k] = (full >> 32, full & 0xFFFFFFFF)
    assert {r.doc_id: (r.simhash_high, r.simhash_low) for r in out.collect()} == want
    assert not [n for n in nodes(out._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Generate"]


def test_platform_query_keeps_a_row_a_connection(spark):
    d = "/root/testdata/sf0.001"
    got = registry.queries()["web_observations_platform"](spark, d)
    assert "observation_idx" in got.columns and got.count() == frame(spark, d, "lineitem").count()


def test_connections_are_made_without_the_other_sides(spark):
    plan = plan_of(registry.queries()["tcp_explode"](spark, "/root/testdata/sf0.001"))
    assert "tcp_connect" in plan or "refused" in plan
    assert not [x for x in ("to_json", "from_json", "TLSv1.3", "GET") if x in plan]


def test_control_is_read_without_observations(spark, monkeypatch):
    monkeypatch.setattr(B, "observations", None)
    assert registry.queries()["raw_control"](spark, "/root/testdata/sf0.001").count() > 0
