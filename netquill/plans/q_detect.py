"""Queries over series, changes and data quality."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from netquill.operators import detect as D
from netquill.operators import quality as Q
from netquill.plans.catalog import QUERIES, SQL, query
from netquill.plans.standins import ctes, frame

VB = ctes("V")
MB = ctes("M")
SERIES = """series AS (SELECT probe_cc, probe_asn, domain, date_trunc('hour', measurement_start_time) AS ts,
  count(*) FILTER (WHERE resolver_asn = probe_asn) AS count_isp_resolver, count(*) FILTER (WHERE resolver_asn <> probe_asn) AS count_other_resolver, count(*) AS count,
  quantile_cont(dns_blocked, 0.5) FILTER (WHERE resolver_asn = probe_asn) AS dns_isp_blocked, quantile_cont(dns_blocked, 0.5) FILTER (WHERE resolver_asn <> probe_asn) AS dns_other_blocked,
  quantile_cont(tcp_blocked, 0.5) AS tcp_blocked, quantile_cont(tls_blocked, 0.5) AS tls_blocked
  FROM v GROUP BY ALL)"""
OPTIONS = {"edd": 2.0, "gap_halflife": 48.0}


def series(spark, d):
    """Hours of all events."""
    return D.hourly_series(frame(spark, d, "V"))


@query("hourly_series", f"{VB}, {SERIES} SELECT * FROM series")
def hourly_series(spark, d):
    return series(spark, d)


POINTS = """points AS (SELECT probe_cc, probe_asn, domain, ts, 'dns_isp_blocked' AS signal, dns_isp_blocked AS y, count_isp_resolver AS w FROM series
  UNION ALL SELECT probe_cc, probe_asn, domain, ts, 'dns_other_blocked', dns_other_blocked, count_other_resolver FROM series
  UNION ALL SELECT probe_cc, probe_asn, domain, ts, 'tcp_blocked', tcp_blocked, count FROM series
  UNION ALL SELECT probe_cc, probe_asn, domain, ts, 'tls_blocked', tls_blocked, count FROM series),
numbered AS (SELECT *, row_number() OVER (PARTITION BY probe_cc, probe_asn, domain, signal ORDER BY ts) AS i FROM points WHERE w > 0 AND y IS NOT NULL)"""
WALK = f"""WITH RECURSIVE {VB[5:]}, {SERIES}, {POINTS}, walk AS (
  SELECT probe_cc, probe_asn, domain, signal, CAST(0 AS BIGINT) AS i, 'unk' AS st, CAST(0 AS DOUBLE) AS p, CAST(0 AS DOUBLE) AS n, 0 AS ch,
    CAST(NULL AS TIMESTAMP) AS last_ts, 0 AS emitted, CAST(0 AS DOUBLE) AS ep, CAST(0 AS DOUBLE) AS en, '' AS before
  FROM (SELECT DISTINCT probe_cc, probe_asn, domain, signal FROM numbered)
  UNION ALL
  SELECT probe_cc, probe_asn, domain, signal, i,
    CASE WHEN st = 'unk' THEN CASE WHEN ep > 0.7 THEN 'blk' WHEN en > 0.7 THEN 'ok' ELSE 'unk' END WHEN emitted = 1 THEN 'blk' WHEN emitted = -1 THEN 'ok' ELSE st END,
    CASE WHEN ep > 0.7 AND st <> 'blk' OR en > 0.7 AND st <> 'ok' THEN 0 ELSE ep END,
    CASE WHEN ep > 0.7 AND st <> 'blk' OR en > 0.7 AND st <> 'ok' THEN 0 ELSE en END,
    CASE WHEN emitted <> 0 THEN emitted ELSE ch END, ts, emitted, ep, en, st
  FROM (SELECT *, CASE WHEN st = 'ok' AND ep > 0.7 AND ch <> 1 THEN 1 WHEN st = 'blk' AND en > 0.7 AND ch <> -1 THEN -1 ELSE 0 END AS emitted
    FROM (SELECT w.probe_cc, w.probe_asn, w.domain, w.signal, x.i, w.st, w.ch, x.ts,
        CASE WHEN w.st = 'blk' THEN 0 ELSE greatest(0, w.p * f + x.y - 0.35) END AS ep,
        CASE WHEN w.st = 'ok' THEN 0 ELSE greatest(0, w.n * f - (x.y - 0.7) - 0.35) END AS en
      FROM (SELECT w0.*, x0.ts AS nts, CASE WHEN w0.last_ts IS NOT NULL AND epoch_us(x0.ts) - epoch_us(w0.last_ts) > 86400000000
          THEN power(0.5, (epoch_us(x0.ts) - epoch_us(w0.last_ts)) / 3600000000.0 / 48.0) ELSE 1.0 END AS f
        FROM walk w0 JOIN numbered x0 ON w0.probe_cc = x0.probe_cc AND w0.probe_asn = x0.probe_asn AND w0.domain = x0.domain AND w0.signal = x0.signal AND x0.i = w0.i + 1) w
      JOIN numbered x ON w.probe_cc = x.probe_cc AND w.probe_asn = x.probe_asn AND w.domain = x.domain AND w.signal = x.signal AND x.i = w.i + 1))
)"""


@query("cusum", f"""{WALK} SELECT probe_cc, probe_asn, domain, signal, last_ts AS ts, emitted AS change_dir, ep AS s_pos, en AS s_neg, before AS current_state,
  CAST(0.7 AS DOUBLE) AS h FROM walk WHERE emitted <> 0""")
def cusum(spark, d):
    return D.detect_changes(series(spark, d), **OPTIONS)[0]


@query("cusum_resume", f"""{WALK} SELECT probe_cc, probe_asn, domain, signal, arg_max(st, i) AS current_state, arg_max(p, i) AS s_pos, arg_max(n, i) AS s_neg,
  arg_max(ch, i) AS last_change, CAST(count(*) FILTER (WHERE emitted <> 0) AS BIGINT) AS n_changes FROM walk GROUP BY ALL""")
def cusum_resume(spark, d):
    """Two runs, the second from the state the first left, end where one run over all hours ends."""
    hours, cut = series(spark, d), datetime(2024, 1, 15)
    first, state, _ = D.detect_changes(hours.filter(F.col("ts") < F.lit(cut)), **OPTIONS)
    second, last, _ = D.detect_changes(hours.filter(F.col("ts") >= F.lit(cut)), state, **OPTIONS)
    keys = [*D.KEY, "signal"]
    names = ["current_state", "s_pos", "s_neg", "last_change"]
    ends = state.select(*keys, "ts", *names).unionByName(last.select(*keys, "ts", *names))
    ends = ends.groupBy(*keys).agg(F.max_by(F.struct(*names), "ts").alias("s"))
    n = first.unionByName(second).groupBy(*keys).agg(F.count("*").alias("n"))
    # a key and signal without any weight has no state
    live = D.long_form(hours).filter("w > 0 AND y IS NOT NULL").select(*keys).distinct()
    return ends.join(live, keys, "left_semi").join(n, keys, "left").select(*keys, "s.*", F.coalesce("n", F.lit(0)).alias("n_changes"))


@query("cusum_trace")
def cusum_trace(spark, d):
    return D.detect_changes(series(spark, d), trace=True, **OPTIONS)[2]


@query("bernoulli_cusum", f"""{VB}, {SERIES}, {POINTS}, s AS (SELECT *, sum(w * (y * ln(7.0) + (1 - y) * ln(0.3 / 0.9))) OVER (PARTITION BY probe_cc, probe_asn, domain, signal ORDER BY ts) AS u FROM numbered)
SELECT probe_cc, probe_asn, domain, signal, ts, u - least(min(u) OVER k, 0) AS s_pos, -u - least(min(-u) OVER k, 0) AS s_neg
FROM s WINDOW k AS (PARTITION BY probe_cc, probe_asn, domain, signal ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def bernoulli_cusum(spark, d):
    return D.bernoulli_cusum(D.long_form(series(spark, d)))


@query("latest_state", f"""{MB} SELECT probe_cc, probe_asn, domain, max(measurement_start_time) AS ts,
  arg_max(value, measurement_start_time) AS value, arg_max(event_type, measurement_start_time) AS event_type
FROM m WHERE measurement_start_time < TIMESTAMP '2024-01-20' AND measurement_start_time > TIMESTAMP '2024-01-10' GROUP BY ALL""")
def latest_state(spark, d):
    m = frame(spark, d, "M").select(*D.KEY, F.col("measurement_start_time").alias("ts"), "value", "event_type")
    return D.latest_state(m, datetime(2024, 1, 20), D.KEY)


@query("state_bands", f"""{MB}, t AS (SELECT *, CASE WHEN lag(event_type) OVER k IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS turn FROM m WINDOW k AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM t)
SELECT user_id, event_type, min(event_id) AS state_start, max(event_id) AS state_end FROM r GROUP BY user_id, run, event_type""")
def state_bands(spark, d):
    return D.state_bands(frame(spark, d, "events"), ["user_id"], "event_type", "event_id")


@query("date_chunks", """WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events), x AS (SELECT date_trunc('hour', lo) AS s, date_trunc('hour', hi) AS e,
  CASE WHEN date_trunc('day', date_trunc('hour', lo)) = date_trunc('hour', lo) THEN date_trunc('hour', lo) ELSE date_trunc('day', lo) + INTERVAL 1 DAY END AS f, date_trunc('day', hi) AS l FROM b)
SELECT h AS "start", h + INTERVAL 1 HOUR AS "end", strftime(h, '%Y-%m-%dT%H') AS label FROM x, unnest(range(s, least(f, e), INTERVAL 1 HOUR)) AS t(h)
UNION ALL SELECT h, least(h + INTERVAL 5 DAY, l), strftime(h, '%Y-%m-%d') FROM x, unnest(range(f, l, INTERVAL 5 DAY)) AS t(h)
UNION ALL SELECT h, h + INTERVAL 1 HOUR, strftime(h, '%Y-%m-%dT%H') FROM x, unnest(range(greatest(l, f), e, INTERVAL 1 HOUR)) AS t(h)""")
def date_chunks(spark, d):
    """Chunks of the time that the events span."""
    b = frame(spark, d, "events").agg(F.date_trunc("hour", F.min("ts")).alias("s"), F.date_trunc("hour", F.max("ts")).alias("e")).first()
    return D.date_chunks(spark, b.s, b.e, 5)


@query("alert_rows", f"""{WALK}, c AS (SELECT *, last_ts AS ts FROM walk WHERE emitted <> 0), q AS (SELECT *, '?domain=' || domain || '&probe_cc=' || probe_cc || '&probe_asn=AS' || probe_asn
  || '&since=' || strftime(CAST(ts AS DATE) - INTERVAL 13 DAY, '%Y-%m-%d') || '&until=' || strftime(CAST(ts AS DATE) + INTERVAL 2 DAY, '%Y-%m-%d') AS query FROM c)
SELECT ts, probe_cc, probe_asn, domain, signal, emitted AS change_dir,
  '[' || probe_cc || '/AS' || probe_asn || '] ' || domain || CASE emitted WHEN 1 THEN ' is blocked' ELSE ' is unblocked' END || ' - ' || signal AS text,
  'https://explorer.example/chart/mat' || query AS explorer_url, 'https://panel.example/' || query AS panel_url,
  CAST((row_number() OVER (ORDER BY ts, probe_cc, probe_asn, domain, signal) - 1) // 10 AS INTEGER) AS batch FROM q""")
def alert_rows(spark, d):
    return D.alert_rows(D.detect_changes(series(spark, d), **OPTIONS)[0])


@query("cp_events", f"""{MB}, x AS (SELECT user_id, CASE event_type WHEN 'error' THEN 1 ELSE -1 END AS change_dir, measurement_start_time AS ts FROM m),
g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id, change_dir ORDER BY ts)) <= 6 * 3600000000 THEN 0 ELSE 1 END AS fresh FROM x),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, change_dir ORDER BY ts) AS event FROM g)
SELECT user_id, change_dir, CAST(event AS BIGINT) AS event, min(ts) AS started, max(ts) AS ended, count(*) AS n_changes FROM s GROUP BY ALL""")
def cp_events(spark, d):
    m = frame(spark, d, "M").select("user_id", F.when(F.col("event_type") == "error", 1).otherwise(-1).alias("change_dir"), F.col("measurement_start_time").alias("ts"))
    return D.event_clusters(m, ["user_id"], 6)


@query("watchlist_semi", f"""{MB} SELECT event_id, domain FROM m WHERE domain IN (SELECT 'd' || n_nationkey || '.example' FROM nation WHERE n_regionkey = 1 UNION SELECT 'd0.example')""")
def watchlist_semi(spark, d):
    """Rows of watched domains: those of one category and one named."""
    lists = frame(spark, d, "nation").select(
        F.concat(F.lit("d"), F.col("n_nationkey").cast("string"), F.lit(".example")).alias("domain"), F.lit("ZZ").alias("cc"), F.when(F.col("n_regionkey") == 1, "GRP").alias("category_code")
    )
    return D.watched(frame(spark, d, "M"), D.watch_list(lists, more=("d0.example",))).select("event_id", "domain")


_MIN = "date_trunc('minute', measurement_start_time)"


@query("volume_anomaly", f"""{MB}, k AS (SELECT {_MIN} AS ts, probe_cc, probe_asn, engine_version, software_name, software_version, platform, architecture, count(*) AS total FROM m GROUP BY ALL HAVING count(*) >= 2)
SELECT ts, 'volume' AS type, probe_cc, probe_asn, total, '{{"total":' || total || ',"minute_start":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","minute_end":"' || strftime(ts + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S')
  || '","engine_version":"' || engine_version || '","software_name":"' || software_name || '","software_version":"' || software_version || '","platform":"' || platform || '","architecture":"' || architecture || '"}}' AS details FROM k""")
def volume_anomaly(spark, d):
    return Q.volume_anomalies(frame(spark, d, "M"), threshold=2)


@query("clock_drift", f"""{MB}, x AS (SELECT *, date_diff('second', strptime(substr(measurement_uid, 1, 14), '%Y%m%d%H%M%S'), date_trunc('second', measurement_start_time)) AS difference FROM m),
y AS (SELECT *, CASE WHEN difference <= -1800 THEN 'time_inconsistency_future' WHEN difference >= 3600 THEN 'time_inconsistency_past' END AS type FROM x)
SELECT measurement_start_time AS ts, type, measurement_uid AS uid, probe_cc, probe_asn, difference,
  '{{"difference":' || difference || ',"threshold":' || CASE WHEN difference < 0 THEN 1800 ELSE 3600 END || ',"software_version":"' || software_version || '"}}' AS details FROM y WHERE type IS NOT NULL""")
def clock_drift(spark, d):
    return Q.clock_drift(frame(spark, d, "M"), past_threshold=3600)


@query("dup_audit", """WITH k AS (SELECT strftime(date_trunc('month', l_shipdate), '%Y%m%d') AS bucket, l_orderkey, l_suppkey % 10 AS s, count(*) AS cnt FROM lineitem GROUP BY ALL)
SELECT bucket, count(*) FILTER (WHERE cnt > 1) AS duplicates, CAST(sum(cnt) AS BIGINT) AS total_rows FROM k GROUP BY bucket""")
def dup_audit(spark, d):
    rows = frame(spark, d, "lineitem").select(F.date_format(F.date_trunc("month", "l_shipdate"), "yyyyMMdd").alias("bucket"), "l_orderkey", (F.col("l_suppkey") % 10).alias("s"))
    return Q.duplicate_audit(rows, "bucket", ["l_orderkey", "s"])


@query("dup_months", """WITH k AS (SELECT strftime(date_trunc('month', l_shipdate), '%Y%m') AS month, l_orderkey, l_suppkey % 10 AS s, count(*) AS cnt FROM lineitem GROUP BY ALL)
SELECT month, CAST(count(*) FILTER (WHERE cnt > 1) AS BIGINT) AS duplicates FROM k GROUP BY month HAVING count(*) FILTER (WHERE cnt > 1) > 0""")
def dup_months(spark, d):
    return Q.months_to_clean(dup_audit(spark, d), "bucket")


@query("dense_hours", f"""{MB}, h AS (SELECT probe_cc, date_trunc('hour', measurement_start_time) AS ts, count(*) AS n FROM m GROUP BY ALL),
r AS (SELECT min(ts) AS lo, max(ts) AS hi FROM h)
SELECT k.probe_cc, g.ts, coalesce(h.n, 0) AS n FROM (SELECT DISTINCT probe_cc FROM h) k, (SELECT unnest(range(lo, hi + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts FROM r) g
LEFT JOIN h ON h.probe_cc = k.probe_cc AND h.ts = g.ts""")
def dense_hours(spark, d):
    from netquill.operators.extras import dense_hours as dense

    return dense(frame(spark, d, "M"), ["probe_cc"])


@query("panel_summary", f"""{WALK}, a AS (SELECT probe_asn, count(*) AS n_hours, count(*) FILTER (WHERE dns_isp_blocked IS NOT NULL) AS n_isp, count(*) FILTER (WHERE dns_other_blocked IS NOT NULL) AS n_other FROM series GROUP BY ALL)
SELECT a.probe_asn, n_hours, n_isp, n_other, a.probe_asn IN (SELECT probe_asn FROM walk WHERE emitted <> 0) AS has_change FROM a""")
def panel_summary(spark, d):
    """Hours of each network, how many have a value of each resolver kind, and whether it has a change."""
    s = series(spark, d)
    return D.panel_summary(s, D.detect_changes(s, **OPTIONS)[0])


#: the same under their second names
for _name in ("hourly_series", "cusum", "cusum_resume", "cusum_trace", "bernoulli_cusum", "alert_rows", "panel_summary"):
    query(f"{_name}_whole", SQL.get(_name))(QUERIES[_name])
