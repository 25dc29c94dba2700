"""Queries over readers, writers, versioned tables and the detector's store: what is written is read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from netquill.functions import scalars as S
from netquill.operators import detector_store as DS
from netquill.operators import enrich as E
from netquill.operators import quality as Q
from netquill.operators import rules as R
from netquill.plans.catalog import SQL, query
from netquill.plans.q_detect import OPTIONS, series
from netquill.plans.standins import frame
from netquill.sources import io as IO
from netquill.sources import versions


@query("quarantined_lines", """SELECT unnest(['rows', 'unreadable', 'empty', 'kept', 'quarantined unreadable', 'quarantined empty']) AS name,
  unnest([count(*), count(*) FILTER (WHERE event_id % 7 = 0), count(*) FILTER (WHERE event_id % 7 > 0 AND event_id % 5 = 0), count(*) FILTER (WHERE event_id % 7 > 0 AND event_id % 5 > 0),
    count(*) FILTER (WHERE event_id % 7 = 0), count(*) FILTER (WHERE event_id % 7 > 0 AND event_id % 5 = 0)]) AS n FROM events""")
def quarantined_lines(spark, d):
    """Lines of events, some of them broken or without test keys: counted as they are read, and kept apart."""
    line = F.expr("""CASE WHEN event_id % 7 = 0 THEN concat('{broken ', event_id) ELSE to_json(named_struct('measurement_uid', CAST(event_id AS STRING),
      'test_keys', CASE WHEN event_id % 5 > 0 THEN named_struct('failure', event_type) END)) END""")
    path, apart = IO.scratch_path(spark, "lines"), IO.scratch_path(spark, "quarantine")
    frame(spark, d, "events").select(line.alias("value")).write.text(path)
    good, counters = IO.read_counted(spark, path, apart)
    kept = good.count()
    found = [(n, counters.get[n]) for n in ("rows", "unreadable", "empty")] + [("kept", kept)]
    lost = spark.read.parquet(apart).groupBy(F.concat(F.lit("quarantined "), "reason").alias("name")).agg(F.count("*").alias("n"))
    return spark.createDataFrame(found, "name string, n long").unionByName(lost)


@query("csv_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def csv_roundtrip(spark, d):
    path = IO.scratch_path(spark, "csv")
    IO.write_csv({"orders": frame(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")}, path)
    return spark.read.option("header", True).schema("o_orderkey bigint, o_custkey bigint, o_orderstatus string").csv(f"{path}/orders")


@query("schema_drift", """WITH a AS (SELECT n_name AS name, 't' || n_regionkey AS type FROM nation WHERE n_nationkey < 20), b AS (SELECT n_name AS name, 't' || (n_nationkey % 5) AS type FROM nation WHERE n_nationkey >= 5)
SELECT coalesce(a.name, b.name) AS name, a.type AS expected, b.type AS actual, CASE WHEN b.name IS NULL THEN 'missing' WHEN a.name IS NULL THEN 'extra' ELSE 'type changed' END AS change
FROM a FULL JOIN b ON a.name = b.name WHERE a.name IS NULL OR b.name IS NULL OR a.type <> b.type""")
def schema_drift(spark, d):
    kind = lambda c: F.concat(F.lit("t"), c.cast("string")).alias("type")
    n = frame(spark, d, "nation")
    a = n.filter("n_nationkey < 20").select(F.col("n_name").alias("name"), kind(F.col("n_regionkey")))
    return Q.schema_drift(a, n.filter("n_nationkey >= 5").select(F.col("n_name").alias("name"), kind(F.col("n_nationkey") % 5)))


_LINT = "SELECT 'l' || (p_partkey % 3) AS layer, CASE WHEN p_partkey % 40 = 7 THEN 'twice' ELSE 'r' || p_partkey END AS rule_id, p_partkey AS position, (p_partkey % 7 - 1) / 4.0 AS blocked, (p_partkey % 3) / 4.0 AS down, 0.0 AS ok, p_partkey % 3 AS evidence FROM part"


@query("rule_lint", f"""WITH r AS ({_LINT}), t AS (SELECT *, blocked + down + ok AS total FROM r)
SELECT layer, 'repeated id' AS problem, rule_id FROM r GROUP BY layer, rule_id HAVING count(*) > 1 UNION ALL SELECT layer, 'negative weight', rule_id FROM t WHERE least(blocked, down, ok) < 0
UNION ALL SELECT layer, 'weights exceed one', rule_id FROM t WHERE total > 1.000001 UNION ALL SELECT layer, 'scores without evidence', rule_id FROM t WHERE evidence < 2 AND total > 0
UNION ALL SELECT layer, 'evidence without scores', rule_id FROM t WHERE evidence = 2 AND total <= 0 UNION ALL SELECT layer, 'no catch-all at the end', arg_max(rule_id, position) FROM r GROUP BY layer""")
def rule_lint(spark, d):
    p = F.col("p_partkey")
    number = lambda c: c.cast("double")
    rules = frame(spark, d, "part").select(
        F.concat(F.lit("l"), (p % 3).cast("string")).alias("layer"), F.when(p % 40 == 7, "twice").otherwise(F.concat(F.lit("r"), p.cast("string"))).alias("rule_id"), p.alias("position"),
        (number(p % 7 - 1) / 4).alias("blocked"), (number(p % 3) / 4).alias("down"), F.lit(0.0).alias("ok"), (p % 3).alias("evidence"),
    )
    return R.lint(rules)


@query("text_decoding", """SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN text ELSE regexp_replace(text, '[^ -~]', '', 'g') || 'é' END) AS digest FROM documents""")
def text_decoding(spark, d):
    """Texts as bytes: even ones as they are, odd ones ended by a byte that is no UTF-8."""
    plain = F.regexp_replace("text", "[^ -~]", "")
    data = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(F.unhex(F.concat(F.hex(F.encode(plain, "UTF-8")), F.lit("E9"))))
    return frame(spark, d, "documents").select("doc_id", F.md5(F.encode(S.decoded(data), "UTF-8")).alias("digest"))


@query("cusum_store", SQL["cusum"])
def cusum_store(spark, d):
    """Two runs through the store, the second of them twice, leave the changes of one run over all hours."""
    hours, cut, root = IO.staged(series(spark, d), "series"), datetime(2024, 1, 15), IO.scratch_path(spark, "detector")
    DS.run_detector(hours.filter(F.col("ts") < F.lit(cut)), root, "first", **OPTIONS)
    for _ in range(2):
        DS.run_detector(hours.filter(F.col("ts") >= F.lit(cut)), root, "second", **OPTIONS)
    return DS.load(spark, root)[0].select("probe_cc", "probe_asn", "domain", "signal", "ts", "change_dir", "s_pos", "s_neg", "current_state", "h")


@query("cusum_alone", f"SELECT * FROM ({SQL['cusum']}) WHERE domain IN ('d0.example', 'd3.example')")
def cusum_alone(spark, d):
    """A run of chosen domains from no state."""
    from netquill.operators import detect as D

    hours = D.hourly_series(frame(spark, d, "V"), domains=("d0.example", "d3.example"))
    return D.detect_changes(hours, **OPTIONS)[0].select("probe_cc", "probe_asn", "domain", "signal", "ts", "change_dir", "s_pos", "s_neg", "current_state", "h")


@query("written_days", "SELECT strftime(ts, '%Y-%m-%d') AS bucket_date, event_id FROM events")
def written_days(spark, d):
    """Events written by day, half of the days a second time."""
    path = IO.scratch_path(spark, "days")
    rows = frame(spark, d, "events").select("event_id", F.col("ts").alias("measurement_start_time"))
    IO.write_partitioned(rows, path, sort=["event_id"])
    IO.write_partitioned(rows.filter(F.day("measurement_start_time") % 2 == 0), path, sort=["event_id"])
    return IO.read_partitioned(spark, path).select(F.date_format("bucket_date", "yyyy-MM-dd").alias("bucket_date"), "event_id")


@query("refreshed_table", "SELECT s_suppkey, s_name FROM supplier")
def refreshed_table(spark, d):
    """A reference table of two versions; a third is too small to be published."""
    root, table = IO.scratch_path(spark, "reference"), frame(spark, d, "supplier").select("s_suppkey", "s_name")
    n = table.count()
    versions.refresh(table.filter("s_suppkey % 2 = 0"), root, "half", 0, n)
    versions.refresh(table, root, "whole", n // 2, n + 1)
    try:
        versions.refresh(table.filter("s_suppkey < 0"), root, "none", 0, n)
    except ValueError:
        pass
    return versions.read(spark, root, "table")


@query("fp_index", """WITH p AS (SELECT CAST(item_id AS VARCHAR) AS name, 'contains' AS kind, substr(text, 5, 20) AS pattern FROM benchmark WHERE length(text) > 40 UNION ALL SELECT item_id || ' start', 'prefix', substr(text, 1, 12) FROM benchmark WHERE length(text) > 40
  UNION ALL SELECT item_id || ' short', 'contains', substr(text, 1, 2) FROM benchmark WHERE length(text) > 40 AND item_id % 2 = 0)
SELECT doc_id, name FROM documents JOIN p ON CASE kind WHEN 'contains' THEN contains(text, pattern) ELSE starts_with(text, pattern) END""")
def fp_index(spark, d):
    """Passages of the benchmark as fingerprints of documents; those of two characters have no entry in the index."""
    b = frame(spark, d, "benchmark").filter("length(text) > 40")
    made = lambda df, end, kind, a, n: df.select(F.concat(F.col("item_id").cast("string"), F.lit(end)).alias("name"), F.lit("nat").alias("scope"), F.lit("body").alias("location_found"), F.lit(kind).alias("pattern_type"), F.substring("text", a, n).alias("pattern"))
    patterns = made(b, "", "contains", 5, 20).unionByName(made(b, " start", "prefix", 1, 12)).unionByName(made(b.filter("item_id % 2 = 0"), " short", "contains", 1, 2))
    return E.match_fingerprints(frame(spark, d, "documents"), patterns, "text", "doc_id").select("doc_id", "name")
