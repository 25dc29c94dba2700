"""Queries over enrichment joins and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from netquill.functions import scalars as S
from netquill.operators import enrich as E
from netquill.operators import text as X
from netquill.plans.catalog import query
from netquill.plans.standins import ctes, frame

RB = ctes("RANGES")


@query("asof_snapshot", f"""{RB} SELECT o_orderkey, coalesce((SELECT max(snapshot) FROM ranges WHERE snapshot <= o_orderdate), (SELECT min(snapshot) FROM ranges)) AS snapshot FROM orders""")
def asof_snapshot(spark, d):
    return E.asof_snapshot(frame(spark, d, "orders").select("o_orderkey", "o_orderdate"), frame(spark, d, "RANGES"), "o_orderdate").select("o_orderkey", "snapshot")


@query("range_join", f"""{RB}, s AS (SELECT o_orderkey, o_custkey % 2600 AS p, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '1995-01-01' END AS snapshot, o_custkey % 50 = 0 AS bogon FROM orders),
x AS (SELECT s.*, r.asn, r.org, r.cc, row_number() OVER (PARTITION BY o_orderkey ORDER BY r.prefix_len DESC NULLS LAST, r.first) AS k FROM s LEFT JOIN ranges r ON s.snapshot = r.snapshot AND s.p BETWEEN r.first AND r.last)
SELECT o_orderkey, CASE WHEN bogon THEN 64666 ELSE coalesce(asn, 0) END AS asn, CASE WHEN bogon THEN 'Bogon' ELSE coalesce(org, '') END AS org, CASE WHEN bogon THEN 'ZZ' ELSE coalesce(cc, 'ZZ') END AS cc FROM x WHERE k = 1""")
def range_join(spark, d):
    orders = frame(spark, d, "orders").select("o_orderkey", "o_orderdate", (F.col("o_custkey") % 2600).alias("p"), (F.col("o_custkey") % 50 == 0).alias("bogon"))
    ranges = frame(spark, d, "RANGES").withColumn("as_cc", F.col("cc"))
    return E.enrich_ip(orders, ranges, "p", F.col("bogon"), "o_orderdate", bucket=64).select("o_orderkey", "asn", "org", "cc")


@query("asof_join", """WITH h AS (SELECT l_partkey % 500 AS k, l_shipdate AS changed, min(l_suppkey) AS v FROM lineitem GROUP BY ALL),
s AS (SELECT o_orderkey, o_custkey % 500 AS k, o_orderdate AS day FROM orders),
a AS (SELECT s.o_orderkey, arg_max(h.v, h.changed) AS v FROM s JOIN h ON s.k = h.k AND h.changed <= s.day GROUP BY ALL), f AS (SELECT k, arg_min(v, changed) AS v FROM h GROUP BY k)
SELECT s.o_orderkey, coalesce(a.v, f.v) AS v FROM s LEFT JOIN a USING (o_orderkey) LEFT JOIN f ON s.k = f.k""")
def asof_join(spark, d):
    history = frame(spark, d, "lineitem").groupBy((F.col("l_partkey") % 500).alias("k"), F.col("l_shipdate").alias("changed")).agg(F.min("l_suppkey").alias("v"))
    rows = frame(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 500).alias("k"), F.col("o_orderdate").alias("day"))
    return E.asof_join(rows, history, "k", "day", "changed", ["v"]).select("o_orderkey", "v")


@query("fp_join_full", """WITH f AS (SELECT s_nationkey AS k, list_sort(list_distinct(flatten(list(['c' || (s_suppkey % 4), 'c' || (s_suppkey % 3)])))) AS cs FROM supplier GROUP BY ALL)
SELECT n_nationkey, array_to_string(coalesce(cs, []), ',') AS expected, CASE WHEN cs IS NULL THEN '' ELSE 'nat' END AS scope FROM nation LEFT JOIN f ON n_nationkey = k""")
def fp_join_full(spark, d):
    from netquill.operators.verdicts import full_fingerprints

    c = lambda m: F.concat(F.lit("c"), (F.col("s_suppkey") % m).cast("string"))
    fps = frame(spark, d, "supplier").select(
        F.lit("full").alias("pattern_type"), F.col("s_nationkey").cast("string").alias("pattern"), F.lit("nat").alias("scope"), F.concat(c(4), F.lit(" , "), c(3)).alias("expected_countries")
    )
    out = frame(spark, d, "nation").withColumn("pattern", F.col("n_nationkey").cast("string")).join(full_fingerprints(fps), "pattern", "left")
    return out.select("n_nationkey", F.array_join(F.coalesce("expected_countries", F.array().cast("array<string>")), ",").alias("expected"), F.coalesce("dns_blocking_scope", F.lit("")).alias("scope"))


PATTERNS = [
    ("starts", "nat", "body", "prefix", "The "),
    ("holds", "isp", "body", "contains", "worthless"),
    ("license", "fp", "body", "contains", "License"),
    ("digits", "nat", "body", "regexp", "[0-9]{3,}.*x"),
    ("source", "isp", "header.source", "regexp", "^src1"),
    ("ignored", "isp", "header.source", "contains", "src"),
    ("page", "nat", "body", "contains", "<nav>"),
]


def patterns(spark):
    return spark.createDataFrame(PATTERNS, "name string, scope string, location_found string, pattern_type string, pattern string")


@query("fp_match", """SELECT doc_id, 'starts' AS name, 'nat' AS scope FROM documents WHERE starts_with(text, 'The ') UNION ALL SELECT doc_id, 'holds', 'isp' FROM documents WHERE contains(text, 'worthless')
UNION ALL SELECT doc_id, 'license', 'fp' FROM documents WHERE contains(text, 'License') UNION ALL SELECT doc_id, 'digits', 'nat' FROM documents WHERE regexp_matches(text, '(?s)[0-9]{3,}.*x')
UNION ALL SELECT doc_id, 'page', 'nat' FROM documents WHERE contains(text, '<nav>') UNION ALL SELECT doc_id, 'source', 'isp' FROM documents WHERE regexp_matches(source, '^src1')""")
def fp_match(spark, d):
    return E.match_fingerprints(frame(spark, d, "documents"), patterns(spark), "text", "doc_id", {"source": "source"})


@query("body_scan", """WITH b AS (SELECT DISTINCT html FROM pages WHERE html IS NOT NULL), h AS (SELECT sha1(html) AS digest, name, fp FROM b, LATERAL (SELECT 'page' AS name, 0 AS fp WHERE contains(html, '<nav>') UNION ALL SELECT 'holds', 0 WHERE contains(html, 'worthless')
  UNION ALL SELECT 'license', 1 WHERE contains(html, 'License') UNION ALL SELECT 'digits', 0 WHERE regexp_matches(html, '(?s)[0-9]{3,}.*x')) t)
SELECT digest, array_to_string(list_sort(list(name)), ',') AS names, max(fp) AS false_positive FROM h GROUP BY digest""")
def body_scan(spark, d):
    return E.body_scan(frame(spark, d, "pages"), patterns(spark)).select("digest", F.array_join("names", ",").alias("names"), "false_positive")


SUFFIX_RULES = [("com", "exact"), ("net", "exact"), ("org", "exact"), ("example.com", "exact"), ("example.net", "wildcard"), ("re.example.net", "exception")]


def suffix_rules(spark):
    return spark.createDataFrame(SUFFIX_RULES, "rule string, kind string")


_HOST = "coalesce(regexp_extract(url, '^https?://([^/?#:]+)', 1), '')"
_REG = f"""h AS (SELECT DISTINCT {_HOST} AS host FROM pages), l AS (SELECT host, string_split(host, '.') AS l, len(string_split(host, '.')) AS n FROM h WHERE host <> ''),
s AS (SELECT host, l, n, CASE WHEN host = 're.example.net' OR host LIKE '%.re.example.net' THEN 2 WHEN host LIKE '%.example.net' THEN 3 WHEN host = 'example.net' THEN 3 WHEN host = 'example.com' OR host LIKE '%.example.com' THEN 2 ELSE 1 END AS k FROM l),
reg AS (SELECT host, CASE WHEN n > k THEN array_to_string(l[n - k : n], '.') END AS registrable FROM s)"""


@query("registrable", f"WITH {_REG} SELECT page_id, {_HOST} AS hostname, registrable FROM pages LEFT JOIN reg ON {_HOST} = host")
def registrable(spark, d):
    return E.registrable_domain(E.page_hosts(frame(spark, d, "pages")).select("page_id", "hostname"), "hostname", suffix_rules(spark))


TARGETS = [
    ("exact", "m.ththth.example.net", "t-exact"), ("pattern", "^ththr", "t-pattern"), ("suffix", "example.net", "t-net"),
    ("suffix", "th.example.net", "t-th"), ("domain", "thther.example.org", "t-dom"), ("domain", "example.org", "t-org"),
]


def target_hosts(spark):
    return spark.createDataFrame(TARGETS, "kind string, value string, target string")


_TARGET = f"""mapped AS (SELECT page_id, {_HOST} AS hostname, CASE WHEN {_HOST} = 'm.ththth.example.net' THEN 't-exact' WHEN regexp_matches({_HOST}, '^ththr') THEN 't-pattern'
  WHEN {_HOST} = 'th.example.net' OR {_HOST} LIKE '%.th.example.net' THEN 't-th' WHEN {_HOST} = 'example.net' OR {_HOST} LIKE '%.example.net' THEN 't-net'
  WHEN registrable = 'example.org' THEN 't-org' END AS target FROM pages LEFT JOIN reg ON {_HOST} = host)"""


@query("target_resolve", f"WITH {_REG}, {_TARGET} SELECT page_id, hostname, target FROM mapped")
def target_resolve(spark, d):
    rows = E.page_hosts(frame(spark, d, "pages")).select("page_id", "hostname")
    return E.resolve_targets(rows, target_hosts(spark), suffix_rules(spark))


@query("target_rollup", f"""WITH {_REG}, {_TARGET}, c AS (SELECT DISTINCT hostname, 'K' || (length(hostname) % 3) AS category, CASE WHEN length(hostname) % 2 = 0 THEN 'ZZ' ELSE 'IT' END AS cc FROM mapped),
w AS (SELECT m.target, c.category, sum(CASE cc WHEN 'ZZ' THEN 2 ELSE 1 END) AS w FROM mapped m JOIN c ON m.hostname = c.hostname WHERE target IS NOT NULL GROUP BY ALL)
SELECT n.target, n_hosts, category, weight FROM (SELECT target, count(DISTINCT hostname) AS n_hosts FROM mapped WHERE target IS NOT NULL GROUP BY ALL) n
LEFT JOIN (SELECT target, arg_max(category, struct_pack(a := w, b := category)) AS category, CAST(max(w) AS BIGINT) AS weight FROM w GROUP BY target) b ON n.target = b.target""")
def target_rollup(spark, d):
    mapped = target_resolve(spark, d).select("hostname", "target")
    n = F.length("hostname")
    cats = mapped.select("hostname", F.concat(F.lit("K"), (n % 3).cast("string")).alias("category"), F.when(n % 2 == 0, "ZZ").otherwise("IT").alias("cc")).distinct()
    return E.target_rollup(mapped, cats)


@query("html_title", "SELECT page_id, coalesce(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages")
def html_title(spark, d):
    return frame(spark, d, "pages").select("page_id", S.html_title(F.col("html")).alias("title"))


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"id\":' || event_id || ',\"k\":' || json_extract(props, '$.k') || '}' AS out FROM events")
def json_props(spark, d):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return frame(spark, d, "events").select("event_id", k.alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), k.alias("k"))).alias("out"))


_BIT = lambda half, b: f"CAST(sum(CASE WHEN ({half} >> {b}) & 1 = 1 THEN n ELSE -n END) > 0 AS BIGINT) << {b}"


@query("simhash", f"""WITH s AS (SELECT doc_id, substr(text, u.i, 4) AS s, count(*) AS n FROM documents, unnest(range(1, length(text) - 2)) AS u(i) WHERE text IS NOT NULL GROUP BY ALL),
h AS (SELECT doc_id, n, CAST('0x' || substr(md5(s), 17, 8) AS BIGINT) AS hi, CAST('0x' || substr(md5(s), 25, 8) AS BIGINT) AS lo FROM s)
SELECT doc_id, {' + '.join(f'({_BIT("hi", b)})' for b in range(32))} AS simhash_high, {' + '.join(f'({_BIT("lo", b)})' for b in range(32))} AS simhash_low FROM h GROUP BY doc_id""")
def simhash(spark, d):
    return X.simhash(frame(spark, d, "documents").select("doc_id", "text"))
