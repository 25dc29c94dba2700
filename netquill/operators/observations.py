"""From raw measurements to observations, in one pass over the rows.

The arrays of a measurement are paired inside it and then exploded, a row a pairing, of which the columns are made:
nothing is shuffled and no test has a scan of its own: what the tests differ in is which arrays they pair.
Python sees the addresses and transaction ids alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.functions.scalars import host_of, is_bogon, let, normal_failure
from netquill.operators import enrich as E
from netquill.operators import flatten as L
from netquill.schemas import _EVENT, _QUERY, _REQUEST, _TCP, _TLS, TEST_KEYS, TEST_NAMES
from netquill.sources.io import staged

ARRAYS = {"queries": _QUERY, "tcp_connect": _TCP, "tls_handshakes": _TLS, "network_events": _EVENT, "requests": _REQUEST}
ALL = tuple(ARRAYS)
PLATFORMS = ("telegram", "whatsapp", "signal", "facebook_messenger")
PART = "struct<target_id:string," + ",".join(f"{n}:array<{kind}>" for n, kind in ARRAYS.items()) + ">"


def part(target: Column | None = None, **arrays: Column) -> Column:
    """Arrays that are paired with each other, and the target that they belong to. They have the types of a
    measurement (see :func:`typed_keys`)."""
    own = [(arrays[n] if n in arrays else F.lit(None).cast(f"array<{kind}>")).alias(n) for n, kind in ARRAYS.items()]
    return F.struct((F.lit(None) if target is None else target).cast("string").alias("target_id"), *own)


def typed_keys(msmts: DataFrame) -> dict[str, Column]:
    """The test keys of complete measurements, cast only where their type is another than a measurement's: a cast
    that changes nothing but what may be NULL would copy every element."""
    have = msmts.schema["test_keys"].dataType
    wanted = T._parse_datatype_string(TEST_KEYS).fields
    same = lambda f: have[f.name].dataType.simpleString() == f.dataType.simpleString()
    return {f.name: F.col(f"test_keys.{f.name}") if same(f) else F.col(f"test_keys.{f.name}").cast(f.dataType) for f in wanted}


def own(*names: str):
    """One part of a test's own arrays."""
    return lambda keys: F.array(part(**{n: keys[n] for n in names}))


def each_target(*names: str):
    """A part for each target of a map, in its order."""
    return lambda keys: F.transform(F.map_entries(keys["targets"]), lambda e: part(e["key"], **{n: e["value"][n] for n in names}))


def _lookups(keys: dict[str, Column]) -> Column:
    names = ("queries", "tcp_connect", "tls_handshakes", "requests")
    rest = F.transform(F.map_values(keys["lookups"]), lambda v: part(**{n: v[n] for n in names}))
    return F.concat(F.array(part(queries=keys["bootstrap"]["queries"])), F.coalesce(rest, F.array().cast(f"array<{PART}>")))


def _ech(keys: dict[str, Column]) -> Column:
    return F.array(part(**{n: keys[n] for n in ("queries", "tcp_connect", "network_events")}, tls_handshakes=L.ech_handshakes(keys)))


#: the parts that each test pairs; None: a test with one row a measurement and nothing to pair
BRANCHES = {
    "web_connectivity": own(*ALL),
    "urlgetter": own(*ALL),
    "echcheck": _ech,
    "stunreachability": own("queries"),
    "telegram": own(*ALL),
    "whatsapp": own(*ALL),
    "signal": own(*ALL),
    "facebook_messenger": own("queries", "tcp_connect"),
    "tor": each_target(*ALL),
    "dnscheck": _lookups,
    "browser_web": None,
    "http_header_field_manipulation": None,
    "http_invalid_request_line": None,
}


def sides(parts: Column) -> Column:
    """Each part with the addresses by which its sides are paired. Of queries, connections and handshakes nothing else is
    made in the row: columns are made once they are rows, as compiled code. Transactions keep what those are made of."""

    def of(p: Column) -> Column:
        h = p["tls_handshakes"]
        return F.struct(
            *[p[n].alias(n) for n in ("target_id", "queries", "tcp_connect", "tls_handshakes")], L.windowed(p["network_events"], h, _EVENT).alias("own"),
            L.http_carried(p["requests"]).alias("http"), L.dns_addresses(p["queries"]).alias("dns_ip"), L.tcp_addresses(p["tcp_connect"]).alias("tcp_ip"),
            F.transform(h, lambda x: host_of(x["address"])).alias("tls_ip"),
        )

    return F.transform(parts, of)


def elements(p: Column, i: Column) -> Column:
    """The elements of a pairing, by its places in the arrays of its part; a query without its answers but the one."""

    def of(s: Column) -> Column:
        query = F.get(s["queries"], p["query"])
        asked = F.struct(*[query[n].alias(n) for n in ("hostname", "query_type", "engine", "failure", "transaction_id", "t")])
        shake = F.get(s["tls_handshakes"], p["tls"])
        return F.struct(
            (i + 1).alias("observation_idx"), s["target_id"].alias("target_id"), p.alias("_at"), F.when(p["query"].isNotNull(), asked).alias("_query"),
            F.get(query["answers"], p["answer"]).alias("_answer"), F.get(s["tcp_connect"], p["tcp"]).alias("_tcp"),
            F.when(p["tls"].isNotNull(), L.carried_tls(shake, p["tls"], s["own"], _EVENT, F.get(s["tls_ip"], p["tls"]))).alias("_tls"),
            F.get(s["http"], p["http"]).alias("_http"),
        )

    return let(F.get("_sides", p["part"]), of)


def observations(msmts: DataFrame, tests: tuple = TEST_NAMES, probe_cc: tuple = ()) -> DataFrame:
    """Observations of all measurements of the wanted tests and countries; rows of other tests give nothing.

    One row a connection: what was asked of DNS, and the TCP, TLS and HTTP attempts that belong to the answer, by
    transaction id or by address, beside the measurement and the probe. A name that neither DNS nor URL nor server
    name tells is that of the input if the control resolved it to the address. The two middlebox tests and the
    browser test have one row a measurement."""
    unknown = set(tests) - set(BRANCHES)
    if unknown:
        raise ValueError(f"unknown tests {sorted(unknown)}")
    rows = L.gate(L.complete(msmts).filter(F.col("test_name").isin(*tests)), probe_cc)
    keys, name = typed_keys(rows), F.col("test_name")
    parts = None
    for test, make in BRANCHES.items():
        if make and test in tests:
            parts = (F if parts is None else parts).when(name == test, make(keys))
    parts = F.array().cast(f"array<{PART}>") if parts is None else parts
    web = name == "web_connectivity"
    of = lambda test, value: F.when(name == test, value)
    header = L.header_field_failure(keys["requests"])
    once = {
        "probe_analysis": F.when(web, keys["blocking"]),
        "_hinted": F.when(web, keys["control"]["dns"]["addrs"]),
        "_host": F.when(web, F.nullif(F.lower(F.try_parse_url(F.col("input"), F.lit("HOST"))), F.lit(""))),
        "_browser_failure": of("browser_web", normal_failure(keys["failure"])),
        "_browser_runtime": of("browser_web", F.col("test_runtime")),
        "hfm_failure": of("http_header_field_manipulation", header),
        "hfm_success": of("http_header_field_manipulation", header.isNull()),
    }
    line = F.struct(*L.request_line_columns(keys["sent"], keys["received"]))
    meta, probe = L.meta_columns(rows), L.probe_columns()
    flat = rows.select(*meta, *probe, *[c.alias(n) for n, c in once.items()], of("http_invalid_request_line", line).alias("_line"), sides(parts).alias("_sides"))
    names = [c for c in flat.columns if c != "_sides"]
    pair = F.arrow_udf(L.paired, L.PAIRS)
    # the call stands between the rows of the sides and what reads them, so they are made once
    found = flat.withColumn("_pairs", pair(F.transform("_sides", L.sides_of)))
    single = [t for t in tests if BRANCHES[t] is None]
    alone = F.array(F.struct(*[F.lit(None).cast("int").alias(n) for n in L.PLACES]))
    pairs = F.when(name.isin(*single), alone).otherwise(F.col("_pairs")) if single else F.col("_pairs")
    # the outer form keeps the engine from making the rows once more for a filter before it
    out = found.select(*names, F.inline_outer(F.transform(pairs, elements)))
    out = out.filter("observation_idx IS NOT NULL")
    start, at = F.col("measurement_start_time"), lambda n: F.col(f"_at.{n}")
    made = {
        "dns": L.dns_fields(F.col("_query"), F.col("_answer"), at("query"), at("answer"), start), "tcp": L.tcp_fields(F.col("_tcp"), at("tcp"), start),
        "tls": L.tls_fields(F.col("_tls"), start), "http": L.http_fields(F.col("_http"), start),
    }
    side = {"dns": at("query"), "tcp": at("tcp"), "tls": at("tls"), "http": at("http")}
    # a side that is not there has no columns, not even their defaults
    wide = [F.when(side[n].isNotNull(), c).alias(f"{n}_{label}") for n, fields in made.items() for c, label in zip(fields, out.select(*fields).columns)]
    summary = F.when(at("tls").isNotNull(), L.handshake_summary(F.col("_tls.own")))
    out = out.withColumn("_shake", summary)
    shake = [F.col(f"_shake.{f.name}").alias(f"tls_handshake_{f.name}") for f in out.schema["_shake"].dataType.fields]
    lines = [F.col(f"_line.{f.name}").alias(f.name) for f in flat.schema["_line"].dataType.fields]
    kept = [c for c in names if not c.startswith("_")]
    out = out.select(*kept, "_hinted", "_host", "_browser_failure", "_browser_runtime", "observation_idx", "target_id", *wide, *shake, *lines)
    out = L.assemble(out)
    browser = name == "browser_web"
    target = E.platform_target(name, F.col("hostname"), F.col("ip"))
    return out.withColumns({
        "hostname": F.coalesce("hostname", F.when(F.array_contains("_hinted", F.col("ip")), F.col("_host"))),
        "target_id": F.when(name.isin(*PLATFORMS), target).otherwise(F.col("target_id")),
        "http_failure": F.when(browser, F.col("_browser_failure")).otherwise(F.col("http_failure")),
        "http_runtime": F.when(browser, F.col("_browser_runtime")).otherwise(F.col("http_runtime")),
        "ip_is_bogon": F.when(F.col("ip").isNotNull(), is_bogon(F.col("ip"))),
    }).drop("_hinted", "_host", "_browser_failure", "_browser_runtime")


def _renamed(rows: DataFrame, found: DataFrame, ip: str, names: dict[str, str]) -> DataFrame:
    """Rows with what was found of an address under the given names, in place of what they held where it was."""
    out = E.join_snapshots(rows.withColumnsRenamed({a: f"_old_{a}" for a in names if a in rows.columns}), found, ip)
    here = F.coalesce(F.col(ip) != "", F.lit(False))
    old = lambda a: F.col(f"_old_{a}") if a in rows.columns else F.lit(None)
    kept = [c for c in rows.columns if c not in names]
    return out.select(*kept, *[F.when(here, F.col(b)).otherwise(old(a)).alias(a) for a, b in names.items()])


def with_networks(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Network and country of ``ip`` as of the day, of rows that :func:`looked_up` gave; rows without an address have
    none."""
    return _renamed(rows, found, "ip", {"ip_asn": "asn", "ip_as_org_name": "org", "ip_as_cc": "as_cc", "ip_cc": "cc"})


def with_resolver_networks(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The resolver's network as of the day. One that hides its address keeps the network that the probe told."""
    return _renamed(rows, found, "resolver_ip", {"resolver_asn": "asn", "resolver_as_org_name": "org", "resolver_as_cc": "as_cc", "resolver_cc": "cc"})


def with_probe_names(rows: DataFrame, seen: DataFrame, asnmeta: DataFrame) -> DataFrame:
    """Organisation, country and name of the probe's network as of the day, one lookup for each network and day of
    ``seen``, the same rows before other joins."""
    spots = seen.select("probe_asn", F.date_trunc("day", "measurement_start_time").alias("_day")).distinct()
    names = E.enrich_asn(spots, asnmeta, day="_day").withColumnsRenamed({"org_name": "probe_as_org_name", "cc": "probe_as_cc", "aut_name": "probe_as_name"})
    dated = rows.withColumn("_day", F.date_trunc("day", "measurement_start_time"))
    return dated.join(staged(names, "probe_names"), ["probe_asn", "_day"], "left").drop("_day")


def for_verdicts(rows: DataFrame) -> DataFrame:
    """Flags as the numbers that the rules compare."""
    flags = [f.name for f in rows.schema.fields if f.dataType.typeName() == "boolean"]
    return rows.withColumns({c: F.col(c).cast("int") for c in flags})


def looked_up(tables: list[tuple[DataFrame, tuple]], ranges: DataFrame, prefixes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables with the snapshots of their days, and the networks of what stands in their named columns of addresses. Days
    are dated first, so that an address is looked up once a snapshot, on however many days it was met."""
    day = F.date_trunc("day", "measurement_start_time").alias("day")
    both = E.address_ranges(ranges, prefixes)
    days = reduce(DataFrame.unionByName, [rows.select(day).distinct() for rows, _ in tables]).distinct()
    dates = staged(E.snapshot_dates(days, both), "dates")
    dated = [rows.withColumn("day", day).join(dates, "day", "left").drop("day") for rows, _ in tables]
    spots = reduce(DataFrame.unionByName, [E.snapshot_spots(rows, ip) for rows, (_, names) in zip(dated, tables) for ip in names]).distinct()
    return dated, staged(E.snapshot_networks(staged(spots, "addresses"), both), "networks")


def raw_control_rows(msmts: DataFrame, ranges: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Control observations of raw web_connectivity measurements with networks, for those who read nothing else."""
    (told,), found = looked_up([(staged(_control(msmts), "control"), ("ip",))], ranges, prefixes)
    return _finished(with_networks(told, found))


def _control(msmts: DataFrame) -> DataFrame:
    return L.control_of(L.gate(msmts.filter("test_name = 'web_connectivity'")))


def _finished(rows: DataFrame) -> DataFrame:
    return for_verdicts(rows.drop("four", "six"))


def _observed(msmts: DataFrame, columns: tuple) -> DataFrame:
    """Staged observations of web_connectivity measurements: the columns that are asked for, and those that
    networks are looked up by or put in place of; all without any asked for."""
    rows = observations(msmts, ("web_connectivity",))
    own = {*columns, "measurement_start_time", "ip", "resolver_ip", "resolver_asn", "resolver_as_org_name", "probe_asn"}
    return staged(rows.select(*[c for c in rows.columns if c in own]) if columns else rows, "observations")


def _enriched(dated: DataFrame, found: DataFrame, asnmeta: DataFrame | None) -> DataFrame:
    own = with_resolver_networks(with_networks(dated, found), found)
    return _finished(own if asnmeta is None else with_probe_names(own, dated, asnmeta))


def raw_observation_rows(
    msmts: DataFrame, ranges: DataFrame, prefixes: DataFrame, asnmeta: DataFrame | None = None, columns: tuple = ()
) -> DataFrame:
    """Observations of raw web_connectivity measurements with networks, for those who read no control. ``columns``: what
    is read of the observations; no others are made and staged."""
    (seen,), found = looked_up([(_observed(msmts, columns), ("ip", "resolver_ip"))], ranges, prefixes)
    return _enriched(seen, found, asnmeta)


def raw_verdict_inputs(
    msmts: DataFrame, ranges: DataFrame, prefixes: DataFrame, asnmeta: DataFrame | None = None, columns: tuple = ()
) -> tuple[DataFrame, DataFrame]:
    """Observations (see :func:`raw_observation_rows`) and control observations of raw web_connectivity measurements,
    with networks, as :func:`netquill.operators.verdicts.web_verdicts` takes them. Both are staged, and the distinct
    addresses of a snapshot are looked up once for all their uses."""
    seen, told = _observed(msmts, columns), staged(_control(msmts), "control")
    (seen, told), found = looked_up([(seen, ("ip", "resolver_ip")), (told, ("ip",))], ranges, prefixes)
    return _enriched(seen, found, asnmeta), _finished(with_networks(told, found))
