"""From nested measurements to flat observations: projections that explode arrays, and the pairing of
what belongs to one connection."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.functions.scalars import host_of, host_port, is_ip, let, normal_failure, port_of, scrub_address
from netquill.schemas import _EVENT, HANDSHAKE, MEASUREMENT
from netquill.sources.io import staged

UNKNOWN = ("network_type", "platform", "origin", "engine_name", "engine_version", "architecture")
BAD_CERT = ("ssl_invalid_hostname", "ssl_unknown_authority", "ssl_invalid_certificate")


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def gate(msmts: DataFrame, probe_cc: tuple = ()) -> DataFrame:
    """Rows with test keys, of the wanted countries."""
    rows = msmts.filter(F.col("test_keys").isNotNull())
    return rows.filter(F.col("probe_cc").isin(*probe_cc)) if probe_cc else rows


def complete(msmts: DataFrame) -> DataFrame:
    """``msmts`` with every column and test key of a measurement; absent ones are NULL. The values of those that
    are there stay as they are."""
    full = T._parse_datatype_string(MEASUREMENT)
    have = {f.name for f in msmts.schema["test_keys"].dataType.fields}
    keys = F.struct(*[
        F.col(f"test_keys.{f.name}").alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in full["test_keys"].dataType.fields
    ])
    missing = {f.name: F.lit(None).cast(f.dataType) for f in full.fields if f.name not in msmts.columns}
    return msmts.withColumns(missing | {"test_keys": F.when(F.col("test_keys").isNotNull(), keys)})


def start_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def event_time(start: Column, t: Column) -> Column:
    """Start plus ``t`` seconds; the start itself when t is NULL or 0."""
    return F.when(F.coalesce(t, F.lit(0.0)) == 0, start).otherwise(F.timestamp_micros(F.unix_micros(start) + F.round(t * 1e6).cast("bigint")))


def meta_columns(msmts: DataFrame) -> list[Column]:
    """uid, report, input (a list joined by ``:``), run link, start time, test and software."""
    kind = msmts.schema["input"].dataType.typeName()
    text = F.array_join("input", ":") if kind == "array" else F.col("input")
    link = F.coalesce("run_link_id", F.lit("")) if "run_link_id" in msmts.columns else F.lit("")
    return [
        F.col("measurement_uid"), F.col("report_id"), text.alias("input"), link.alias("run_link_id"),
        start_time(F.col("measurement_start_time")).alias("measurement_start_time"), F.col("test_name"), F.col("software_name"), F.col("software_version"),
    ]


def measurement_meta(msmts: DataFrame) -> DataFrame:
    """:func:`meta_columns` of each measurement."""
    return msmts.select(*meta_columns(msmts))


def probe_meta(msmts: DataFrame) -> DataFrame:
    """:func:`probe_columns` of each measurement."""
    return msmts.select("measurement_uid", *probe_columns())


def probe_columns() -> list[Column]:
    """Networks without their prefix, annotations with defaults, and what is known of the resolver."""
    scrubbed = F.coalesce((F.col("test_keys.client_resolver") == "[scrubbed]") | (F.col("resolver_ip") == "[scrubbed]"), F.lit(False))
    address = F.coalesce(F.nullif("resolver_ip", F.lit("")), F.col("test_keys.client_resolver"), F.lit(""))
    asn = F.coalesce(F.expr("try_cast(substring(resolver_asn, 3) AS BIGINT)"), F.lit(0).cast("bigint"))
    hidden = address == "[scrubbed]"
    note = lambda k: F.coalesce(F.try_element_at("annotations", F.lit(k)), F.lit("unknown")).alias(k)
    return [
        F.expr("try_cast(substring(probe_asn, 3) AS BIGINT)").alias("probe_asn"), F.col("probe_cc"), *[note(k) for k in UNKNOWN],
        F.when(hidden, F.lit("")).otherwise(address).alias("resolver_ip"),
        F.when(hidden, asn).otherwise(F.lit(0)).alias("resolver_asn"),
        F.when(hidden, F.coalesce("resolver_network_name", F.lit(""))).otherwise(F.lit("")).alias("resolver_as_org_name"),
        asn.alias("resolver_asn_probe"), F.coalesce("resolver_network_name", F.lit("")).alias("resolver_as_org_name_probe"),
        scrubbed.alias("resolver_is_scrubbed"), F.coalesce("probe_id", F.lit("")).alias("probe_id"),
    ]


def _answer(a: Column) -> Column:
    return F.coalesce(a["ipv4"], a["ipv6"], a["hostname"])


def _answers(q: Column) -> Column:
    """The answers of a query, a NULL one if it has none."""
    return F.when(F.size(q["answers"]) > 0, q["answers"]).otherwise(F.array(F.get(q["answers"], F.lit(0))))


def dns_fields(q: Column, a: Column, i: Column, j: Column, start: Column) -> list[Column]:
    answer = _answer(a)
    return [
        i.alias("query_pos"), j.alias("answer_pos"), q["hostname"].alias("hostname"), q["query_type"].alias("query_type"),
        q["engine"].alias("engine"), normal_failure(q["failure"]).alias("failure"), answer.alias("answer"),
        F.coalesce(a["asn"], F.lit(0)).alias("answer_asn"), F.coalesce(a["as_org_name"], F.lit("")).alias("answer_as_org_name"),
        q["transaction_id"].alias("transaction_id"), event_time(start, q["t"]).alias("ts"), F.when(is_ip(answer), answer).alias("ip"),
    ]


def dns_rows(queries: Column, start: Column) -> Column:
    """One row a query and answer; a query without answers has one row with a NULL answer."""

    def of(q: Column, i: Column) -> Column:
        some = F.size(q["answers"]) > 0
        return F.transform(_answers(q), lambda a, j: F.struct(*dns_fields(q, a, i, F.when(some, j), start)))

    return F.flatten(F.transform(queries, of))


def dns_addresses(queries: Column) -> Column:
    """The address of each row of :func:`dns_rows`, NULL without one."""

    def address(a: Column) -> Column:
        return F.when(is_ip(_answer(a)), _answer(a))

    return F.flatten(F.transform(queries, lambda q: F.transform(_answers(q), address)))


def tcp_fields(c: Column, i: Column, start: Column) -> list[Column]:
    return [
        i.alias("pos"), scrub_address(c["ip"]).alias("ip"), c["port"].alias("port"), c["status"]["success"].alias("success"),
        normal_failure(c["status"]["failure"]).alias("failure"), c["transaction_id"].alias("transaction_id"), event_time(start, c["t"]).alias("ts"),
    ]


def _connected(ip: Column) -> Column:
    return is_ip(ip) | (ip == "scrubbed")


def tcp_addresses(connects: Column) -> Column:
    """The address of each connection attempt, NULL for one that is to none; scrubbed addresses stay."""

    def address(c: Column) -> Column:
        return F.when(_connected(scrub_address(c["ip"])), scrub_address(c["ip"]))

    return F.transform(connects, address)


def _start(msmts: DataFrame) -> Column:
    return start_time(F.col("measurement_start_time"))


def _exploded(msmts: DataFrame, array: Column, first: str = "pos") -> DataFrame:
    """The structs of ``array`` as rows; ``first`` is never NULL in them. The outer form keeps the engine from
    making the array once more for a filter before it."""
    made = msmts.select("measurement_uid", array.alias("_rows"))
    return made.select("measurement_uid", F.inline_outer("_rows")).filter(F.col(first).isNotNull())


def explode_dns(msmts: DataFrame, path: str = "test_keys.queries") -> DataFrame:
    """:func:`dns_rows` as rows."""
    return _exploded(msmts, dns_rows(F.col(path), _start(msmts)), "query_pos")


def _elements(msmts: DataFrame, array: Column, *more: Column) -> DataFrame:
    """(measurement_uid, _start, more, _i, _x): the elements of ``array`` as rows with their places, before anything is
    made of them: columns of rows are compiled, the bodies of array functions are not."""
    made = msmts.select("measurement_uid", _start(msmts).alias("_start"), *more, array.alias("_rows"))
    kept = [c for c in made.columns if c != "_rows"]
    return made.select(*kept, F.posexplode_outer("_rows").alias("_i", "_x")).filter(F.col("_i").isNotNull())


def explode_tcp(msmts: DataFrame, path: str = "test_keys.tcp_connect") -> DataFrame:
    """One row a connection attempt to an address (see :func:`tcp_addresses`)."""
    rows = _elements(msmts, F.col(path))
    return rows.select("measurement_uid", *tcp_fields(F.col("_x"), F.col("_i"), F.col("_start"))).filter(_connected(F.col("ip")))


def certificate_valid(no_verify: Column, failure: Column) -> Column:
    """False for a bad certificate, true for a verified handshake, else NULL."""
    return F.when(F.coalesce(no_verify, F.lit(False)), _none("boolean")).when(failure.isin(*BAD_CERT), F.lit(False)).when(failure.isNull(), F.lit(True))


def event_windows(events: Column, kind: str) -> Column:
    """The stretches of ``events`` (structs of type ``kind``) from a ``connect`` to ``tls_handshake_done``."""
    none = F.array().cast(f"array<{kind}>")
    zero = F.struct(F.array().cast(f"array<array<{kind}>>").alias("done"), none.alias("open"))

    def step(acc: Column, e: Column) -> Column:
        grown = F.when(e["operation"] == "connect", F.array(e)).otherwise(F.concat(acc["open"], F.array(e)))
        ends = e["operation"] == "tls_handshake_done"
        return F.struct(
            F.when(ends, F.concat(acc["done"], F.array(grown))).otherwise(acc["done"]).alias("done"),
            F.when(ends, none).otherwise(grown).alias("open"),
        )

    return F.aggregate(events, zero, step, lambda acc: acc["done"])


def own_events(events: Column, windows: Column, kind: str, tid: Column, t: Column, pos: Column) -> Column:
    """Events of a handshake: those of its transaction, ordered by time. Without transaction ids: the
    window that ends at the handshake's time; of several, the one at the handshake's own place; else none."""
    by_id = F.array_sort(
        F.filter(events, lambda e: e["transaction_id"] == tid),
        lambda x, y: F.when(x["t"] < y["t"], -1).when(x["t"] > y["t"], 1).otherwise(0),
    )
    fitting = F.filter(windows, lambda w: F.element_at(w, -1)["t"] == t)
    own = F.get(windows, pos)
    chosen = let(fitting, lambda f: F.when(F.size(f) == 1, F.get(f, F.lit(0))).when((F.size(f) > 1) & (F.element_at(own, -1)["t"] == t), own))
    return F.when(F.coalesce(tid, F.lit(0)) != 0, by_id).otherwise(F.coalesce(chosen, F.array().cast(f"array<{kind}>")))


def handshake_events(tls: DataFrame, events: str = "events") -> Column:
    """:func:`own_events` of rows with events, transaction_id, t and pos."""
    kind = tls.schema[events].dataType.elementType.simpleString()
    return own_events(F.col(events), event_windows(F.col(events), kind), kind, F.col("transaction_id"), F.col("t"), F.col("pos"))


def handshake_summary(events: Column) -> Column:
    """struct(time, read_count, read_bytes, write_count, write_bytes, last_operation) of ordered events.
    Only operations that moved bytes count."""
    zero = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in ("read_count", "read_bytes", "write_count", "write_bytes")], F.lit("").alias("last_operation"))

    def step(a: Column, e: Column) -> Column:
        moved = F.coalesce(e["num_bytes"], F.lit(0)) > 0
        is_ = lambda op: (e["operation"] == op) & moved
        count = lambda op: a[f"{op}_count"] + F.when(is_(op), 1).otherwise(0)
        total = lambda op: a[f"{op}_bytes"] + F.when(is_(op), e["num_bytes"]).otherwise(0)
        label = F.when(is_("read"), F.concat(F.lit("read_"), count("read").cast("string"))).when(is_("write"), F.concat(F.lit("write_"), count("write").cast("string")))
        return F.struct(
            count("read").alias("read_count"), total("read").alias("read_bytes"), count("write").alias("write_count"),
            total("write").alias("write_bytes"), F.coalesce(label, a["last_operation"]).alias("last_operation"),
        )

    span = F.when(F.size(events) > 0, F.element_at(events, -1)["t"] - F.get(events, F.lit(0))["t"])
    # bound once, so that the fold does not run once a field
    bound = F.transform(F.array(F.aggregate(events, zero, step)), lambda s: F.struct(span.alias("time"), *[s[n].alias(n) for n in ("read_count", "read_bytes", "write_count", "write_bytes", "last_operation")]))
    return F.get(bound, F.lit(0))


def carried_tls(h: Column, i: Column, x: Column, kind: str, ip: Column | None = None) -> Column:
    """What :func:`tls_fields` reads of a handshake: its address (``ip``, if it is known) and id, its place, its own
    events and itself."""
    none = F.array().cast(f"array<{kind}>")
    own = F.when(F.size(x["events"]) > 0, own_events(x["events"], x["windows"], kind, h["transaction_id"], h["t"], i)).otherwise(none)
    return F.struct((host_of(h["address"]) if ip is None else ip).alias("ip"), h["transaction_id"].alias("transaction_id"), i.alias("pos"), own.alias("own"), h.alias("h"))


def tls_fields(x: Column, start: Column) -> list[Column]:
    h, failure = x["h"], normal_failure(x["h"]["failure"])
    text = lambda c: F.coalesce(h[c], F.lit(""))
    return [
        x["pos"].alias("pos"), x["ip"].alias("ip"), port_of(h["address"]).alias("port"), text("server_name").alias("server_name"),
        text("outer_server_name").alias("outer_server_name"), text("echconfig").alias("echconfig"), text("tls_version").alias("version"),
        text("cipher_suite").alias("cipher_suite"), failure.alias("failure"),
        certificate_valid(h["no_tls_verify"], failure).alias("is_certificate_valid"),
        F.coalesce(F.size(h["peer_certificates"]), F.lit(0)).alias("chain_length"), chain_fingerprints(h["peer_certificates"]).alias("chain_fingerprints"),
        x["transaction_id"].alias("transaction_id"), h["t"].alias("t"), event_time(start, h["t"]).alias("ts"),
    ]


def windowed(events: Column, handshakes: Column, kind: str) -> Column:
    """The events and their windows, which only handshakes without a transaction id read."""
    none = F.array().cast(f"array<{kind}>")
    some = F.coalesce(events, none)
    asked = F.exists(handshakes, lambda h: F.coalesce(h["transaction_id"], F.lit(0)) == 0)
    windows = F.when(asked, event_windows(some, kind)).otherwise(F.array().cast(f"array<array<{kind}>>"))
    return F.struct(some.alias("events"), windows.alias("windows"))


def explode_tls(msmts: DataFrame, path: str = "test_keys.tls_handshakes") -> DataFrame:
    """One row a handshake with certificate fingerprints and a summary of its network events."""
    kind = msmts.select("test_keys.network_events").schema[0].dataType.elementType.simpleString()
    rows = _elements(msmts, F.col(path), windowed(F.col("test_keys.network_events"), F.col(path), kind).alias("_w"))
    rows = rows.select("measurement_uid", "_start", carried_tls(F.col("_x"), F.col("_i"), F.col("_w"), kind).alias("_h"))
    return rows.select("measurement_uid", *tls_fields(F.col("_h"), F.col("_start")), handshake_summary(F.col("_h.own")).alias("handshake"))


def chain_fingerprints(certificates: Column) -> Column:
    """SHA-256 of each decoded certificate after the first."""
    rest = F.when(F.size(certificates) > 1, F.slice(certificates, F.lit(2), F.size(certificates))).otherwise(F.filter(certificates, lambda c: F.lit(False)))
    return F.transform(rest, lambda c: F.sha2(F.unbase64(c["data"]), 256))


def header(headers: Column, name: str) -> Column:
    """First value of a header, whatever its case."""
    return F.get(F.filter(headers, lambda h: F.lower(F.get(h, F.lit(0))) == name), F.lit(0)).getItem(1)


def carried_http(r: Column, before: Column, i: Column) -> Column:
    """What :func:`http_fields` reads of a transaction and of the one before it; of bodies, length and digest."""
    body = r["response"]["body"]
    return F.struct(
        host_of(r["address"]).alias("ip"), r["transaction_id"].alias("transaction_id"), i.alias("pos"), r["request"].isNotNull().alias("sent"),
        *[r[n].alias(n) for n in ("address", "network", "alpn", "failure", "t", "t0")], r["request"]["url"].alias("url"), r["request"]["method"].alias("method"),
        r["response"]["code"].alias("code"), F.octet_length(body).alias("body_length"), F.sha1(body).alias("body_sha1"), r["response"]["headers_list"].alias("headers"),
        before["response"]["headers_list"].alias("before_headers"), before["request"]["url"].alias("before_url"),
    )


def http_carried(requests: Column) -> Column:
    """:func:`carried_http` of each transaction with a request; the array runs from the last request to the first,
    so the next element is the earlier one, and a redirect came from it if its Location is this URL."""
    return F.filter(F.transform(requests, lambda r, i: carried_http(r, F.get(requests, i + 1), i)), lambda x: x["sent"])


def http_fields(x: Column, start: Column) -> list[Column]:
    came = header(x["before_headers"], "location") == x["url"]
    return [
        x["pos"].alias("pos"), x["ip"].alias("ip"), port_of(x["address"]).alias("port"), x["url"].alias("request_url"), x["method"].alias("method"),
        F.when(x["network"] == "quic", "udp").otherwise(x["network"]).alias("network"), x["alpn"].alias("alpn"),
        normal_failure(x["failure"]).alias("failure"), (x["t"] - x["t0"]).alias("runtime"),
        x["code"].alias("status_code"), x["body_length"].alias("body_length"), x["body_sha1"].alias("body_sha1"),
        header(x["headers"], "location").alias("location"), header(x["headers"], "server").alias("server"),
        F.when(came, x["before_url"]).alias("redirect_from"), x["transaction_id"].alias("transaction_id"),
        event_time(start, x["t"]).alias("ts"),
    ]


def explode_http(msmts: DataFrame, path: str = "test_keys.requests") -> DataFrame:
    """One row a transaction with a request."""
    rows = _elements(msmts, F.col(path), F.col(path).alias("_all")).filter(F.col("_x.request").isNotNull())
    rows = rows.select("measurement_uid", "_start", carried_http(F.col("_x"), F.get("_all", F.col("_i") + 1), F.col("_i")).alias("_h"))
    return rows.select("measurement_uid", *http_fields(F.col("_h"), F.col("_start")))


def redirect_from(rows: DataFrame, keys: list[str], pos: str, url: str, location: str) -> DataFrame:
    """Redirect provenance of flat rows: the URL of the next row if its location is this URL."""
    after = F.lead(F.struct(url, location)).over(Window.partitionBy(*keys).orderBy(pos))
    return rows.withColumn("_n", after).withColumn("redirect_from", F.when(F.col(f"_n.{location}") == F.col(url), F.col(f"_n.{url}"))).drop("_n")


SIDES = ("dns", "tcp", "tls", "http")
#: flat rows that one task pairs, about
PAIRED = 1 << 18


def pair_by_address(dns: DataFrame, tcp: DataFrame, tls: DataFrame, http: DataFrame) -> DataFrame:
    """Pairing without transaction ids. Each side has (measurement_uid, ip, pos). A match takes the first
    row of its address that is left, so on every side the k-th row of an address goes with the k-th of
    the others, and a pairing starts from the first side that has it; rows without an address stand
    alone. One row a pairing: uid, ip, the four positions, and a running index from 1 (those that start
    from DNS first, then from TCP, TLS, HTTP; of equal positions the smaller address first, none last).
    The rows are counted and dealt by measurement once, in as many parts as keep a task's share near PAIRED,
    however many they are."""
    rows = None
    for i, (n, df) in enumerate(zip(SIDES, (dns, tcp, tls, http))):
        part = df.select("measurement_uid", "ip", F.col("pos").cast("int").alias("pos"), F.lit(i).alias("side"))
        rows = part if rows is None else rows.unionByName(part)
    parts = max(-(-rows.count() // PAIRED), rows.sparkSession.sparkContext.defaultParallelism)
    rows = rows.repartition(parts, "measurement_uid")
    k = F.row_number().over(Window.partitionBy("measurement_uid", "ip", "side").orderBy("pos"))
    # a row without an address is a group of its own
    group = F.when(F.col("ip").isNull(), F.col("side"))
    paired = rows.select("*", k.alias("k"), group.alias("alone")).groupBy("measurement_uid", "ip", "k", "alone").agg(
        *[F.max(F.when(F.col("side") == i, F.col("pos"))).alias(f"{n}_pos") for i, n in enumerate(SIDES)], F.min("side").alias("lead")
    )
    names = [f"{n}_pos" for n in SIDES]
    order = Window.partitionBy("measurement_uid").orderBy("lead", *[F.col(n).asc_nulls_last() for n in [*names, "ip"]])
    return paired.withColumn("observation_idx", F.row_number().over(order)).select("measurement_uid", "ip", *names, "observation_idx")


def _places(values: list) -> dict:
    """The places of each value that is one, the last first, so that the first one is popped first."""
    found = {}
    for i in range(len(values) - 1, -1, -1):
        if values[i]:
            found.setdefault(values[i], []).append(i)
    return found


class _Pool:
    """Rows of one side, by their places, taken by transaction id or address, the first that is left."""

    def __init__(self, ips: list, tids: list):
        self.ips, self.tids, self.used = ips, tids, [False] * len(ips)
        self.by_tid = self.by_ip = None

    def take(self, ip: str | None, tid: int | None) -> int | None:
        """The first row with this transaction id (0 is none), else the first with this address."""
        if not self.ips:
            return None
        if tid:
            if self.by_tid is None:
                self.by_tid = _places(self.tids)
            i = self.first(self.by_tid.get(tid))
            if i is not None:
                return i
        if ip:
            if self.by_ip is None:
                self.by_ip = _places(self.ips)
            return self.first(self.by_ip.get(ip))
        return None

    def first(self, queue: list | None) -> int | None:
        while queue:
            i = queue.pop()
            if not self.used[i]:
                self.used[i] = True
                return i
        return None


def pair_sides(sides: list[tuple[list, list]]) -> list[tuple[int | None, ...]]:
    """Pairing of one measurement's rows in order; each side is the addresses and the transaction ids of its rows.
    Each row of a side takes what is left of the later sides; those rows that none took stand alone. Places in the sides."""
    pools = [_Pool(*side) for side in sides]
    out = []
    for lead, (ips, tids) in enumerate(sides):
        later, used = pools[lead + 1 :], pools[lead].used
        alone = (None,) * lead
        for i, (ip, tid) in enumerate(zip(ips, tids)):
            if not used[i]:
                out.append((*alone, i, *[p.take(ip, tid) for p in later]))
    return out


def pair_record(sides: dict[str, list[dict]]) -> list[tuple[int | None, ...]]:
    """:func:`pair_sides` of rows with ip, transaction_id and pos; positions of dns, tcp, tls, http."""
    rows = [sides[n] or [] for n in SIDES]
    found = pair_sides([([r["ip"] for r in side], [r["transaction_id"] for r in side]) for side in rows])
    return [tuple(None if i is None else side[i]["pos"] for i, side in zip(places, rows)) for places in found]


PLACES = ("part", "query", "answer", "tcp", "tls", "http")
PAIRS = "array<struct<" + ",".join(f"{n}:int" for n in PLACES) + ">>"


def sides_of(s: Column) -> Column:
    """What :func:`paired` reads of a part: lists of addresses and ids of its sides, the ids of DNS a query, with
    how many answers it has."""
    return F.struct(
        s["dns_ip"].alias("dns_ip"), s["queries"]["transaction_id"].alias("dns_tid"), F.transform(s["queries"], lambda q: F.size(q["answers"])).alias("answers"),
        s["tcp_ip"].alias("tcp_ip"), s["tcp_connect"]["transaction_id"].alias("tcp_tid"),
        s["tls_ip"].alias("tls_ip"), s["tls_handshakes"]["transaction_id"].alias("tls_tid"),
        s["http"]["ip"].alias("http_ip"), s["http"]["transaction_id"].alias("http_tid"),
    )


def _lists(column: pa.Array, empty) -> tuple[list, list[int]]:
    """The values of lists, NULL ones as ``empty``, and where each list starts and the last one ends."""
    values = column.flatten()
    if empty is not None:
        values = values.fill_null(empty)
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    return values.to_numpy(zero_copy_only=False).tolist(), ends.tolist()


def paired(parts: pa.Array) -> pa.Array:
    """Pairing inside the row. A measurement has a list of parts as :func:`sides_of` gives them; it gets the list of
    what belongs together, as places in the arrays of a part."""
    each = parts.flatten()
    column = {each.type.field(i).name: c for i, c in enumerate(each.flatten())}
    lists = {n: _lists(c, None if n.endswith("_ip") else 0) for n, c in column.items()}
    cut = lambda n, k: lists[n][0][lists[n][1][k] : lists[n][1][k + 1]]
    out, ends, k = [], [0], 0
    for size in parts.value_lengths().fill_null(0).to_pylist():
        for part in range(size):
            # a row an answer, and one for a query without
            rows = [(q, a, tid) for q, (tid, n) in enumerate(zip(cut("dns_tid", k), cut("answers", k))) for a in (range(n) if n > 0 else (None,))]
            ips = cut("tcp_ip", k)
            connected = [i for i, ip in enumerate(ips) if ip is not None]
            tids = cut("tcp_tid", k)
            found = pair_sides([
                (cut("dns_ip", k), [r[2] for r in rows]), ([ips[i] for i in connected], [tids[i] for i in connected]),
                (cut("tls_ip", k), cut("tls_tid", k)), (cut("http_ip", k), cut("http_tid", k)),
            ])
            for dns, tcp, tls, http in found:
                q, a = (None, None) if dns is None else rows[dns][:2]
                out.append((part, q, a, None if tcp is None else connected[tcp], tls, http))
            k += 1
        ends.append(len(out))
    columns = zip(*out) if out else [()] * len(PLACES)
    found = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], list(PLACES))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)


def assemble(rows: DataFrame) -> DataFrame:
    """Address, port, host name and transaction id of a paired row. The address is that of the first side that has
    one; the name that was asked of DNS, else that of the URL, else the server name unless it is an
    address; the id that of TCP, TLS or HTTP. Columns are prefixed by side: dns_answer, tcp_ip, …"""
    ip = F.coalesce(F.when(is_ip(F.col("dns_answer")), F.col("dns_answer")), "tcp_ip", "tls_ip", "http_ip")
    sni = F.when(~is_ip(F.col("tls_server_name")), F.col("tls_server_name"))
    url = F.lower(F.try_parse_url("http_request_url", F.lit("HOST")))
    host = F.coalesce(*[F.nullif(x, F.lit("")) for x in (F.col("dns_hostname"), url, sni)])
    tid = F.coalesce(*[F.nullif(f"{n}_transaction_id", F.lit(0)) for n in SIDES[1:]])
    port = F.coalesce(*[F.nullif(f"{n}_port", F.lit(0)) for n in SIDES[1:]])
    return rows.select("*", ip.alias("ip"), port.alias("port"), host.alias("hostname"), tid.alias("transaction_id"))


def hint_hostnames(rows: DataFrame, hints: DataFrame) -> DataFrame:
    """Fill a missing host name from the control's (measurement_uid, ip, hint)."""
    one = hints.groupBy("measurement_uid", "ip").agg(F.min("hint").alias("hint"))
    return rows.join(one, ["measurement_uid", "ip"], "left").withColumn("hostname", F.coalesce("hostname", "hint")).drop("hint")


def control_rows(tcp: DataFrame, tls: DataFrame, dns: DataFrame, http: DataFrame | None = None) -> DataFrame:
    """Control observations of each measurement. tcp: (measurement_uid, endpoint, tcp_success, tcp_failure);
    tls: (…, endpoint, tls_success, tls_failure, tls_server_name); dns: (measurement_uid, hostname, failure,
    addrs). One row for a DNS failure, one an endpoint with both results, one a resolved address that no
    endpoint has, one for the control's own request (``http``: (measurement_uid, http_request_url, http_failure,
    http_response_body_length)); indexed from 0. An endpoint with TLS alone keeps its row.

    Endpoints are a full outer join of both layers, and the addresses that none of them has an anti join. Endpoints and
    names are staged, as both joins read them; endpoints and answers are dealt by measurement and meet there, and what else
    there is of a measurement is dealt to them, to be numbered."""
    by = ["measurement_uid", "ip"]
    dealt = lambda df: df.repartition("measurement_uid")
    ip, port = host_port(F.col("endpoint"))
    ends = tcp.join(tls, ["measurement_uid", "endpoint"], "full").select("*", ip.alias("ip"), port.alias("port")).drop("endpoint")
    ends = staged(ends, "endpoints")
    told = staged(dns.select("measurement_uid", "hostname", F.col("failure").alias("dns_failure"), F.array_distinct("addrs").alias("addrs")), "told")
    answers = told.select("measurement_uid", F.explode("addrs").alias("ip")).filter("ip IS NOT NULL")
    resolved = dealt(ends).join(dealt(answers).withColumn("dns_success", F.lit(True)), by, "left")
    extra = answers.join(ends.select(*by), by, "left_anti").withColumn("dns_success", F.lit(True))
    names = told.drop("addrs").withColumn("dns_success", F.when(F.col("dns_failure").isNotNull(), False))
    more = names.withColumn("_s", F.lit(0)).unionByName(extra.withColumn("_s", F.lit(2)), allowMissingColumns=True)
    rows = dealt(more).unionByName(resolved.withColumn("_s", F.lit(1)), allowMissingColumns=True)
    if http is not None:
        asked = http.withColumn("http_success", F.col("http_failure").isNull()).withColumn("_s", F.lit(3))
        rows = rows.unionByName(dealt(asked), allowMissingColumns=True)
    one = Window.partitionBy("measurement_uid")
    rows = rows.withColumn("hostname", F.max("hostname").over(one)).filter("_s <> 0 OR dns_failure IS NOT NULL")
    return rows.withColumn("observation_idx", F.row_number().over(one.orderBy("_s", "ip", "port")) - 1).drop("_s")


def control_entries(keys: Column, url: Column) -> Column:
    """Control observations of a measurement with a control, a target host and no control failure: one for a
    DNS failure, one an endpoint with its TCP and TLS results, one a resolved address that no endpoint has
    (in order of the address), one for the control's own request. A result without a failure is a success."""
    c = keys["control"]
    host = F.nullif(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))
    fields = {
        "ip": "string", "port": "int", "dns_failure": "string", "dns_success": "boolean", "tcp_failure": "string", "tcp_success": "boolean",
        "tls_failure": "string", "tls_success": "boolean", "tls_server_name": "string", "http_request_url": "string", "http_failure": "string",
        "http_success": "boolean", "http_response_body_length": "bigint",
    }

    def row(**own: Column) -> Column:
        return F.struct(*[(own[n] if n in own else F.lit(None)).cast(kind).alias(n) for n, kind in fields.items()])

    def endpoint(k: Column, addrs: Column) -> Column:
        ip, port = host_port(scrub_address(k))
        tcp, tls = (F.try_element_at(c[m], k) for m in ("tcp_connect", "tls_handshake"))
        had = lambda m: F.coalesce(F.map_contains_key(c[m], k), F.lit(False))
        return row(
            ip=ip, port=port, tcp_failure=tcp["failure"], tcp_success=F.when(had("tcp_connect"), tcp["failure"].isNull()),
            tls_failure=tls["failure"], tls_success=F.when(had("tls_handshake"), tls["failure"].isNull()), tls_server_name=tls["server_name"],
            dns_success=F.when(F.array_contains(addrs, ip), True),
        )

    none = F.array().cast("array<string>")
    names = F.array_union(*[F.coalesce(F.map_keys(c[m]), none) for m in ("tcp_connect", "tls_handshake")])
    ends = lambda addrs: F.transform(names, lambda k: endpoint(k, addrs))
    rest = lambda addrs, met: F.transform(
        F.array_sort(F.array_except(addrs, F.transform(met, lambda e: e["ip"]))), lambda ip: row(ip=ip, dns_success=F.lit(True))
    )
    empty = F.array().cast(f"array<struct<{','.join(f'{n}:{kind}' for n, kind in fields.items())}>>")
    only = lambda cond, *values: F.when(cond, F.array(row(**dict(values)))).otherwise(empty)
    asked = c["http_request"]
    found = let(F.filter(F.array_distinct(F.coalesce(c["dns"]["addrs"], none)), lambda a: a.isNotNull()), lambda addrs: let(ends(addrs), lambda met: F.concat(
        only(F.nullif(c["dns"]["failure"], F.lit("")).isNotNull(), ("dns_failure", c["dns"]["failure"])), met, rest(addrs, met),
        only(asked.isNotNull(), ("http_request_url", url), ("http_failure", asked["failure"]), ("http_success", asked["failure"].isNull()), ("http_response_body_length", asked["body_length"])),
    )))
    usable = c.isNotNull() & F.nullif(keys["control_failure"], F.lit("")).isNull() & host.isNotNull()
    return F.when(usable, F.transform(found, lambda r, i: F.struct(i.alias("observation_idx"), host.alias("hostname"), *[r[n].alias(n) for n in fields])))


def control_of(msmts: DataFrame) -> DataFrame:
    """Control observations of nested measurements, indexed from 0, beside what is known of the measurement."""
    msmts = complete(msmts)
    rows = msmts.select(*meta_columns(msmts), control_entries(F.col("test_keys"), F.col("input")).alias("_c"))
    out = rows.select(*[c for c in rows.columns if c != "_c"], F.inline_outer("_c"))
    return out.filter("observation_idx IS NOT NULL")


def ech_handshakes(keys: dict[str, Column]) -> Column:
    """Handshakes of an ECH check: the listed ones, else the control and the target, which is a GREASE probe."""
    target = keys["target"].withField("echconfig", F.lit("GREASE"))
    control = F.when(keys["control"].isNotNull(), F.struct(*[keys["control"][n].alias(n) for n in HANDSHAKE]))
    two = F.when(control.isNotNull() & keys["target"].isNotNull(), F.array(control, target))
    return F.when(F.size(keys["tls_handshakes"]) > 0, keys["tls_handshakes"]).otherwise(two)


def header_field_failure(requests: Column) -> Column:
    """First reason why a header-manipulation check failed, NULL if none did. The request's own failure
    counts only where there is no response."""
    r = F.get(requests, F.lit(0))
    return (
        F.when(F.coalesce(F.size(requests), F.lit(0)) <= 0, "missing_requests")
        .when(r["response"].isNull(), F.coalesce(F.nullif(r["failure"], F.lit("")), F.lit("missing_response")))
        .when(r["response"]["body"].isNull(), "missing_response_body")
        .when(r["request"].isNull() | r["request"]["headers_list"].isNull(), "malformed_request")
    )


def header_field_check(msmts: DataFrame) -> DataFrame:
    """:func:`header_field_failure` of each measurement; success without one."""
    reason = header_field_failure(F.col("test_keys.requests"))
    return msmts.select("measurement_uid", reason.alias("hfm_failure"), reason.isNull().alias("hfm_success"))


def request_line_slot(sent: Column) -> Column:
    """Slot 0-4 of an invalid request line by its shape; NULL if it has none of them."""
    p = F.split(sent, " ")
    word = lambda i: F.get(p, F.lit(i))
    return (
        F.when(F.length(word(0)) == 4, 0)
        .when(F.size(p) == 4, 1)
        .when(F.length(word(0)) == 1024, 2)
        .when((word(0) == "GET") & (word(1) == "/") & (F.trim(word(2)) != "HTTP/1.1"), 3)
        .when(F.contains(sent, F.lit("cache_object://localhost/")), 4)
    )


def request_line_columns(sent: Column, received: Column) -> list[Column]:
    """What was sent and received in each slot where they differ, and the failure."""
    n = F.coalesce(F.size(received), F.lit(-1))
    short = F.least(n, F.coalesce(F.size(sent), F.lit(-1)))
    failure = (
        F.when(F.coalesce(F.size(sent), F.lit(0)) <= 0, "missing_sent")
        .when(n <= 0, "missing_received")
        .when(short < 5, F.concat(F.lit("missing_received_"), short.cast("string")))
    )
    pairs = F.slice(F.filter(F.arrays_zip(sent.alias("s"), received.alias("r")), lambda x: x["s"] != x["r"]), 1, 5)
    first = lambda k: F.get(F.filter(pairs, lambda x: request_line_slot(x["s"]) == k), F.lit(0))
    slots = [first(k)[a].alias(f"hirl_{b}_{k}") for k in range(5) for a, b in (("s", "sent"), ("r", "received"))]
    return [failure.alias("hirl_failure"), failure.isNull().alias("hirl_success"), *slots]


def request_line_check(msmts: DataFrame, sent: str = "sent", received: str = "received") -> DataFrame:
    """:func:`request_line_columns` of each measurement."""
    return msmts.select("measurement_uid", *request_line_columns(F.col(sent), F.col(received)))
