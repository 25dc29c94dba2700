"""Enrichment joins: dated address ranges and network metadata, fingerprints, targets."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from functools import reduce
from hashlib import sha256

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netquill.functions.scalars import html_title, ipv4_number, ipv6_hex, is_bogon, is_ip, url_domain

# The network that stands for bogons, the private-use range and its name.
BOGON_ASN, PRIVATE_ASNS, PRIVATE_NAME = 64666, (64512, 65535), "Private use (RFC1930)"


def asof_snapshot(rows: DataFrame, snapshots: DataFrame, day: str, snapshot: str = "snapshot", of: str | None = None) -> DataFrame:
    """The newest snapshot not after each row's day, else the oldest; among those of the row's ``of``, if it is given.
    Days are looked up, not rows, in one order of days and snapshot dates cut into months, whatever the number
    of either."""
    key = F.col(of) if of else F.lit(0)
    dates = snapshots.select(key.alias("_k"), snapshot).filter(F.col(snapshot).isNotNull()).distinct()
    dated = rows.withColumns({"_k": key, "_day": F.date_trunc("day", day)})
    return asof_join(dated, dates.withColumn("_date", F.date_trunc("day", snapshot)), "_k", "_day", "_date", [snapshot]).drop("_k", "_day")


def elementary(ranges: DataFrame, names: list[str], keys: list[str], region: int) -> DataFrame:
    """Disjoint stretches of the points that ranges (first, last as hexadecimal text of equal length, prefix_len,
    ``names``, ``keys``) cover: (keys, _at, _v), where from point _at up to the next stretch the longest range is
    the one with values _v; a stretch that no range covers has NULL values.

    Ranges are cut where their first ``region`` digits change, and one sweep runs over the ranges of a
    region: nested, crossing and repeated ones may stand in any order."""
    start = lambda c: F.conv(F.substring(c, 1, region), 16, 10).cast("long")
    size = F.length("first")
    head = F.lower(F.lpad(F.hex("_g"), region, "0"))
    cut = ranges.withColumn("_g", F.explode(F.sequence(start("first"), start("last")))).select(
        *keys, "_g", F.greatest("first", F.rpad(head, size, "0")).alias("low"), F.least("last", F.rpad(head, size, "f")).alias("high"),
        "prefix_len", "first", F.struct(*names).alias("_v"),
    )
    kinds = cut.select(*keys, F.col("low").alias("_at"), "_v")

    def sweep(part: pa.Table) -> pa.Table:
        low, high, width, first, values = (part[c].to_pylist() for c in ("low", "high", "prefix_len", "first", "_v"))
        # the longest range first, of equals the one that starts and reads first
        rank = sorted(range(len(low)), key=lambda i: (-width[i], first[i], str(values[i])))
        place = {i: r for r, i in enumerate(rank)}
        digits = len(low[0])
        after = lambda text: f"{int(text, 16) + 1:0{digits}x}"
        begins = sorted(range(len(low)), key=lambda i: low[i])
        points = sorted({*low, *(after(h) for h in high if h.strip("f"))})
        at, best, active, k, last = [], [], [], 0, -1
        for point in points:
            while k < len(begins) and low[begins[k]] <= point:
                heapq.heappush(active, (place[begins[k]], begins[k]))
                k += 1
            while active and high[active[0][1]] < point:
                heapq.heappop(active)
            now = active[0][1] if active else None
            # where the next region starts with a range, that one comes after this end
            if now != last:
                at.append(point)
                best.append(now)
                last = now
        none = dict.fromkeys(names)
        own = {c: pa.array([part[c][0].as_py()] * len(at), part.schema.field(c).type) for c in keys}
        found = pa.array([none if i is None else values[i] for i in best], part.schema.field("_v").type)
        return pa.table({**own, "_at": pa.array(at, pa.string()), "_v": found})

    return cut.groupBy(*keys, "_g").applyInArrow(sweep, kinds.schema)


def lookup_ranges(rows: DataFrame, ranges: DataFrame, point: str, bucket: Column, region: int, snapshot: str | None = None) -> DataFrame:
    """The values of the longest range that holds each row's point. Points, first and last are hexadecimal text,
    of equal length among those that share their first digits; ``bucket`` is how many digits of ``_at`` name a bucket of
    points. See :func:`elementary` for ``region``."""
    keys = [snapshot] if snapshot else []
    names = [c for c in ranges.columns if c not in ("first", "last", "prefix_len", *keys)]
    stretches = elementary(ranges, names, keys, region)
    spots = rows.select(*keys, F.col(point).alias("_at")).filter("_at IS NOT NULL").distinct()
    one = lambda df: df.withColumn("_one", F.lit(0))  # noqa: E731  windows need a key
    found = _last_before(one(stretches), one(spots), [*keys, "_one"], F.substring("_at", F.lit(1), bucket))
    best = found.select(*keys, F.col("_at").alias(point), F.coalesce("_own", "_before").alias("_r"))
    return rows.join(best, [point, *keys], "left").select("*", *[F.col(f"_r.{n}").alias(n) for n in names]).drop("_r")


def range_join(rows: DataFrame, ranges: DataFrame, point: str, bucket: int, snapshot: str | None = None) -> DataFrame:
    """The values of the longest range (first, last, prefix_len, …: numbers from 0) that holds each row's point.
    ``bucket``: points that a window takes, about."""
    text = lambda c: F.lower(F.lpad(F.hex(F.col(c).cast("long")), 16, "0"))
    digits = 16 - max(1, (bucket - 1).bit_length() // 4)
    spots = rows.withColumn("_point", text(point))
    hexed = ranges.withColumns({"first": text("first"), "last": text("last")})
    return lookup_ranges(spots, hexed, "_point", F.lit(digits), max(1, digits - 2), snapshot).drop("_point")


def enrich_ip(df: DataFrame, ranges: DataFrame, number: str, bogon: Column, day: str = "measurement_start_time", bucket: int = 1 << 16) -> DataFrame:
    """Network and country of an address (as a number) on the row's day: ranges have (snapshot, first,
    last, prefix_len, asn, org, as_cc, cc). Bogons are network 64666 of country ZZ; misses are network 0 without a name or
    country, in country ZZ."""
    rows = asof_snapshot(df, ranges, day)
    return _known(range_join(rows, ranges, number, bucket, "snapshot").drop("snapshot"), bogon)


def _known(rows: DataFrame, bogon: Column) -> DataFrame:
    """Looked-up networks with the values of bogons and misses."""
    out = rows.withColumn("_bogon", bogon)
    bogon = F.col("_bogon")
    return out.withColumns({
        "asn": F.when(bogon, BOGON_ASN).otherwise(F.coalesce("asn", F.lit(0))),
        "org": F.when(bogon, "Bogon").otherwise(F.coalesce("org", F.lit(""))),
        "as_cc": F.when(bogon, "ZZ").otherwise(F.coalesce("as_cc", F.lit(""))),
        "cc": F.when(bogon, "ZZ").otherwise(F.coalesce("cc", F.lit("ZZ"))),
    }).drop("_bogon")


def _last_before(changes: DataFrame, spots: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    """For each of ``spots`` (keys, _at) the last of ``changes`` (keys, _at, _v) at or before it: (keys, _at, _own,
    _before, _p), one of its own bucket or the last of an earlier bucket. Both stand in one order, cut into buckets: the
    last value runs inside a bucket, and from bucket to bucket over one row each, so no task takes a key whole."""
    at, value = F.col("_at"), F.col("_v")
    both = changes.select(*keys, "_at", "_v").unionByName(spots.select(*keys, "_at"), allowMissingColumns=True).withColumn("_p", bucket)
    inside = Window.partitionBy(*keys, "_p").orderBy("_at", value.isNull(), "_v")
    parts = both.groupBy(*keys, "_p").agg(F.max(F.when(value.isNotNull(), F.struct("_at", "_v"))).alias("_m"))
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*keys, "_p", F.last("_m._v", True).over(before).alias("_before"))
    run = both.withColumn("_own", F.last("_v", True).over(inside)).filter(value.isNull() & at.isNotNull())
    return run.join(carried, [*keys, "_p"]).select(*keys, "_at", "_own", "_before")


def asof_join(rows: DataFrame, history: DataFrame, key: str, day: str, changed: str, values: list[str]) -> DataFrame:
    """Values of the last change of a key not after the row's day, else of the first one; one lookup for
    each distinct key and day, cut into months."""
    changes = history.select(key, F.col(changed).cast("timestamp").alias("_at"), F.struct(*values).alias("_v"))
    spots = rows.select(key, F.col(day).cast("timestamp").alias("_at")).distinct()
    firsts = changes.filter("_at IS NOT NULL").groupBy(key).agg(F.min(F.struct("_at", "_v")).alias("_f"))
    found = _last_before(changes, spots, [key], F.date_trunc("month", "_at")).join(firsts, key, "left")
    found = found.select(key, "_at", F.coalesce("_own", "_before", "_f._v").alias("_v"))
    out = rows.withColumn("_at", F.col(day).cast("timestamp")).join(found, [key, "_at"], "left")
    return out.select(*rows.columns, *[F.col(f"_v.{x}").alias(x) for x in values])


def ipv6_bits(ip: Column) -> Column:
    """The 128 binary digits of an IPv6 address, NULL for anything else."""
    digits = ipv6_hex(ip)
    part = lambda k: F.lpad(F.conv(F.substring(digits, 8 * k + 1, 8), 16, 2), 32, "0")
    return F.concat(*[part(k) for k in range(4)])


def address_text(ip: Column) -> Column:
    """An address as text that sorts like its number: ``4`` and 8 digits, or ``6`` and 32; NULL for anything else."""
    return F.coalesce(F.concat(F.lit("4"), F.lower(F.lpad(F.hex(ipv4_number(ip)), 8, "0"))), F.concat(F.lit("6"), ipv6_hex(ip)))


def address_ranges(ranges: DataFrame, prefixes: DataFrame) -> DataFrame:
    """IPv4 ranges (first, last: numbers) and IPv6 prefixes (prefix: binary digits) as one table of ranges of
    :func:`address_text`."""
    four = lambda c: F.concat(F.lit("4"), F.lower(F.lpad(F.hex(c), 8, "0")))
    bits = lambda fill: F.rpad("prefix", 128, fill)
    digits = lambda b: F.concat(F.lit("6"), *[F.lower(F.lpad(F.conv(F.substring(b, 32 * k + 1, 32), 2, 16), 8, "0")) for k in range(4)])
    six = prefixes.withColumns({"first": digits(bits("0")), "last": digits(bits("1")), "prefix_len": F.length("prefix")}).drop("prefix")
    return ranges.withColumns({"first": four("first"), "last": four("last")}).unionByName(six)


def _family(text: str | Column) -> Column:
    """The first digit of :func:`address_text`: 4 or 6."""
    return F.substring(text, 1, 1)


def address_networks(spots: DataFrame, ranges: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Network and country (asn, org, as_cc, cc) of each IPv4 or IPv6 address on a day: ``spots`` (ip, day), both
    families in one lookup. ``ranges`` as in :func:`enrich_ip`; ``prefixes``: (snapshot, prefix, asn, org, as_cc, cc). What is
    no address is a miss."""
    both = address_ranges(ranges, prefixes)
    placed = spots.withColumn("_f", _family(address_text(F.col("ip"))))
    dated = asof_snapshot(placed, both.withColumn("_f", _family("first")), "day", of="_f")
    return snapshot_networks(dated, both).select("ip", "day", "asn", "org", "as_cc", "cc")


def snapshot_networks(spots: DataFrame, both: DataFrame) -> DataFrame:
    """Network and country of each address in a snapshot: ``spots`` (ip, snapshot, …), ``both`` of
    :func:`address_ranges`."""
    placed = spots.withColumn("_a", address_text(F.col("ip")))
    # points stand in buckets of 16 bits of IPv4 or 32 of IPv6, ranges are swept by 12 bits of either
    bucket = F.when(F.col("_at").startswith("6"), 9).otherwise(5)
    return _known(lookup_ranges(placed, both, "_a", bucket, 4, "snapshot"), is_bogon(F.col("ip"))).drop("_a")


def snapshot_dates(days: DataFrame, both: DataFrame) -> DataFrame:
    """(day, four, six): the snapshots of IPv4 ranges and of IPv6 prefixes that hold on each of the distinct days (day),
    as :func:`asof_snapshot` finds them; a day of the past for a family without snapshots."""
    asked = days.filter("day IS NOT NULL").select("day", F.explode(F.array(F.lit("4"), F.lit("6"))).alias("_f"))
    found = asof_snapshot(asked, both.withColumn("_f", _family("first")), "day", of="_f")
    of = lambda f: F.coalesce(F.max(F.when(F.col("_f") == f, F.col("snapshot"))), F.lit("0001-01-01").cast("timestamp"))
    return found.groupBy("day").agg(of("4").alias("four"), of("6").alias("six"))


def snapshot_at(ip: str) -> Column:
    """Which of the columns of :func:`snapshot_dates` holds for an address."""
    return F.when(F.contains(F.col(ip), F.lit(":")), F.col("six")).otherwise(F.col("four"))


def snapshot_spots(dated: DataFrame, ip: str = "ip") -> DataFrame:
    """The distinct (ip, snapshot) of rows with an address, which have the columns of :func:`snapshot_dates`."""
    return dated.select(F.col(ip).alias("ip"), snapshot_at(ip).alias("snapshot")).filter("ip <> '' AND snapshot IS NOT NULL").distinct()


def join_snapshots(dated: DataFrame, found: DataFrame, ip: str = "ip") -> DataFrame:
    """Rows beside what :func:`snapshot_networks` found, NULL where they have no address or no day."""
    known = found.select(F.col("ip").alias("_ip"), F.col("snapshot").alias("_snapshot"), "asn", "org", "as_cc", "cc")
    return dated.join(known, (F.col(ip) == F.col("_ip")) & (snapshot_at(ip) == F.col("_snapshot")), "left").drop("_ip", "_snapshot")


def address_spots(rows: DataFrame, ip: str = "ip", day: str = "measurement_start_time") -> DataFrame:
    """The distinct (ip, day) of rows with an address."""
    return rows.select(F.col(ip).alias("ip"), F.date_trunc("day", day).alias("day")).filter("ip IS NOT NULL AND ip <> ''").distinct()


def join_networks(rows: DataFrame, found: DataFrame, ip: str = "ip", day: str = "measurement_start_time") -> DataFrame:
    """Rows beside what :func:`address_networks` found, NULL where they have no address."""
    known = found.select(F.col("ip").alias("_ip"), F.col("day").alias("_day"), "asn", "org", "as_cc", "cc")
    return rows.join(known, (F.col(ip) == F.col("_ip")) & (F.date_trunc("day", day) == F.col("_day")), "left").drop("_ip", "_day")


def enrich_address(df: DataFrame, ranges: DataFrame, prefixes: DataFrame, ip: str = "ip", day: str = "measurement_start_time") -> DataFrame:
    """Network and country of an address on the row's day; what is no address is a miss."""
    out = join_networks(df, address_networks(address_spots(df, ip, day), ranges, prefixes), ip, day)
    return _known(out, F.lit(False))


# Named targets of the messaging tests by platform, host names first, then patterns in order.
PLATFORM_HOSTS = {
    "telegram": {"web.telegram.org": "telegram/web"},
    "whatsapp": {"v.whatsapp.net": "whatsapp/registration", "web.whatsapp.com": "whatsapp/web"},
    "signal": {
        "chat.signal.org": "signal/chat", "textsecure-service.whispersystems.org": "signal/chat", "cdsi.signal.org": "signal/directory",
        "api.directory.signal.org": "signal/directory", "sfu.voip.signal.org": "signal/sfu", "storage.signal.org": "signal/storage",
        "uptime.signal.org": "signal/uptime",
    },
    "facebook_messenger": {
        "star.c10r.facebook.com": "facebook_messenger/star", "b-api.facebook.com": "facebook_messenger/b_api",
        "b-graph.facebook.com": "facebook_messenger/b_graph", "edge-mqtt.facebook.com": "facebook_messenger/edge",
        "external.xx.fbcdn.net": "facebook_messenger/external_cdn", "scontent.xx.fbcdn.net": "facebook_messenger/scontent_cdn",
        "stun.fbsbx.com": "facebook_messenger/stun",
    },
}
PLATFORM_PATTERNS = {
    "whatsapp": [(r"^e\d+\.whatsapp\.net$", "whatsapp/endpoints")],
    "signal": [(r"^cdn\d*\.signal\.org$", "signal/cdn")],
}


def platform_target(platform: Column, hostname: Column, ip: Column) -> Column:
    """Named target of a messaging test's observation, NULL without one: by host name, else by address, as
    Telegram's data centres are asked by address and any of theirs counts to their pool."""
    name = F.coalesce(F.nullif(hostname, F.lit("")), F.nullif(ip, F.lit("")))
    exact = {f"{p} {h}": t for p, hosts in PLATFORM_HOSTS.items() for h, t in hosts.items()}
    known = F.create_map(*[F.lit(x) for pair in exact.items() for x in pair])
    target = F.try_element_at(known, F.concat(platform, F.lit(" "), name))
    for p, patterns in PLATFORM_PATTERNS.items():
        for pattern, t in patterns:
            target = F.coalesce(target, F.when((platform == p) & F.regexp_like(name, F.lit(pattern)), t))
    return F.coalesce(target, F.when((platform == "telegram") & is_ip(name), "telegram/dc_pool"))


def enrich_asn(df: DataFrame, asnmeta: DataFrame, asn: str = "probe_asn", day: str = "measurement_start_time") -> DataFrame:
    """Organisation, country and name of a network as of the row's day; 0 is unknown, private-use numbers
    say so. asnmeta: (asn, org_name, cc, changed, aut_name)."""
    history = asnmeta.withColumnRenamed("asn", asn)
    out = asof_join(df, history, asn, day, "changed", ["org_name", "cc", "aut_name"])
    private, unknown = F.col(asn).between(*PRIVATE_ASNS), F.col(asn) == 0
    fix = lambda c, p, u: F.when(unknown, u).when(private, p).otherwise(F.coalesce(c, F.lit("")))
    return out.withColumns({
        "org_name": fix("org_name", PRIVATE_NAME, "Unknown"),
        "cc": F.when(unknown | private, "ZZ").otherwise(F.coalesce("cc", F.lit(""))),
        "aut_name": fix("aut_name", PRIVATE_NAME, "Unknown"),
    })


def asn_flatten(text: DataFrame, column: str = "value") -> DataFrame:
    """{asn: [[org, cc, changed, name, source], …]} → one row a change."""
    parsed = text.select(F.explode(F.from_json(column, "map<string,array<array<string>>>")).alias("asn", "entries"))
    e = parsed.select(F.col("asn").cast("bigint").alias("asn"), F.explode("entries").alias("e"))
    part = lambda i: F.get("e", F.lit(i))
    return e.select(
        "asn", part(0).alias("org_name"), part(1).alias("cc"), F.to_date(part(2), "yyyyMMdd").alias("changed"),
        part(3).alias("aut_name"), part(4).alias("source"),
    )


def match_condition(text: Column, pattern: Column, kind: Column) -> Column:
    return (
        F.when(kind == "full", text == pattern)
        .when(kind == "prefix", F.startswith(text, pattern))
        .when(kind == "contains", F.contains(text, pattern))
        .when(kind == "regexp", F.regexp_like(text, F.concat(F.lit("(?s)"), pattern)))
    )


def in_blocks(patterns: DataFrame, most: int) -> list[DataFrame]:
    """Patterns that meet every text, as broadcasts of about ``most`` rows: they are counted, and more of
    them are cut into blocks by a hash, each met by its own scan of the texts."""
    blocks = -(-patterns.count() // most)
    if blocks <= 1:
        return [F.broadcast(patterns)]
    part = F.pmod(F.xxhash64(*patterns.columns), F.lit(blocks))
    return [F.broadcast(patterns.filter(part == k)) for k in range(blocks)]


#: the shortest literal that is worth an entry in the index
LITERAL = 3


def required_literal(kind: str, pattern: str) -> str | None:
    """Text that every match of a pattern holds: the pattern itself, or the longest run of plain characters of a
    regular expression outside its groups and classes, less a character that a quantifier may take away. None for
    an expression with alternatives or flags, or without a run of LITERAL characters."""
    if kind != "regexp":
        return pattern if len(pattern) >= LITERAL else None
    if "|" in pattern or "(?" in pattern:
        return None
    best, run, depth, i = "", "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        plain = None
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            # classes and edges break a run; other letters may stand for characters spelled out after them
            if pattern[i].isalnum() and pattern[i] not in "bBdDsSwWnrtfAzZ":
                return None
            plain = "" if pattern[i].isalnum() else pattern[i]
        elif c == "[":
            close = pattern.find("]", i + 2)
            inside = pattern[i + 1 : close]
            if close < 0 or inside[0] in "]^" and "]" in pattern[i + 1 : i + 3] or "[" in inside or "\\" in inside:
                return None
            i = close
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c in "*?{":
            run = run[:-1]
            if c == "{":
                close = pattern.find("}", i)
                i = close if close > 0 else len(pattern)
        elif c not in ".^$+":
            plain = c
        if plain and depth == 0:
            run += plain
        else:
            best, run = max(best, run, key=len), ""
        i += 1
    best = max(best, run, key=len)
    return best if len(best) >= LITERAL else None


_indexes: dict[str, ahocorasick.Automaton] = {}


def held_literals(literals: list[str]) -> Callable:
    """An Arrow function from texts to those of the literals that each holds, found in one scan of the text."""
    name = sha256("\x00".join(literals).encode()).hexdigest()

    def find(texts: pa.Array) -> pa.Array:
        index = _indexes.get(name)
        if index is None:
            _indexes.clear()
            index = ahocorasick.Automaton()
            for x in literals:
                index.add_word(x, x)
            index.make_automaton()
            _indexes[name] = index
        found = [None if t is None else list({x for _, x in index.iter(t)}) for t in texts.to_pylist()]
        return pa.array(found, pa.list_(pa.string()))

    return F.arrow_udf(find, "array<string>")


def _matches(texts: DataFrame, patterns: DataFrame, text: str, keep: list[str], most: int) -> DataFrame | None:
    """(keep, name, scope) of texts and patterns (name, scope, pattern_type, pattern) that match. Patterns are taken
    ``most`` at a time. Those with a literal are candidates for the texts that hold it, by equality, and are
    confirmed; only those without one meet every text."""
    blocks = max(1, -(-patterns.count() // most))
    out = None
    for k in range(blocks):
        own = patterns if blocks == 1 else patterns.filter(F.pmod(F.xxhash64("name", "scope", "pattern_type", "pattern"), F.lit(blocks)) == k)
        rows = [(r["name"], r["scope"], r["pattern_type"], r["pattern"], required_literal(r["pattern_type"], r["pattern"])) for r in own.collect() if r["pattern"] is not None]
        known = patterns.sparkSession.createDataFrame(rows, "name string, scope string, _kind string, _p string, _lit string")
        literals = sorted({r[4] for r in rows if r[4]})
        met = []
        if literals:
            cand = texts.select(*keep, text, F.explode(held_literals(literals)(F.col(text))).alias("_lit"))
            met.append(cand.join(F.broadcast(known), "_lit"))
        if any(not r[4] for r in rows):
            met.append(texts.select(*keep, text).join(F.broadcast(known.filter("_lit IS NULL")), F.col("_lit").isNull()))
        for df in met:
            hit = df.filter(match_condition(F.col(text), F.col("_p"), F.col("_kind"))).select(*keep, "name", "scope")
            out = hit if out is None else out.unionByName(hit)
    return out


def match_fingerprints(df: DataFrame, patterns: DataFrame, text_col: str, key: str, header_cols: dict | None = None, max_patterns: int = 10_000) -> DataFrame:
    """(key, name, scope) of every pattern that a text matches. Patterns have (name, scope, location_found,
    pattern_type, pattern); those on a header match only as regexp. Whole-text patterns are an
    equi-join; of the others, those with a literal meet the texts that hold it (see :func:`required_literal`)."""
    body = patterns.filter(~F.coalesce(F.col("location_found").startswith("header."), F.lit(False)))
    full = body.filter("pattern_type = 'full'").select("name", "scope", F.col("pattern").alias("_p"))
    out = df.join(full, df[text_col] == full._p).select(key, "name", "scope")
    fields = ("name", "scope", "pattern_type", "pattern")
    parts = [_matches(df, body.filter("pattern_type IN ('prefix', 'contains', 'regexp')").select(*fields), text_col, [key], max_patterns)]
    for name, column in (header_cols or {}).items():
        own = patterns.filter((F.col("location_found") == f"header.{name}") & (F.col("pattern_type") == "regexp"))
        parts.append(_matches(df, own.select(*fields), column, [key], max_patterns))
    for p in parts:
        out = out if p is None else out.unionByName(p)
    return out


def first_by_address(rows: DataFrame, fingerprints: DataFrame, address: str = "dns_answer") -> DataFrame:
    """Name of the first DNS fingerprint (in ``position``) of each address."""
    one = fingerprints.filter("pattern_type = 'full'").groupBy(F.col("pattern").alias("_p")).agg(F.min_by("name", "position").alias("fingerprint"))
    return rows.join(one, rows[address] == one._p, "left").drop("_p")


def by_name(names: DataFrame, dns: DataFrame, http: DataFrame) -> DataFrame:
    """Fingerprints looked up by name, DNS before HTTP."""
    both = dns.withColumn("_o", F.lit(0)).unionByName(http.withColumn("_o", F.lit(1)))
    cols = [c for c in both.columns if c not in ("name", "_o")]
    one = both.groupBy("name").agg(F.min_by(F.struct(*cols), "_o").alias("_v")).select("name", "_v.*")
    return names.join(one, "name", "left")


def body_scan(pages: DataFrame, patterns: DataFrame, text_col: str = "html") -> DataFrame:
    """Each distinct body once: digest, matched names, and whether any is a known false positive."""
    bodies = pages.filter(F.col(text_col).isNotNull()).select(F.sha1(text_col).alias("digest"), text_col).dropDuplicates(["digest"])
    hits = match_fingerprints(bodies, patterns, text_col, "digest")
    return hits.groupBy("digest").agg(F.array_sort(F.collect_set("name")).alias("names"), F.max((F.col("scope") == "fp").cast("int")).alias("false_positive"))


def suffixes(host: Column) -> Column:
    """All dotted suffixes of a host, the longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def registrable_domain(rows: DataFrame, host: str, rules: DataFrame) -> DataFrame:
    """Registrable domain of each host by public-suffix rules (rule, kind: exact, wildcard, exception).
    A wildcard covers one label before its rule, an exception names a registrable domain itself; without a
    rule the public suffix is the last label. NULL for a public suffix."""
    hosts = rows.select(F.col(host).alias("_h")).filter("_h <> ''").distinct().withColumn("_l", F.split("_h", r"\."))
    cand = hosts.select("_h", "_l", F.posexplode(suffixes(F.col("_h"))).alias("_i", "_s"))
    met = cand.join(rules, cand._s == rules.rule, "left")
    n = F.size("_l") - F.col("_i")  # labels of the suffix
    size = F.when(F.col("kind") == "exact", n).when(F.col("kind") == "wildcard", n + 1)
    exception = F.when(F.col("kind") == "exception", n - 1)
    best = met.groupBy("_h", "_l").agg(F.coalesce(F.max(exception), F.greatest(F.max(size), F.lit(1))).alias("_n"))
    take = F.col("_n") + 1
    domain = F.when(F.size("_l") >= take, F.array_join(F.expr("slice(_l, size(_l) - _n, _n + 1)"), "."))
    return rows.join(best.select("_h", domain.alias("registrable")), rows[host] == F.col("_h"), "left").drop("_h")


def resolve_targets(df: DataFrame, hosts: DataFrame, rules: DataFrame, host: str = "hostname", ip: str | None = None, max_patterns: int = 10_000) -> DataFrame:
    """Target of each row, NULL without one. hosts: (kind, value, target) with kinds exact, pattern, ip,
    suffix, domain; they are tried in that order, patterns by the smallest target, suffixes by the
    longest. Patterns meet every distinct host, ``max_patterns`` at a time."""
    keys = [host] + ([ip] if ip else [])
    spots = df.select(*keys).distinct()
    of = lambda kind: hosts.filter(F.col("kind") == kind).groupBy("value").agg(F.min("target").alias("target"))
    look = lambda rows, kind, on, name: rows.join(of(kind).select(F.col("value").alias(f"_{name}v"), F.col("target").alias(name)), F.col(on) == F.col(f"_{name}v"), "left").drop(f"_{name}v")
    out = look(spots, "exact", host, "t_exact")
    patterns = in_blocks(of("pattern").select(F.col("value").alias("_p"), F.col("target").alias("_t")), max_patterns)
    names = spots.select(host).distinct()
    met = [names.join(p, F.regexp_like(F.col(host), F.col("_p"))).select(host, "_t") for p in patterns]
    hit = reduce(DataFrame.unionByName, met).groupBy(host).agg(F.min("_t").alias("t_pattern"))
    out = out.join(hit, host, "left")
    out = look(out, "ip", ip, "t_ip") if ip else out.withColumn("t_ip", F.lit(None).cast("string"))
    cand = spots.select(host).distinct().select(host, F.explode(suffixes(F.col(host))).alias("_s"))
    met = cand.join(of("suffix"), F.col("_s") == F.col("value")).groupBy(host).agg(F.max_by("target", F.length("_s")).alias("t_suffix"))
    out = out.join(met, host, "left")
    out = look(registrable_domain(out, host, rules), "domain", "registrable", "t_domain")
    chosen = F.coalesce("t_exact", "t_pattern", "t_ip", "t_suffix", "t_domain")
    out = out.select(*[F.col(k).alias(f"_{k}") for k in keys], chosen.alias("target"))
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(out[f"_{k}"])
        cond = c if cond is None else cond & c
    return df.join(out, cond, "left").drop(*[f"_{k}" for k in keys])


def target_rollup(mapped: DataFrame, categories: DataFrame) -> DataFrame:
    """Per target its dominant category and host count. mapped: (hostname, target); categories: (hostname,
    category, cc), where the global list (ZZ) weighs double."""
    weight = F.when(F.col("cc") == "ZZ", 2).otherwise(1)
    known = mapped.filter("target IS NOT NULL")
    w = known.join(categories, "hostname").groupBy("target", "category").agg(F.sum(weight).alias("w"))
    best = w.groupBy("target").agg(F.max_by("category", F.struct("w", "category")).alias("category"), F.max("w").alias("weight"))
    return known.groupBy("target").agg(F.count_distinct("hostname").alias("n_hosts")).join(best, "target", "left")


def unmapped(mapped: DataFrame) -> DataFrame:
    return mapped.filter("target IS NULL").groupBy("hostname").agg(F.count("*").alias("n"))


def page_hosts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", url_domain(F.col("url")).alias("hostname"), html_title(F.col("html")).alias("title"))


def running_index(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("idx", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
