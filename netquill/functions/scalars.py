"""Scalar expressions with the semantics that the measurement queries rely on."""

from __future__ import annotations

import ipaddress
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Networks that no public service answers from.
BOGON_V4 = [
    "0.0.0.0/8",
    "10.0.0.0/8",
    "100.64.0.0/10",
    "127.0.0.0/8",
    "169.254.0.0/16",
    "172.16.0.0/12",
    "192.0.0.0/24",
    "192.0.2.0/24",
    "192.168.0.0/16",
    "198.18.0.0/15",
    "198.51.100.0/24",
    "203.0.113.0/24",
    "224.0.0.0/3",
]
# The IPv6 ones that are not derived from the IPv4 ones.
BOGON_V6 = [
    "::/128",
    "::1/128",
    "::ffff:0:0/96",
    "::/96",
    "64:ff9b:1::/48",
    "100::/64",
    "2001:10::/28",
    "2001:db8::/32",
    "fc00::/7",
    "fe80::/10",
    "fec0::/10",
    "ff00::/8",
]
#: IPv4 networks that also count inside 6to4 and Teredo addresses
TUNNELLED = [n for n in BOGON_V4 if n not in ("100.64.0.0/10", "224.0.0.0/3")] + [
    "224.0.0.0/4",
    "240.0.0.0/4",
    "255.255.255.255/32",
]

# Substrings of unclassified failures, in the order they are tried.
UNKNOWN_FAILURES = [
    ("A socket operation was attempted to an unreachable network", "network_unreachable"),
    ("connect: network is unreachable", "network_unreachable"),
    ("No connection could be made because the target machine actively refused it", "connection_refused"),
    ("connect: can't assign requested address", "address_not_available"),
    (": server misbehaving", "dns_server_misbehaving"),
    ("tls: first record does not look like a TLS handshake", "invalid_record"),
    ("remote error: tls: handshake failure", "tls_handshake_failure"),
    ("remote error: tls: illegal parameter", "tls_illegal_parameter"),
    ("certificate has expired or is not yet valid", "ssl_invalid_certificate"),
    ("tls: internal error", "internal_error"),
    ("tls: access denied", "access_denied"),
    (": read: connection refused", "connection_refused"),
    ("connectex: No connection could be made because the target machine actively refused it", "connection_refused"),
    ("read: connection refused", "connection_refused"),
    ("HTTP/1.x transport connection broken: malformed HTTP version", "http_malformed_response"),
    ("net/http: timeout awaiting response headers", "http_timeout"),
    ("read: operation timed out", "timed_out"),
    ("connect: operation timed out", "timed_out"),
    (": No address associated with hostname", "dns_nxdomain_error"),
    (": connect: bad file descriptor", "bad_file_descriptor"),
    ("stream error: stream ID", "http_stream_error"),
    ("readLoopPeekFailLocked: <nil>", "http_golang_bug"),
    ("connect: no route to host", "host_unreachable"),
    ("getaddrinfow: The requested name is valid, but no data of the requested type was found.", "dns_no_answer"),
    ("An existing connection was forcibly closed by the remote host", "connection_reset"),
    ("wsarecv: Se ha forzado la interrupción de una conexión existente por el host remoto.", "connection_reset"),
    ("wsarecv: An existing connection was forcibly closed by the remote host.", "connection_reset"),
    ("wsarecv: Connessione in corso interrotta forzatamente dall'host remoto.", "connection_reset"),
    ("wsarecv: Uma ligação existente foi forçada a fechar pelo anfitrião remoto", "connection_reset"),
    ("This is usually a temporary error during hostname resolution and means that the local server did not receive a response from an authoritative server", "dns_temporary_failure"),
    ("Der angeforderte Name ist gültig, es wurden jedoch keine Daten des angeforderten Typs gefunden", "dns_temporary_failure"),
    ("getaddrinfow: Ceci est habituellement une erreur temporaire qui se produit durant la résolution du nom d’hôte et qui signifie que le serveur local n’a pas reçu de réponse d’un serveur faisant autorité", "dns_temporary_failure"),
    ("getaddrinfow: Dies ist normalerweise ein zeitweiliger Fehler bei der Auflösung von Hostnamen. Grund ist, dass der lokale Server keine Rückmeldung vom autorisierenden Server erhalten hat.", "dns_temporary_failure"),
    ("getaddrinfow: Este é geralmente um erro temporário durante a resolução de nomes de anfitrião e significa que o servidor local não recebeu uma resposta de um servidor autoritário", "dns_temporary_failure"),
    ("getaddrinfow: Éste es normalmente un error temporal durante la resolución de nombres de host y significa que el servidor local no recibió una respuesta de un servidor autoritativo", "dns_temporary_failure"),
    ("address family not supported by protocol", "address_family_not_supported"),
]

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^({_OCTET}\.){{3}}{_OCTET}$"
_GROUP = "[0-9A-Fa-f]{1,4}"
IPV6_FULL = rf"^({_GROUP}:){{7}}{_GROUP}$"


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL for a zero divisor, so that rules fall through."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def map_get0(m: Column, key: Column) -> Column:
    """Value of a key, 0 when missing."""
    return F.coalesce(F.try_element_at(m, key), F.lit(0))


def is_ipv4(ip: Column) -> Column:
    return F.coalesce(ip.rlike(IPV4), F.lit(False))


def is_ipv6(ip: Column) -> Column:
    groups = F.filter(F.split(ip, ":"), lambda x: x != "")
    short = ip.rlike(r"^[0-9A-Fa-f:]*::[0-9A-Fa-f:]*$") & ~ip.rlike(r"::.*::|:::|^:[^:]|[^:]:$|[0-9A-Fa-f]{5}") & (F.size(groups) <= 7)
    return F.coalesce(ip.rlike(IPV6_FULL) | short, F.lit(False))


def is_ip(ip: Column) -> Column:
    return is_ipv4(ip) | is_ipv6(ip)


def scrub_address(address: Column) -> Column:
    """``[scrubbed]:443`` keeps its port beside an address that says so."""
    return F.regexp_replace(address, r"^\[scrubbed\]", "scrubbed")


def host_of(address: Column) -> Column:
    """Host of ``host:port`` or ``[v6]:port``."""
    return F.when(is_ipv6(address), address).otherwise(F.regexp_extract(address, r"^\[?(.*?)\]?(?::(\d+))?$", 1))


def port_of(address: Column) -> Column:
    """Port of ``host:port`` or ``[v6]:port``; NULL without one."""
    port = F.regexp_extract(address, r"^\[?(.*?)\]?:(\d+)$", 2)
    return F.when(~is_ipv6(address) & (port != ""), port.cast("int"))


def host_port(address: Column) -> tuple[Column, Column]:
    """:func:`host_of` and :func:`port_of`."""
    return host_of(address), port_of(address)


def ipv4_number(ip: Column) -> Column:
    """The address as a number, NULL for anything else."""
    p = F.split(ip, r"\.")
    part = lambda i: F.try_element_at(p, F.lit(i)).cast("bigint")
    return F.when(is_ipv4(ip), part(1) * 16777216 + part(2) * 65536 + part(3) * 256 + part(4))


def ipv6_hex(ip: Column) -> Column:
    """The address as 32 hexadecimal digits, NULL for anything else."""
    low = F.lower(ip)
    sides = F.split(low, "::")
    groups = lambda s: F.filter(F.split(s, ":"), lambda x: x != "")
    head, tail = groups(sides[0]), groups(F.coalesce(F.try_element_at(sides, F.lit(2)), F.lit("")))
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(head) - F.size(tail), F.lit(0)))
    full = F.when(F.contains(low, F.lit("::")), F.concat(head, zeros, tail)).otherwise(head)
    return F.when(is_ipv6(ip), F.array_join(F.transform(full, lambda x: F.lpad(x, 4, "0")), ""))


def _hex_range(network: ipaddress.IPv6Network) -> tuple[str, str]:
    return f"{int(network.network_address):032x}", f"{int(network.broadcast_address):032x}"


def v6_bogons() -> list[ipaddress.IPv6Network]:
    """The IPv6 list with the 6to4 (2002::/16) and Teredo (2001::/32) forms of the IPv4 one."""
    out = [ipaddress.ip_network(n) for n in BOGON_V6]
    for base, bits in ((0x2002 << 112, 16), (0x20010000 << 96, 32)):
        for n in map(ipaddress.ip_network, TUNNELLED):
            start = base | int(n.network_address) << (128 - bits - 32)
            out.append(ipaddress.ip_network((start, bits + n.prefixlen)))
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, and stands once in the plan."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_bogon(ip: Column) -> Column:
    """Whether the address lies in a bogon network; what is no address does not."""
    four = [(int(n.network_address), int(n.broadcast_address)) for n in map(ipaddress.ip_network, BOGON_V4)]
    six = [_hex_range(n) for n in v6_bogons()]

    def inside(point: Column, ranges: list[tuple]) -> Column:
        bounds = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ranges])
        return F.coalesce(let(point, lambda x: F.exists(bounds, lambda r: x.between(r["a"], r["b"]))), F.lit(False))

    # only IPv6 has colons, so that one of the two is looked at
    return let(ip, lambda text: F.when(F.contains(text, F.lit(":")), inside(ipv6_hex(text), six)).otherwise(inside(ipv4_number(text), four)))


def normal_failure(failure: Column) -> Column:
    """Empty and false become NULL; unclassified failures take the class of the first known substring. Those are told
    apart inside a ``let``, as one function a row of theirs: spelled out in every column that has failures, the chain
    makes methods too large for the JVM to compile."""

    def known(text: Column) -> Column:
        chain = F
        for part, name in UNKNOWN_FAILURES:
            chain = chain.when(F.contains(text, F.lit(part)), name)
        return F.coalesce(chain, text)

    return F.when(failure.isNull() | failure.isin("", "false"), F.lit(None).cast("string")).when(
        failure.startswith("unknown_failure"), let(failure, known)
    ).otherwise(failure)


def url_domain(url: Column) -> Column:
    """Host of a URL with or without scheme, '' on failure."""
    return F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?(?:[^/?#@]*@)?([^/?#:@]+)", 1), F.lit(""))


def time_grain(ts: Column, grain: str) -> Column:
    """Start of the hour, day, week (Sunday) or month; ``year`` and ``auto`` count as day."""
    if grain in ("hour", "month"):
        return F.date_trunc(grain, ts)
    if grain == "week":
        return F.date_trunc("week", ts + F.expr("INTERVAL 1 DAY")) - F.expr("INTERVAL 1 DAY")
    return F.date_trunc("day", ts)


def test_group(test_name: Column) -> Column:
    return F.when(test_name.isin("web_connectivity", "http_requests"), "websites").otherwise("")


def as_number(text: str | int) -> int:
    """``AS123`` or ``123`` as a number."""
    text = str(text)
    return int(text[2:] if text.upper().startswith("AS") else text)


def time_window(since: datetime | None = None, until: datetime | None = None, now: datetime | None = None) -> tuple[datetime, datetime]:
    """A window's bounds; without them it ends at today's midnight and starts at the midnight thirty days before."""
    now = datetime.now(timezone.utc).replace(tzinfo=None) if now is None else now
    midnight = datetime.combine(now, datetime.min.time())
    return since or midnight - timedelta(days=30), until or midnight


def decoded(data: Column) -> Column:
    """Bytes as UTF-8 text, as Latin-1 where they are not UTF-8."""
    return F.coalesce(F.try_validate_utf8(data.cast("string")), F.decode(data, "ISO-8859-1"))


def html_title(html: Column) -> Column:
    """Text of the first title element, '' without one."""
    return F.coalesce(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def html_meta_title(html: Column) -> Column:
    """Content of the ``og:title`` meta element, '' without one."""
    return F.coalesce(F.regexp_extract(html, r"(?is)<meta[^>]*property=[\"']og:title[\"'][^>]*content=[\"'](.*?)[\"']", 1), F.lit(""))
