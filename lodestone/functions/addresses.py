"""Addresses in host names as 128-bit values, and what ranges they lie in.

A value is 32 hexadecimal digits, so order and ranges are those of strings.
IPv4 addresses are their mapped IPv6 form (::ffff:0:0/96): a way of writing an
address cannot get it past a range.  Names are not resolved.
"""

from __future__ import annotations

import ipaddress
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# fixed values: special ranges, and the addresses in them that are not special
LOOPBACK = ["127.0.0.0/8", "::1/128"]
PRIVATE = [
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24",
    "240.0.0.0/4", "::1/128", "::/128", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32", "2002::/16", "3fff::/20", "fc00::/7", "fe80::/10",
]
NOT_PRIVATE = ["192.0.0.9/32", "192.0.0.10/32", "2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48", "2001:20::/28", "2001:30::/28"]
LINK_LOCAL = ["169.254.0.0/16", "fe80::/10"]
MULTICAST = ["224.0.0.0/4", "ff00::/8"]
UNSPECIFIED = ["0.0.0.0/32", "::/128"]
METADATA = ["169.254.169.254/32", "100.100.100.200/32", "192.0.0.192/32"]

_V4 = "0" * 20 + "ffff"
_PART = r"(?:0x[0-9a-f]{1,8}|[0-9]{1,12})"


def _bounds(network: str) -> tuple[str, str]:
    n = ipaddress.ip_network(network)
    low, high = int(n.network_address), int(n.broadcast_address)
    return (f"{_V4}{low:08x}", f"{_V4}{high:08x}") if n.version == 4 else (f"{low:032x}", f"{high:032x}")


def within(value: Column, networks: list[str]) -> Column:
    """Whether a value lies in one of the ranges; adjoining ranges are one."""
    spans: list[tuple[str, str]] = []
    for low, high in sorted(map(_bounds, networks)):
        if spans and int(low, 16) <= int(spans[-1][1], 16) + 1:
            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
        else:
            spans.append((low, high))
    return reduce(lambda a, b: a | b, [value.between(*s) for s in spans])


def _v4(host: Column) -> Column:
    """A number from 1 to 4 decimal, octal or hexadecimal parts, the last of
    which fills the bytes that are left; null if it is none."""

    def number(p: Column) -> Column:
        digits = F.when(p.startswith("0x"), F.conv(F.substring(p, 3, 8), 16, 10)).when(p.rlike("^0[0-7]+$"), F.conv(p, 8, 10))
        return digits.when(p.rlike("^(0|[1-9][0-9]*)$"), p).cast("bigint")

    def whole(values: Column) -> Column:
        n, last = F.size(values), F.element_at(values, -1)
        room = F.element_at(F.array(*[F.lit(256**k).cast("bigint") for k in (4, 3, 2, 1)]), n)
        zero = F.struct(F.lit(0).cast("bigint").alias("v"), F.lit(1 << 24).cast("bigint").alias("m"))
        step = lambda a, x: F.struct((a["v"] + F.when(x < 256, x) * a["m"]).alias("v"), F.floor(a["m"] / 256).alias("m"))
        return F.when(last < room, F.aggregate(F.slice(values, F.lit(1), n - 1), zero, step)["v"] + last)

    return F.when(host.rlike(rf"^{_PART}(\.{_PART}){{0,3}}$"), let(F.transform(F.split(host, r"\."), number), whole))


_DOTTED = r":((?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?!$)|$)){4})$"


def _v6(host: Column) -> Column:
    def spread(halves: Column) -> Column:
        of = lambda k: F.when(F.coalesce(F.get(halves, F.lit(k)), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(F.get(halves, F.lit(k)), ":"))
        short = F.size(halves) == 2

        def join(both: Column) -> Column:
            left, right = both["left"], both["right"]
            n = F.size(left) + F.size(right)
            ok = F.forall(F.concat(left, right), lambda g: g.rlike("^[0-9a-f]{1,4}$")) & F.when(short, n <= 7).otherwise((F.size(halves) == 1) & (n == 8))
            every = F.concat(left, F.array_repeat(F.lit("0"), F.when(short, F.greatest(8 - n, F.lit(0))).otherwise(0)), right)
            return F.when(ok, F.array_join(F.transform(every, lambda g: F.lpad(g, 4, "0")), ""))

        return let(F.struct(of(0).alias("left"), of(1).alias("right")), join)

    def hexes(x: Column) -> Column:
        """The host with a dotted end as two groups."""
        byte = lambda i: F.lpad(F.lower(F.hex(F.get(F.split(x["tail"], r"\."), F.lit(i)).cast("bigint"))), 2, "0")
        head = F.substr(x["host"], F.lit(1), F.length(x["host"]) - F.length(x["tail"]))
        return F.when(x["tail"] == "", x["host"]).otherwise(F.concat(head, byte(0), byte(1), F.lit(":"), byte(2), byte(3)))

    plain = F.regexp_replace(host, "%.*$", "")
    parts = F.struct(plain.alias("host"), F.regexp_extract(plain, _DOTTED, 1).alias("tail"))
    return F.when(F.contains(host, F.lit(":")), let(parts, lambda x: let(F.split(hexes(x), "::"), spread)))


def address(host: Column) -> Column:
    """32 hexadecimal digits of the address that a host name is (without
    brackets, in lower case); null for other names."""
    v4 = let(_v4(host), lambda n: F.when(n.isNotNull(), F.concat(F.lit(_V4), F.lpad(F.lower(F.hex(n)), 8, "0"))))
    return F.coalesce(v4, _v6(host))
