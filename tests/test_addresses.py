"""Addresses against the standard library, and URLs that write them oddly."""

import ipaddress
import random

from pyspark.sql import functions as F

from lodestone.functions import addresses
from lodestone.operators import security


def values(spark, hosts):
    df = spark.createDataFrame(list(enumerate(hosts)), "i int, h string")
    kinds = [addresses.within(F.col("a"), x).alias(f"k{k}") for k, x in enumerate((addresses.LOOPBACK, addresses.PRIVATE, addresses.NOT_PRIVATE, addresses.LINK_LOCAL, addresses.MULTICAST))]
    return df.select("i", addresses.address(F.col("h")).alias("a")).select("i", "a", *kinds).orderBy("i").collect()


def test_addresses_equal_the_standard_librarys(spark):
    rng, every = random.Random(1), []
    for n in addresses.PRIVATE + addresses.LOOPBACK + addresses.MULTICAST + addresses.NOT_PRIVATE + ["8.8.8.0/24", "2606:4700::/32", "64:ff9b::/96"]:
        if n == "3fff::/20":  # not in every version of the library
            continue
        net = ipaddress.ip_network(n)
        low, high = int(net.network_address), int(net.broadcast_address)
        kind = ipaddress.IPv4Address if net.version == 4 else ipaddress.IPv6Address
        for x in {low, high, max(0, low - 1), min(high + 1, 2 ** (32 if net.version == 4 else 128) - 1), rng.randint(low, high)}:
            every.append(kind(x))
    hosts = [str(x) for x in every] + [x.exploded for x in every]
    for r, x in zip(values(spark, hosts), every * 2):
        mapped = x.ipv4_mapped if x.version == 6 else x
        number = int(x) if x.version == 6 else int(x) + (0xFFFF << 32)
        assert r.a == f"{number:032x}"
        y = mapped or x
        assert r.k0 == y.is_loopback and (r.k1 and not r.k2) == y.is_private and r.k3 == y.is_link_local and r.k4 == y.is_multicast, y


def test_what_is_no_address(spark):
    bad = ["", "a.com", "1.2.3.4.5", "256.1.1.1", "1.2.3.256", "1.2.65536", "4294967296", "0x", "08.1.1.1", "1..2", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "::12345", "::g", ":1:2:3:4:5:6:7:8", "::1.2.3.256", "99999999999", None]
    assert [r.a for r in values(spark, bad)] == [None] * len(bad)
    good = {"::": 0, "1::": 1 << 112, "::ffff:1.2.3.4": 0xFFFF01020304, "fe80::1%eth0": (0xFE80 << 112) + 1, "0x7f.1": 0xFFFF7F000001, "017700000001": 0xFFFF7F000001, "127.1": 0xFFFF7F000001, "1:2:3:4:5:6:7::": int(ipaddress.ip_address("1:2:3:4:5:6:7:0"))}
    assert [r.a for r in values(spark, list(good))] == [f"{v:032x}" for v in good.values()]


def test_urls(spark):
    want = {
        "http://[::ffff:127.0.0.1]/": "loopback", "http://[0:0:0:0:0:0:0:1]:80/x": "loopback", "http://[::ffff:169.254.169.254]/latest": "metadata", "http://2130706433/": "loopback",
        "http://0x7f.0.0.1/": "loopback", "http://a@10.0.0.1:8/": "private_range", "https://[FD00::1]/": "private_range", "http://169.254.1.1/": "private_range", "http://[ff02::1]": "multicast",
        "http://0.0.0.0/": "private_range", "http://8.8.8.8/": None, "http://[2606:4700::1111]/": None, "http://example.com./": None, "http://10.example.com/": None, "http://metadata.goog./": "metadata",
        "ftp://8.8.8.8/": "blocked_scheme",
    }
    df = spark.createDataFrame([(u,) for u in want], "u string")
    assert {r.u: r.v for r in df.select("u", security.url_verdict(F.col("u")).alias("v")).collect()} == want
    loose = {r.u: r.v for r in df.select("u", security.url_verdict(F.col("u"), allow_localhost=True, allow_private=True).alias("v")).collect()}
    assert loose["http://169.254.1.1/"] == "link_local" and loose["http://0.0.0.0/"] == "unspecified" and loose["http://a@10.0.0.1:8/"] is None and loose["http://2130706433/"] is None
