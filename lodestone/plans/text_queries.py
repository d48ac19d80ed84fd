"""Queries of address forms, edits and nested fences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import edits
from ..operators import security
from . import tables as t
from .queries import query

_BLOCKS = [2130706432, 167772160, 2886729728, 3232235520, 2851995648, 3758096384, 0, 1681915904, 134744072, 3627734028]
_NUMBER = f"CASE WHEN page_id % 11 = 10 THEN page_id * 2654435761 % 4294967296 ELSE {_BLOCKS}[page_id % 11 + 1] + page_id * 7919 % 65536 END"


def _ranges(*spans: tuple[str, str]) -> str:
    number = lambda a: sum(int(x) << (24 - 8 * i) for i, x in enumerate(a.split(".")))
    return " OR ".join(f"n BETWEEN {number(a)} AND {number(b)}" for a, b in spans)


@query(
    "b15_address_forms",
    f"""SELECT page_id, CASE WHEN n IN (2852039166, 1684300232, 3221225664) THEN 'metadata' WHEN {_ranges(("127.0.0.0", "127.255.255.255"))} THEN 'loopback'
WHEN n NOT IN (3221225481, 3221225482) AND ({_ranges(("0.0.0.0", "0.255.255.255"), ("10.0.0.0", "10.255.255.255"), ("169.254.0.0", "169.254.255.255"), ("172.16.0.0", "172.31.255.255"), ("192.0.0.0", "192.0.0.255"), ("192.0.2.0", "192.0.2.255"),
("192.168.0.0", "192.168.255.255"), ("198.18.0.0", "198.19.255.255"), ("198.51.100.0", "198.51.100.255"), ("203.0.113.0", "203.0.113.255"), ("240.0.0.0", "255.255.255.255"))}) THEN 'private_range'
WHEN {_ranges(("224.0.0.0", "239.255.255.255"))} THEN 'multicast' END AS verdict FROM (SELECT page_id, {_NUMBER} AS n FROM pages)""",
)
def address_forms(spark, d):
    """Hosts of pages replaced by addresses in seven ways of writing: dotted,
    decimal, hexadecimal, octal parts, two parts, mapped, and all groups."""
    i = F.col("page_id")
    n = F.when(i % 11 == 10, i * 2654435761 % 4294967296).otherwise(F.get(F.array(*[F.lit(b).cast("bigint") for b in _BLOCKS]), (i % 11).cast("int")) + i * 7919 % 65536)
    byte = lambda k: F.shiftrightunsigned(n, 24 - 8 * k).bitwiseAND(F.lit(255))
    dotted = F.concat_ws(".", *[byte(k).cast("string") for k in range(4)])
    half = lambda k: F.lower(F.hex(byte(2 * k) * 256 + byte(2 * k + 1)))
    forms = [
        dotted, n.cast("string"), F.concat(F.lit("0x"), F.hex(n)), F.concat_ws(".", *[F.concat(F.lit("0"), F.conv(byte(k).cast("string"), 10, 8)) for k in range(4)]),
        F.concat(byte(0).cast("string"), F.lit("."), (n % (1 << 24)).cast("string")), F.concat(F.lit("[::ffff:"), dotted, F.lit("]")),
        F.concat(F.lit("[0:0:0:0:0:FFFF:"), half(0), F.lit(":"), half(1), F.lit("]")),
    ]
    host = F.get(F.array(*forms), (F.floor(i / 11) % len(forms)).cast("int"))
    path = F.regexp_replace("url", "^[^:]*://[^/]*", "")
    url = F.concat(F.lit("https://user@"), host, F.lit(":443"), path)
    return t.table(spark, d, "pages").select("page_id", security.url_verdict(url).alias("verdict"))


# -------------------------------------------------------------------- edits

_STRIPPED = "regexp_replace(x, '^\\s+|\\s+$', '', 'g')"


@query(
    "h20_line_edits",
    f"""WITH l AS (SELECT doc_id, text AS t, CASE WHEN ends_with(text, chr(10)) THEN string_split(text, chr(10))[:-2] ELSE string_split(text, chr(10)) END AS ls FROM documents WHERE text <> ''),
k AS (SELECT *, len(ls)::BIGINT AS n, 1 + doc_id % len(ls) AS i, least(2, len(ls) - doc_id % len(ls)) AS m FROM l),
o AS (SELECT *, array_to_string(list_transform(ls[i:i + m - 1], lambda x: '  ' || x || chr(9)), chr(10)) AS o, list_filter(list_transform(ls[i:i + m - 1], lambda x: {_STRIPPED}), lambda x: x <> '') AS w FROM k),
r AS (SELECT *, (length(t) - length(replace(t, o, ''))) // length(o) AS c, list_filter(range(1, n - m + 2), lambda j: len(w) > 0 AND list_filter(list_transform(ls[j:j + m - 1], lambda x: {_STRIPPED}), lambda x: x <> '') = w) AS js FROM o),
h AS (SELECT *, CASE WHEN c = 1 THEN 'exact' WHEN c > 1 THEN 'ambiguous' WHEN len(js) = 1 THEN 'lines' ELSE 'absent' END AS how,
 CASE WHEN c = 1 THEN o ELSE array_to_string(ls[js[1]:js[1] + m - 1], chr(10)) || CASE WHEN js[1] + m - 1 < n OR ends_with(t, chr(10)) THEN chr(10) ELSE '' END END AS run FROM r)
SELECT doc_id, how, sha256(CASE WHEN how IN ('exact', 'lines') THEN substr(t, 1, strpos(t, run) - 1) || '[edited]' || substr(t, strpos(t, run) + length(run)) ELSE t END) AS sha256 FROM h""",
)
def line_edits(spark, d):
    """Two lines of each document, with other white space around, replaced."""
    docs = t.table(spark, d, "documents").where("text <> ''").select("doc_id", "text", edits.lines_of(F.col("text")).alias("ls"))
    at = (F.col("doc_id") % F.size("ls")).cast("int") + 1
    some = F.transform(F.slice("ls", at, F.lit(2)), lambda x: F.concat(F.lit("  "), F.regexp_replace(x, "\n$", ""), F.lit("\t")))
    done = docs.select("doc_id", edits.edit_text(F.col("text"), F.array_join(some, "\n"), F.lit("[edited]")).alias("e"))
    return done.select("doc_id", "e.how", F.sha2("e.text", 256).alias("sha256"))


@query(
    "k10_nested_fences",
    """SELECT doc_id, lang AS language, '# filepath: ' || source || '/x' || chr(10) || '# action: CREATE' AS headers,
sha256(regexp_replace(regexp_extract(text || chr(10) || '```', '(?s)^(.*?)```', 1), '\\s+\\z', '')) AS code FROM documents WHERE doc_id % 3 <> 0 AND lang IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL""",
)
def nested_fences(spark, d):
    """Texts as answers, two in three with their code in a fence of its own."""
    own = F.concat(F.lit("```language\n# filepath: "), F.col("source"), F.lit("/x\n# action: CREATE\n```"), F.col("lang"), F.lit("\n"), F.col("text"), F.lit("\n```\n```\n"))
    raw = F.when(F.col("doc_id") % 3 != 0, own).otherwise(F.concat(F.lit("```"), F.col("lang"), F.lit("\n"), F.col("text"), F.lit("\n```")))
    got = t.table(spark, d, "documents").select("doc_id", edits.recover_nested_fence(raw).alias("f")).where("f is not null")
    return got.select("doc_id", "f.language", "f.headers", F.sha2("f.code", 256).alias("code"))
