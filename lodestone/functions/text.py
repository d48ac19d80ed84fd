"""Text functions as column expressions.  Patterns are Unicode-aware."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words of a query that name no thing
STOP_WORDS = ["add", "build", "create", "fix", "make", "implement", "with", "from", "this", "that", "the", "and"]
# fixed values: names that look like files
TECHNOLOGY_NAMES = ["next.js", "node.js", "react.js", "vue.js", "angular.js", "three.js"]
# fixed values: words of a step that make it risky
HIGH_RISK = ["deploy", "migration", "authentication", "security", "dependency", "commit", "database"]

# fixed value: what html.unescape takes for an entity
ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def query_terms(query: Column) -> Column:
    """Distinct lower-cased terms of three letters or more, without stop words,
    in the order in which they first stand in the query."""
    found = F.regexp_extract_all(F.lower(query), F.lit(r"[A-Za-z_][A-Za-z0-9_-]{2,}"), F.lit(0))
    return F.array_except(F.array_distinct(found), F.array(*[F.lit(w) for w in STOP_WORDS]))


def lines(text: Column) -> Column:
    """Lines without their ends; a last empty line does not count."""
    return F.split(F.regexp_replace(text, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n", -1)


def strip(value: Column) -> Column:
    """White space of any kind removed from both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def strip_tags(html: Column) -> Column:
    """Scripts and styles dropped, tags made spaces, white space collapsed;
    entities stay."""
    t = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", "")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def html_to_text(html: Column) -> Column:
    """``strip_tags`` with entities decoded.  Only the entities themselves go
    through Python, so its memory does not follow the texts."""
    from html import unescape

    @F.pandas_udf("array<string>")
    def decode(found: pd.Series) -> pd.Series:
        return found.map(lambda xs: None if xs is None else [unescape(x) for x in xs])

    t = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", ""), r"<[^>]+>", " ")
    decoded = decode(F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0)))
    # one part more than entities
    t = F.array_join(F.zip_with(F.split(t, ENTITY, -1), decoded, lambda part, x: F.concat(part, F.coalesce(x, F.lit("")))), "")
    return F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), r"(?U)^\s+|\s+$", "")


def human_size(size: Column) -> Column:
    s = size.cast("double")
    out = F.when(size < 1024, F.concat(size.cast("string"), F.lit("B")))
    for unit, scale in (("KB", 1024.0), ("MB", 1024.0**2), ("GB", 1024.0**3)):
        out = out.when(s < scale * 1024, F.concat(_one_place(s / scale), F.lit(unit)))
    return out.otherwise(F.concat(_one_place(s / 1024.0**4), F.lit("TB")))


def _one_place(x: Column) -> Column:
    """One decimal place of the exact binary value, ties to even: formatting
    functions differ there."""
    return F.bround(x.cast("decimal(38,18)"), 1).cast("string")


def file_names(prose: Column) -> Column:
    """Distinct repository paths that prose mentions, technology names left out."""
    pattern = r"(?:^|\s|`|'|\")([A-Za-z0-9_.-]+(?:/[A-Za-z0-9_.-]+)*\.[A-Za-z0-9]{1,8})(?=$|\s|`|'|\"|[),:;])"
    found = F.regexp_extract_all(prose, F.lit(pattern), F.lit(1))
    return F.array_distinct(
        F.transform(F.filter(found, lambda x: ~F.lower(x).isin(TECHNOLOGY_NAMES)), lambda x: F.regexp_replace(x, r"^[./]+", ""))
    )


def exit_code(output: Column) -> Column:
    """Exit code that a command tool's output states; null if it states none."""
    stated = F.regexp_extract(output, r"(?m)^❌ \(exit code (\d+)\)", 1)
    return F.when(output.rlike(r"(?m)^✅ \$"), F.lit(0)).when(stated != "", stated.cast("int"))


def tokens_by_chars(text: Column, chars: int = 4) -> Column:
    """Token estimate: whole groups of so many characters."""
    return F.floor(F.length(text) / chars).cast("bigint")


def token_upper_bound(value: Column) -> Column:
    """UTF-8 bytes of the compact JSON of a value: no tokenizer gives more."""
    return F.octet_length(F.to_json(value)).cast("bigint")


def redact_credentials(text: Column) -> Column:
    t = F.regexp_replace(text, r"(?U)(?i)\b(api[_-]?key|token|password|passwd|secret)\s*=\s*[^\s]+", "$1=[REDACTED]")
    return F.regexp_replace(
        t, r"(?U)\b(?:sk|gsk|nvapi|ghp)_[A-Za-z0-9_-]{8,}\b|\b(?:sk|gsk|nvapi)-[A-Za-z0-9_-]{8,}\b", "[REDACTED_CREDENTIAL]"
    )


def step_risk(title: Column, description: Column, intent: Column, has_tools: Column) -> Column:
    text = F.lower(F.concat_ws(" ", title, description))
    risky = F.lit(False)
    for w in HIGH_RISK:
        risky = risky | text.contains(w)
    return F.when(intent.isin("deploy", "security", "migrate") | risky, "high").when(~has_tools, "low").otherwise("medium")


def strip_version(name: Column, registry: Column) -> Column:
    npm = F.when(name.startswith("@"), F.regexp_extract(name, r"^(@[^@]*)", 1)).otherwise(F.regexp_extract(name, r"^([^@]*)", 1))
    return F.when(registry == "npm", npm).when(registry == "go", F.regexp_replace(name, r"@[^@]*$", "")).otherwise(F.regexp_extract(name, r"^([^<>=!~\[]*)", 1))


def is_local_or_url(name: Column) -> Column:
    return name.rlike(r"^(\.|/|git\+|http://|https://|file:)") | (name == "-")


def label_name(text: Column, limit: int = 160) -> Column:
    """A label usable as a file name: other characters become dashes, dashes and
    dots at both ends go.  Only the text's beginning is worked on, as far as the
    label's characters go, and the next letter after them: with one, no end follows."""
    one = r"(?:[A-Za-z0-9_.-]|[^A-Za-z0-9_.-]++)"
    head = F.regexp_extract(text, rf"\A[^A-Za-z0-9_]*+({one}{{0,{limit}}}+(?:[^A-Za-z0-9_]*+[A-Za-z0-9_])?+)", 1)
    return F.substring(F.regexp_replace(F.regexp_replace(head, r"[^A-Za-z0-9_.-]+", "-"), r"(?<![.-])[-.]+\z", ""), 1, limit)


def truncate_bytes(raw: Column, limit: int) -> Column:
    """struct(bytes, truncated): a binary value cut to so many bytes."""
    return F.struct(F.substring(raw, 1, limit).alias("bytes"), (F.octet_length(raw) > limit).alias("truncated"))


def claims_success(text: Column) -> Column:
    return text.rlike(r"(?Ui)\b(tests?|checks?|build)\b.{0,30}\b(pass(?:ed|ing)?|green|success)")


def edit_exact(text: Column, old: Column, new: Column) -> Column:
    """struct(text, found): the single occurrence of ``old`` replaced; found is
    the number of occurrences, and only one is replaced."""
    n = F.floor((F.length(text) - F.length(F.replace(text, old, F.lit("")))) / F.greatest(F.length(old), F.lit(1))).cast("int")
    at = F.position(old, text)
    done = F.concat(F.substr(text, F.lit(1), at - 1), new, F.substr(text, at + F.length(old)))
    return F.struct(F.when(n == 1, done).otherwise(text).alias("text"), n.alias("found"))


def edit_lines(text: Column, first: Column, last: Column, new: Column) -> Column:
    """Lines first..last (from 1) replaced by new text."""
    all_ = F.split(text, "\n", -1)
    head, tail = F.slice(all_, F.lit(1), F.greatest(first - 1, F.lit(0))), F.slice(all_, last + 1, F.greatest(F.size(all_) - last, F.lit(0)))
    return F.array_join(F.concat(head, F.array(new), tail), "\n")


def headers(text: Column, pattern: str, limit: int) -> Column:
    """First ``limit`` captures of a multi-line pattern."""
    return F.slice(F.regexp_extract_all(text, F.lit(f"(?m){pattern}"), F.lit(1)), 1, limit)
