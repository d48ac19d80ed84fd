"""Point-in-time join: for each ask, the version of its source that was known
and valid at that time.

A version is usable at time t when event <= t and arrival <= t < expiry; times
are whole numbers of one unit.  Of the usable versions the latest event wins,
then the earliest arrival, then the largest id.

Method: each usable interval is exploded into the bins that it covers exactly.
Bins have fixed borders and widths of 1, 4, 16, ... units, so an interval of
n units takes about 3 log4(n) of them on either side and bins never have to be
split.  Per source and bin only the largest (event, -arrival, id) stays, by
partial aggregation before the exchange: a bin has one row, however many
versions a hot source has.  Distinct (source, time) asks are joined to their
bin of each width by source and bin, filtered exactly, and the ordered max
struct of what is left is the winner.  Work is in proportion to versions plus
asks; no pairs of a source's versions and asks are made.

Defined cases: versions with a null source, event, arrival or expiry, and
empty intervals, are never usable; a null id is the smallest of ties.  Rows
equal in all of these are told apart by the carried columns (the largest
wins).  Asks with a null source or time have no winner; repeated asks each keep
their row.  Empty tables give an empty result, or asks without winners.  All
columns of the asks are kept, whatever their names; the winner is one struct
column, and a name that the asks already have is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = 4


def _floor(x: Column, width: int) -> Column:
    """x / width, rounded down, in whole numbers."""
    return F.call_function("div", x - F.pmod(x, F.lit(width).cast("long")), F.lit(width).cast("long")) if width > 1 else x


def _ceil(x: Column, width: int) -> Column:
    return -_floor(-x, width)


def _range(low: Column, high: Column) -> Column:
    return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))


def _marked(level: int):
    return lambda b: F.struct(F.lit(level).alias("level"), b.alias("bin"))


def covering_bins(start: Column, end: Column, levels: int) -> Column:
    """Array of (level, bin): the fewest aligned bins that make up [start, end)."""
    out = []
    for level in range(levels):
        width = BASE**level
        low, high = _ceil(start, width), _floor(end, width)
        bins = _range(low, high)
        if level + 1 < levels:
            up_low, up_high = _ceil(start, width * BASE), _floor(end, width * BASE)
            bins = F.when(up_low < up_high, F.concat(_range(low, up_low * BASE), _range(up_high * BASE, high))).otherwise(bins)
        out.append(F.transform(bins, _marked(level)))
    return F.flatten(F.array(*out))


def bins_at(time: Column, levels: int) -> Column:
    """Array of (level, bin): the bin of each width that holds a time."""
    return F.array(*[F.struct(F.lit(k).alias("level"), _floor(time, BASE**k).alias("bin")) for k in range(levels)])


def join(
    asks: DataFrame,
    versions: DataFrame,
    carry: Sequence[str] = (),
    source: str = "source",
    at: str = "t",
    event: str = "event",
    arrival: str = "arrival",
    expiry: str = "expiry",
    version_id: str = "doc_id",
    into: str = "winner",
    levels: int | None = None,
) -> DataFrame:
    """``asks`` with a struct column ``into`` of the winning version's event,
    arrival, expiry, id and ``carry`` columns, null without a winner.

    ``levels`` is the number of bin widths; left out, one aggregate over the
    versions finds the longest interval and widths go up to it.
    """
    if into.lower() in (c.lower() for c in asks.columns):
        raise ValueError(f"the asks already have a column {into}")
    names = [f"c{k}" for k in range(len(carry))]
    usable = (
        versions.select(
            F.col(source).alias("source"), F.col(event).cast("long").alias("event"), F.col(arrival).cast("long").alias("arrival"),
            F.col(expiry).cast("long").alias("expiry"), F.col(version_id).alias("id"), *[F.col(c).alias(n) for c, n in zip(carry, names)],
        )
        .withColumn("start", F.greatest("event", "arrival"))
        .where("source is not null and event is not null and arrival is not null and start < expiry")
    )
    if levels is None:
        longest = usable.agg(F.max(F.col("expiry") - F.col("start")).alias("n")).first()["n"] or 1
        levels = 1
        while BASE**levels <= longest:
            levels += 1
    rank = F.struct("event", (-F.col("arrival")).alias("early"), "id", *names, "expiry").alias("best")
    covers = (
        usable.select("source", rank, F.explode(covering_bins(F.col("start"), F.col("expiry"), levels)).alias("b"))
        .groupBy("source", "b.level", "b.bin")
        .agg(F.max("best").alias("best"))
    )
    rows = asks.select(F.col(source).alias("source"), F.col(at).cast("long").alias("at"), F.struct("*").alias("row"))
    answerable = F.col("source").isNotNull() & F.col("at").isNotNull()
    winners = (
        rows.where(answerable)
        .select("source", "at")
        .distinct()
        .select("source", "at", F.inline(bins_at(F.col("at"), levels)))
        .join(covers, ["source", "level", "bin"])
        .where("best.event <= at and -best.early <= at and at < best.expiry")
        .groupBy("source", "at")
        .agg(F.max("best").alias("best"))
    )
    winner = F.struct(
        F.col("best.event").alias("event"), (-F.col("best.early")).alias("arrival"), F.col("best.expiry").alias("expiry"),
        F.col("best.id").alias("id"), *[F.col(f"best.{n}").alias(c) for n, c in zip(names, carry)],
    )
    found = rows.where(answerable).join(winners, ["source", "at"], "left").select("row", F.when(F.col("best").isNotNull(), winner).alias("winner"))
    kind = found.schema["winner"].dataType
    # rows without a source or time would all meet in one task of the join
    rest = rows.where(~answerable).select("row", F.lit(None).cast(kind).alias("winner"))
    return found.unionByName(rest).select("row.*", F.col("winner").alias(into))
