"""Which nodes of a directed graph lead to given ones, or to a cycle.

A loop over breadth takes a round, and a job, for each link of the longest
chain.  Here every round contracts: the nodes with one edge left make chains,
and pointer doubling sends each to the end of its chain (or finds that it has
none, which is a cycle); nodes whose targets are all settled go.  Chains and
trees take a number of rounds that grows with the logarithm of their length.
What is left branches everywhere and ends nowhere, so all of it leads to a cycle.
Tables here may be as large as the graph, so joins are merge joins: none is broadcast.
A graph that branches at every node and still ends (each step depending on the
two before it) loses a layer a round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _chain_ends(chains: DataFrame) -> DataFrame:
    """(node, to, open) of chains(node, to), one row per node: ``to`` becomes the
    first node that is no chain's; open: there is none.

    ``low`` is the least node on the way from a node to its ``to``, which is left
    out.  If it is the least one of the next stretch, too, the way has met it
    twice, so it goes round: rings are settled by the logarithm of their own length."""
    going = chains.select("node", "to", F.col("node").alias("low"))
    settled: list[DataFrame] = []
    while going.take(1):
        ahead = going.withColumn("open", F.lit(None).cast("boolean"))
        for s in settled:
            ahead = ahead.unionByName(s)
        ahead = ahead.toDF("to", "next", "low_next", "open_next").withColumn("there", F.lit(True))
        is_open = F.when(F.col("there").isNull(), F.lit(False)).when(F.col("open_next").isNotNull(), F.col("open_next")).when(F.col("low") == F.col("low_next"), F.lit(True))
        joined = going.join(ahead.hint("merge"), "to", "left").select(
            "node", F.when(F.col("there"), F.col("next")).otherwise(F.col("to")).alias("to"), F.least("low", "low_next").alias("low"), is_open.alias("open")
        )
        joined = cut(joined)
        settled.append(joined.where("open is not null"))
        going = joined.where("open is null").drop("open")
    return reduce(DataFrame.unionByName, [s.select("node", "to", "open") for s in settled])


def leads_to(edges: DataFrame, seeds: DataFrame, cycles: bool = False) -> DataFrame:
    """(node) of the seeds(node) and of every node with a path along
    edges(node, to) to one of them, or, with ``cycles``, to a cycle."""
    yes = cut(seeds.select("node").distinct())
    left = cut(edges.select("node", "to").distinct())
    passed: list[DataFrame] = []
    n = left.count()
    while n:
        hit = cut(left.join(yes.withColumnRenamed("node", "to").hint("merge"), "to", "left_semi").select("node").distinct())
        # nodes that are settled take no further part: those that hit, and targets without edges
        left = cut(left.join(hit.unionByName(yes).hint("merge"), "node", "left_anti"))
        left = cut(left.join(left.select(F.col("node").alias("to")).distinct().unionByName(hit.withColumnRenamed("node", "to")).distinct().hint("merge"), "to", "left_semi"))
        yes = cut(yes.unionByName(hit).distinct())
        chains = cut(left.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("to").alias("to")).where("n = 1").drop("n"))
        if chains.take(1):
            ends = _chain_ends(chains)
            if cycles:
                yes = cut(yes.unionByName(ends.where("open").select("node")).distinct())
            closed = ends.where("not open").select("node", F.col("to").alias("end"))
            passed.append(closed)
            rest = left.join(chains.hint("merge"), "node", "left_anti").join(ends.select(F.col("node").alias("to"), "open", F.col("to").alias("end")).hint("merge"), "to", "left")
            if not cycles:  # a chain that never ends leads nowhere
                rest = rest.where("not coalesce(open, false)")
            left = cut(rest.select("node", F.when(F.col("open"), F.col("to")).otherwise(F.coalesce("end", "to")).alias("to")).distinct())
        m = left.count()
        if m == n and not chains.take(1):
            break
        n = m
    if n and cycles:
        yes = yes.unionByName(left.select("node")).distinct()
    for closed in reversed(passed):
        yes = cut(yes.unionByName(closed.join(yes.withColumnRenamed("node", "end").hint("merge"), "end", "left_semi").select("node")).distinct())
    return yes
