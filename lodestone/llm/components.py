"""Connected components of an edge table.

Rounds are repeated until all edges are stars: as many tasks as slices of bounded
size make stars of their edges by union-find, then a large and a small star
across all of them.  A round is a handful of joins and aggregations, its edges
are written to the shared scratch space, so lineage stays short and lost
executors cost one round.
Nothing is collected but a row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


SLICE = 300_000  # edges that a task holds and contracts at once


def _contracted(e: DataFrame, most: int) -> DataFrame:
    """Edges that connect the same nodes, fewer of them: every task replaces
    each slice of its edges by stars, which union-find makes of it."""
    node = e.schema["u"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        top: dict = {}
        seen = 0

        def find(x):
            while (p := top.setdefault(x, x)) != x:
                top[x] = top.setdefault(p, p)
                x = top[x]
            return x

        def stars(kind):
            pairs = [(x, r) for x in top if (r := find(x)) != x]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], kind), pa.array([p[1] for p in pairs], kind)], ["u", "v"])

        kind = None
        for b in batches:
            kind = b.schema.field("u").type
            for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist()):
                x, y = find(u), find(v)
                if x != y:
                    top[max(x, y)] = min(x, y)
            seen += b.num_rows
            if seen >= most:
                yield stars(kind)
                top.clear()
                seen = 0
        if top:
            yield stars(kind)

    return e.mapInArrow(run, f"u {node}, v {node}")


def components(edges: DataFrame, a: str = "a", b: str = "b", slice_edges: int = SLICE) -> DataFrame:
    """(node, label) of every node that has an edge to another; the label is
    the smallest node of its component.  Null ends, loops and repeated edges
    are ignored.  Any orderable node type."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
    e = written(e.distinct(), "edges")
    while n := e.count():
        tasks = -(-n // slice_edges)
        e = written(_contracted(e.coalesce(tasks), slice_edges).distinct(), "edges")
        if tasks == 1:
            break
        # stars whose nodes have one neighbour each, which has none above it?
        twice = e.groupBy("u").count().where("count > 1").select("u")
        above = e.join(e.select(F.col("v").alias("u")), "u", "left_semi").select("u")
        if not twice.unionByName(above).take(1):
            break
        # large star: every larger neighbour of u goes to u's smallest
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u")
        small = (
            pairs.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where(F.col("u") > F.col("v")).distinct()
        )
        e = written(small, "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
