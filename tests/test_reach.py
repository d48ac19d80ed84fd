"""Which nodes lead to others or to cycles, against brute force."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.operators import reach, tasks
from lodestone.operators.reach import leads_to
from lodestone.session import cut


def brute(edges, seeds, cycles):
    nodes = {x for e in edges for x in e} | set(seeds)
    ahead = {n: {b for a, b in edges if a == n} for n in nodes}
    far = {n: set(ahead[n]) for n in nodes}
    while True:
        grown = {n: far[n] | {y for x in far[n] for y in far.get(x, ())} for n in nodes}
        if grown == far:
            break
        far = grown
    on = {n for n in nodes if n in far[n]} if cycles else set()
    want = set(seeds) | on
    return {n for n in nodes if n in want or far[n] & want}


def got(spark, edges, seeds, cycles):
    e = spark.createDataFrame(edges, "node long, to long")
    s = spark.createDataFrame([(x,) for x in seeds], "node long")
    return {r.node for r in leads_to(e, s, cycles).collect()}


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=16), st.lists(st.integers(0, 9), max_size=2), st.booleans())
@settings(max_examples=12, deadline=None)
def test_random_graphs(spark, edges, seeds, cycles):
    assert got(spark, edges, seeds, cycles) == brute(edges, seeds, cycles)


def test_larger_graphs(spark):
    rng = random.Random(5)
    for n, m in ((60, 50), (60, 75), (40, 90)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        for cycles in (False, True):
            seeds = [rng.randrange(n)]
            assert got(spark, edges, seeds, cycles) == brute(edges, seeds, cycles)
    ladder = [(i, i - d) for i in range(12) for d in (1, 2) if i >= d]
    assert got(spark, ladder, [], True) == set() and got(spark, ladder, [3], False) == set(range(3, 12))


def test_long_chains_and_cycles(spark):
    # a chain of 100,000 links, and one that ends in a cycle of 1,000
    n = 100_000
    chain = spark.range(1, n).selectExpr("id node", "id - 1 to")
    ring = spark.range(1000).selectExpr(f"{n} + id node", f"{n} + (id + 1) % 1000 to")
    behind = spark.range(500).selectExpr(f"{n} + 1000 + id node", f"{n} + 999 + id to")
    none = spark.range(0).selectExpr("id node")
    assert leads_to(chain.union(ring).union(behind), none, cycles=True).count() == 1500
    assert leads_to(chain.union(ring).union(behind), spark.range(1).selectExpr("id node")).count() == n


def test_plans(spark):
    kind = "plan_id int, id int, depends_on array<int>, status string"
    loop = [(1, 1, [2], "PENDING"), (1, 2, [3, 4], "PENDING"), (1, 3, [1], "PENDING"), (1, 4, [], "FAILED"), (1, 5, [1], "PENDING"), (2, 1, [2], "PENDING"), (2, 2, [], "COMPLETED"), (2, 3, [3], "PENDING")]
    found = {(r.plan_id, r.id, r.problem) for r in tasks.problems(spark.createDataFrame(loop, kind)).collect()}
    assert found == {(1, i, "cycle") for i in (1, 2, 3, 5)} | {(2, 3, "cycle"), (2, 3, "self_dependency")}
    status = {(r.plan_id, r.id): r.status for r in tasks.block_orphans(spark.createDataFrame(loop, kind), transitive=True).collect()}
    assert {k for k, v in status.items() if v == "BLOCKED"} == {(1, 1), (1, 2), (1, 3), (1, 5)}
    done = [(1, 1, [], "FAILED"), (1, 2, [1], "COMPLETED"), (1, 3, [2], "PENDING")]
    assert not any(r.status == "BLOCKED" for r in tasks.block_orphans(spark.createDataFrame(done, kind), transitive=True).collect())


def test_loops_of_joins_keep_their_size_estimates(spark):
    at = spark.range(100).selectExpr("id node", "(id + 1) % 100 to")
    for _ in range(8):
        at = cut(at.join(at.toDF("to", "next"), "to").selectExpr("node", "next to"))
    assert int(str(at._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1 << 20


def test_short_rings_take_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(reach, "cut", lambda df: rounds.append(1) or cut(df))
    ends = reach._chain_ends(spark.range(30_000).selectExpr("id node", "id - id % 3 + (id + 1) % 3 to"))
    assert ends.where("open").count() == 30_000 and len(rounds) <= 3
