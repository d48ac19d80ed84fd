"""Every registered query of the engine against its SQL."""

import pytest

from lodestone.plans.queries import ORACLES, QUERIES, entry
from tests.conftest import SF, rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    df = entry(spark, SF)
    assert df.columns == ["doc_id", "score", "rank"] and df.count() > 0


def test_relevance_stays_in_the_jvm(spark):
    plan = QUERIES["f4_relevant_documents"](spark, SF)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "Python" not in plan and "BroadcastNestedLoopJoin" not in plan
