import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lodestone.session import session

    s = session(
        "local[4]", 4,
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    """Rows of a pandas frame, columns and rows in a fixed order."""

    def plain(v):
        if v is None or str(v) in ("NaT", "<NA>", "nan", "None"):
            return None
        return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    cols = sorted(df.columns)
    return sorted((tuple(plain(v) for v in r) for r in df[cols].astype(object).values.tolist()), key=repr)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c
