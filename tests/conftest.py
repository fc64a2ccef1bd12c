import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from affinity.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="affinity-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "events", "customer"):
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def signals_df(spark, rows, with_type=False):
    schema = "user string, item string, weight double" + (", signal_type string" if with_type else "")
    return spark.createDataFrame(rows, schema)


def links_df(spark, rows):
    """(item_A, item_B, weight, raw_weight) links."""
    return spark.createDataFrame(rows, "item_A string, item_B string, weight double, raw_weight double")
