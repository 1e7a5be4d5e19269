import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rankloom.session import local_session
    s = local_session("*", shuffle_partitions=8, driver_memory="8g")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from rankloom.sources.testdata import RAW_TABLES
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con
