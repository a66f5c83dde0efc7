import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import checkpoint_dir, get_session
    s = get_session("local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from quarry.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_MID, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
