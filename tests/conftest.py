import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from inputs import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from popdist.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="popdist-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="popdist-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from popdist.fixtures import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con
