import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from support import SF_SMALL, TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from larder.session import get_session

    ckpt = tempfile.mkdtemp(prefix="larder-test-ckpt-")
    s = get_session("local[4]", shuffle_partitions=8, app_name="larder-tests",
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con
