import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ROOT = os.environ.get("BAZAARLENS_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from bazaarlens.session import get_session

    session = get_session("local[4]", "bazaarlens-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def root():
    if not os.path.isdir(ROOT):
        pytest.skip(f"no test tables at {ROOT}")
    return ROOT


@pytest.fixture(scope="session")
def duck(root):
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(root):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{root}/{name}'")
    return con
