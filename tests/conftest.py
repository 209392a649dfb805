import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    from check import session
    from marginloom.session import configure
    return configure(session())


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from check import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return con
