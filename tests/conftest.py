import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from pairloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = ("customer", "orders", "documents", "conversations")


@pytest.fixture(scope="session")
def spark():
    return local_session("8", partitions=4, app="tests")


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con
