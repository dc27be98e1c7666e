from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from frameloom.plans.session import local_session  # noqa: E402

SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, partitions=4, memory="6g", name="frameloom-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    if not SMALL.exists():
        pytest.skip("no test tables here")
    return str(SMALL)


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    con = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con
