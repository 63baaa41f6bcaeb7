from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from mercato.session import get_session

    s = get_session(
        "mercato-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="mercato-test-ckpt-")},
    )
    yield s
    from mercato.functions.common import drop_materialized

    drop_materialized(s)
    s.stop()


@pytest.fixture(scope="session")
def queries():
    import __spark_entry__ as E

    return E.queries()


@pytest.fixture(scope="session")
def oracles():
    import __spark_entry__ as E

    return E.oracle_sql()


@pytest.fixture(scope="session")
def duck_small():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem documents benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
