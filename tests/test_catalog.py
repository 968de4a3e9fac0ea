"""Registered queries against their SQL counterparts on the small tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from palimpsest.catalog import queries
from check import rows_of

FOLDER = Path("/root/testdata/sf0.001")
# These attach branches in their own way or run a stream, which takes long; check.py runs them all.
SLOW = {"graft_none", "import_summary", "stream_import"}
NAMES = [name for name in contract.QUERIES if name not in SLOW]

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


@pytest.fixture(scope="module", autouse=True)
def shared_tables():
    """The derived log and the attached branches are made once for all queries."""
    made, plain = {}, queries.Tables
    queries.Tables = lambda spark, folder: made.setdefault(folder, plain(spark, folder))
    yield
    queries.Tables = plain


def test_every_query_has_sql():
    own = contract.QUERIES.keys()
    assert own == contract.ORACLES.keys()
    assert own <= contract.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    frame = contract.queries()[name](spark, str(FOLDER))
    relation = db.sql(contract.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(relation.columns, relation.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 40
