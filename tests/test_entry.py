import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


OWN = [name for module in entry_module._MODULES[:3] for name in module.QUERIES]


def test_every_query_has_sql():
    assert set(OWN) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["group_id", "rank", "token", "rel_popularity"]


@pytest.mark.parametrize("name", OWN)
def test_query_agrees_with_sql(spark, con, name):
    good, note, _ = compare(spark, con, name, SF_DIR)
    assert good, note
