"""Every registered query beside its SQL on the smallest tables, plus shape checks of the registry."""

import importlib
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from checks import MODULES
from checks.compare import canon, connect

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("module", MODULES)
def test_queries_equal_their_sql(spark, duck, module):
    queries = entry.queries()

    def differs(item):
        name, sql = item
        df = queries[name](spark, SF)
        got = canon([tuple(r) for r in df.collect()], df.columns)
        rel = duck.cursor().execute(sql)
        columns = [d[0] for d in rel.description]
        return None if got == canon(rel.fetchall(), columns) else name

    with ThreadPoolExecutor(4) as pool:
        assert [n for n in pool.map(differs, importlib.import_module(f"checks.{module}").SQL.items()) if n] == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_of_the_library_has_sql():
    from checks import all_sql
    from stairfare.catalog import all_queries
    assert set(all_queries()) == set(all_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
