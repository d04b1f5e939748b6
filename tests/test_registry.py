"""Every registered query runs on the smallest tables and agrees with its SQL."""

import importlib
import os

import pytest

import __spark_entry__ as registry
from check import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")

ITERATIVE = {"mixture_gibbs"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_only_iterative_queries_lack_sql():
    own = [importlib.import_module(f"catalog.{subject}") for subject in registry.SUBJECTS]
    names = {name for module in own for name in module.QUERIES}
    assert names - set(registry.oracle_sql()) == ITERATIVE
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    df = registry.queries()[name](spark, SF_DIR)
    assert differences(df, con.sql(registry.oracle_sql()[name])) == []


@pytest.mark.parametrize("name", sorted(ITERATIVE))
def test_iterative_query_covers_all(spark, name):
    df = registry.queries()[name](spark, SF_DIR)
    assert df.count() >= 198 and df.dropna().count() == df.count()


def test_entry(spark):
    assert registry.entry(spark).columns == ["query_id", "category", "votes"]
