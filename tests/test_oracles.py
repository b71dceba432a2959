"""Every registered query against the SQL that must give the same rows."""

import pytest

from pagemill.catalogue import load_all
from tests import oracle_check as oc

QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oc.connect(sf_dir)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    got = oc.spark_answer(QUERIES[name](spark, sf_dir))
    assert oc.difference(got, oc.duck_answer(duck, ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_flat_columns(spark, sf_dir, name):
    flat = ("array", "map", "struct", "variant", "binary")
    assert not [c for c, t in QUERIES[name](spark, sf_dir).dtypes if t.startswith(flat)]
