"""Every query of the library beside its SQL, and those without SQL for stable rows."""

import pytest

from voxloom.plans import catalogue

from .oracle import difference


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert difference(catalogue.QUERIES[name](spark, sf_dir), catalogue.ORACLE_SQL[name], sf_dir) == ""


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_query_without_sql_repeats_itself(spark, sf_dir, name):
    runs = [sorted(map(str, catalogue.QUERIES[name](spark, sf_dir).collect())) for _ in range(2)]
    assert runs[0] == runs[1] and runs[0]
