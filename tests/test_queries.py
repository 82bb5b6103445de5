"""Every query against its SQL on the smallest tables; those without SQL must run."""

from __future__ import annotations

import pytest

from marginalia.plans import entities, resolution, retrieval, texts
from tests.conftest import of_spark

SF = "/root/testdata/sf0.001"
CATALOGS = (retrieval.catalog, texts.catalog, entities.catalog, resolution.catalog)
QUERIES = {n: q for c in CATALOGS for n, q in c.queries.items()}
SQL = {n: s for c in CATALOGS for n, s in c.sql.items()}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    columns, got = of_spark(QUERIES[name](spark, SF))
    if name not in SQL:
        assert columns and got
        return
    assert (columns, got) == duck(SQL[name], SF)


def test_entry(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
