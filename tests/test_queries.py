"""Every query against its SQL on the smallest scale; queries without SQL must run."""

import pytest
from oracle import same

from stratakit.plans import grids, loading, logs, miners, problems, soundings

FOLDER = "/root/testdata/sf0.001"
ALL = {n: (f, r.sql.get(n)) for r in (problems.registry, soundings.registry, grids.registry, miners.registry, loading.registry, logs.registry) for n, f in r.queries.items()}


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, name):
    query, sql = ALL[name]
    if sql is None:
        assert query(spark, FOLDER).count() >= 0
    else:
        same(spark, query, sql, FOLDER)


def test_entry_lists_every_core_query():
    import __spark_entry__

    assert set(ALL) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
