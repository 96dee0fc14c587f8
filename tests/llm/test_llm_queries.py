import pytest
from oracle import same

from stratakit.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.registry.queries))
def test_query(spark, name):
    query, sql = queries.registry.queries[name], queries.registry.sql.get(name)
    if sql is None:
        assert query(spark, FOLDER).count() >= 0
    else:
        same(spark, query, sql, FOLDER)
