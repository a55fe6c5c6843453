"""Every registered query gives the rows of its SQL on the smallest tables."""

import pytest

from tickloom.plans import registry
from tools.compare import rows_of

QUERIES, ORACLE = registry.load()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, sql, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    cursor = sql.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
