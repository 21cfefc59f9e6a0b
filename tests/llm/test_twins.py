"""Every training-data query that has an SQL twin against it, on the smallest tables."""

import pytest

from tests.test_oracles import SMALL, database, rows_of
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES


def test_thirteen_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees(spark, name):
    got = QUERIES[name](spark, SMALL)
    want = database(SMALL).execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    expected = rows_of(columns, want.fetchall())
    assert expected and rows_of(got.columns, [tuple(r) for r in got.collect()]) == expected
