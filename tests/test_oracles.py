"""Every registered query against its SQL twin on the given tables."""

import math
from pathlib import Path

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import QUERIES

DATA = Path("/root/testdata")
SMALL, MEDIUM = str(DATA / "sf0.001"), str(DATA / "sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


FLAGSHIP = ("v2_empty_run_eligibility", "v9_retry_summary", "scenario_retry")


@pytest.mark.parametrize(
    ("name", "sf_dir"),
    [(name, MEDIUM) for name in sorted(QUERIES)] + [(name, SMALL) for name in FLAGSHIP],
)
def test_query_agrees(spark, name, sf_dir):
    got = QUERIES[name](spark, sf_dir)
    want = database(sf_dir).execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    expected = rows_of(columns, want.fetchall())
    assert expected, "an empty answer proves nothing"
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == expected
