"""The operators' queries against their SQL on the sf0.01 tables."""

from pathlib import Path

import duckdb
import pytest

from feedworks.llm.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_there_is_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, str(DATA))
    expected = db.sql(ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(expected.columns)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    want = sorted((tuple(r[expected.columns.index(c)] for c in order) for r in expected.fetchall()), key=repr)
    assert len(got) == len(want) > 0
    assert not [(g, w) for g, w in zip(got, want) if g != w][:3]
