"""Every catalogue query against its DuckDB SQL on the smallest tables, and
the driver contract (entry, names, schemas)."""

import duckdb
import pytest

import __spark_entry__ as E
from moodlake.plans.catalog import queries as library_queries
from moodlake.sources.tables import TABLES
from scripts.oracle_check import rows_key, type_diffs
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["topic", "sentiment_category", "emotion", "plays"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(library_queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    assert type_diffs(df, rel, cols) == []
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert rows_key(srows) == rows_key(drows)
