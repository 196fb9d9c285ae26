"""Every registered query with an oracle agrees with DuckDB at sf0.001."""

import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    import duckdb
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ngram", "count"]
    assert df.count() > 0


def test_stage_counts_agree_with_drop_reasons(spark):
    q = E.queries()
    stages = {r["stage"]: r["rows"] for r in q["stage_counts"](spark, SF_SMALL).collect()}
    reasons = {r["reason"]: r["n"] for r in q["drop_reasons"](spark, SF_SMALL).collect()}
    assert stages["loaded"] == sum(reasons.values())
    assert stages["script_filtered"] == stages["loaded"] - reasons.get("script", 0)
    assert stages["final"] == reasons.get("kept", 0)
