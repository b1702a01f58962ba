"""Every registered query against its DuckDB SQL on the small scale factor."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = os.environ.get("TEMBLOR_ORACLE_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, float):
        return (1, "f", round(v, 6))
    if hasattr(v, "isoformat"):
        return (1, "t", v.isoformat())
    return (1, type(v).__name__, v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r)
                        for r in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


# The optional subpackage has tests of its own.
CORE = [E.driver, E.traces, E.coverage, E.streams, E.modeling]


@pytest.mark.parametrize("key", sorted(k for p in CORE for k in getattr(p, "ORACLE_SQL", {})))
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[key]).df()
    gcols, grows = _rows(got)
    ecols, erows = _rows(exp)
    assert gcols == ecols
    assert len(grows) == len(erows)
    assert grows == erows


def test_every_query_runs_and_entry(spark):
    assert E.entry(spark).count() > 0
    missing = {k for p in CORE for k in p.QUERIES} - set(E.oracle_sql())
    assert missing == {"model_metrics", "feature_importance", "scored_events", "alerts",
                       "stream_scored_events"}
