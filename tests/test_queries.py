"""Registered queries against their SQL, over whole tables at the smallest scale."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
import __spark_entry__ as entry  # noqa: E402
from check_oracles import close, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
ALL = os.environ.get("PLUMBLINE_ALL_QUERIES")
SAMPLE = ["group_rate_by_segment", "prepared_loans", "contract_violations", "asof_last_click", "leakage_probe", "time_split_summary", "winsor_log_engineer", "scorecard_points",
          "classification_summary", "decile_rates", "describe_numeric", "spearman_pairs", "numeric_drift", "version_health", "stream_window_stats"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if ALL else SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    got, want = rows_of(df.columns, df.collect()), rows_of(cols, cur.fetchall())
    assert sorted(cols) == sorted(df.columns) and len(got) == len(want)
    assert all(close(a, b) for g, w in zip(got, want) for a, b in zip(g, w))


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
