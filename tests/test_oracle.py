"""Registered queries vs their DuckDB twins, on the single-task and the distributed path."""

import os
import sys

import pytest

import __spark_entry__ as entry_mod

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, canon  # noqa: E402

SF = "/root/testdata/sf0.001"
# queries whose plans go through the ordering helper (ranks, percentiles, series, AUC)
ORDERED = [
    "add_id", "bins_quantile", "bins_edges", "clip_percentile", "rfm_scores", "fir_filter", "median_filter",
    "iir_filter", "binary_metrics", "regression_metrics", "group_by", "fill_missing", "categories_freq",
    "anomaly_iqr", "dedupe_first", "roc_pr_curve", "knn_vote",
]


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _compare(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    cur = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    assert canon(rows, cols) == canon(cur.fetchall(), ocols)


@pytest.mark.parametrize("name", ORDERED)
def test_ordering_queries(spark, duck, name):
    _compare(spark, duck, name)
