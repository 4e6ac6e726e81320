"""A representative query of each family against its DuckDB oracle at sf0.001
(the full sweep is tools/check_oracle.py)."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_of

SAMPLE = ["flagship_top_rides", "p6_quantile_trim", "d2_dedup_keep_last", "u3_precedence_merge",
          "f1_parse_hour", "f15_bridge_day", "f22_clamp_round", "features_full_layer", "a7_history_all_grains",
          "j1_attach_histories", "j7_history_cascade", "b7_result_record", "b9_best_hour", "s4_feed_flatten",
          "s7_chart_extract", "a18_box_summary_by_ride", "m2_stratified_split", "m18_classification_metrics",
          "x1_x3_stream_merge", "x6_tick_rollup", "m8_vector_entries", "m9_scaled_entries", "m22_aligned_requests",
          "s13_qualified_path"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    drows, dcols = rows_of([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    assert sorted(srows, key=key) == sorted(drows, key=key)
