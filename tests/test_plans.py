"""Plan-shape regression checks on the final (adaptive) physical plans."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF_SMALL


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("\n+- == Initial Plan ==")[0]


@pytest.fixture(scope="module")
def qs():
    import __spark_entry__ as E
    return E.queries()


@pytest.mark.parametrize("name", ["b7_result_record", "j1_attach_histories", "flagship_top_rides",
                                  "a7_history_all_grains", "f22_clamp_round", "p6_quantile_trim"])
def test_no_python_no_sort_merge_no_nested_loop(spark, qs, name):
    txt = final_plan(qs[name](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", txt)
    assert "SortMergeJoin" not in txt
    assert "BroadcastNestedLoopJoin" not in txt and "CartesianProduct" not in txt


def test_scoring_probes_broadcast_histories(spark, qs):
    txt = final_plan(qs["b7_result_record"](spark, SF_SMALL))
    assert len(re.findall(r"BroadcastHashJoin", txt)) >= 9          # every cascade level is a hash probe


def test_history_scan_prunes_and_pushes(spark, qs):
    txt = final_plan(qs["a2_history_ride_hour"](spark, SF_SMALL))
    scan = re.search(r"FileScan parquet .*?PushedFilters: \[([^\]]*)\], ReadSchema: struct<([^>]*)>", txt)
    assert scan and "IsNotNull(l_quantity)" in scan.group(1)
    assert len(scan.group(2).split(",")) <= 4                        # 4 of the 16 lineitem columns


def test_one_row_statistics_are_a_reused_scalar_subquery(spark, qs):
    txt = final_plan(qs["p6_quantile_trim"](spark, SF_SMALL))
    assert "Subquery" in txt and "ReusedSubquery" in txt
