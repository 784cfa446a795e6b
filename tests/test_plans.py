"""Plan shape: no cartesian products, no row-at-a-time Python, pruned scans."""

import pytest

from conftest import SF_SMALL

from parcelgrid.catalog import load_all

QUERIES = load_all()[0]
PY_UDF_JOBS = {"best_match_difflib", "link_titles_difflib", "comps_all_difflib"}
SIDE_EFFECT_JOBS = {"stream_merge"}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECT_JOBS))
def test_no_cartesian_and_no_row_python(spark, name):
    p = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p
    if name not in PY_UDF_JOBS:
        assert "ArrowEvalPython" not in p


def test_distress_driving_scan_is_pruned(spark):
    from parcelgrid import fixtures as fx
    from parcelgrid.plans.distress import distressed_certificates
    from parcelgrid.sources.tables import Lake
    lake = Lake(spark, SF_SMALL)
    df = distressed_certificates(fx.epc_assessments(lake), fx.master_properties(lake))
    text = df.select("uprn", "floor_area").orderBy("floor_area").limit(50)._jdf.queryExecution().executedPlan().toString()
    assert "p_retailprice" in text and "p_comment" not in text and "p_brand" not in text
    assert "TakeOrderedAndProject" in text


def test_distress_scan_reads_base_tables_once(spark):
    """The k-row cut is materialised, so the final plan holds no base scan
    of the certificate side, only the owner tables it filters."""
    df = QUERIES["distress_scan"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in text or "ExistingRDD" in text
    assert "part.parquet" not in text
