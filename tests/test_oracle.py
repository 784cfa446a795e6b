"""Every registered job against its DuckDB oracle (values, names, types)."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from parcelgrid.catalog import load_all
from tools.check_oracle import duck_con, norm_rows, type_diffs

QUERIES, ORACLE = load_all()


@pytest.fixture(scope="module")
def con():
    return duck_con(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_job_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert norm_rows(df.columns, rows) == norm_rows(dcols, drows)
    assert type_diffs(df.dtypes, res) == []


def test_every_job_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 71


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["uprn", "address", "asset_rating_band", "floor_area", "property_type",
                          "local_authority", "company_name", "company_number", "company_status"]
