"""The corpus queries are registered, and those with SQL equal it."""

import pytest
from helpers import SF

import __spark_entry__ as E
from parcelgrid.llm.catalog import ORACLE, QUERIES
from tools.check_oracle import duck_con, norm_rows, type_diffs


def test_every_operator_has_a_query():
    names = E.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    res = duck_con(SF).execute(ORACLE[name])
    want = norm_rows([d[0] for d in res.description], res.fetchall())
    assert norm_rows(df.columns, [tuple(r) for r in df.collect()]) == want
    assert type_diffs(df.dtypes, res) == []
