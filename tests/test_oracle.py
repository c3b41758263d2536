"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry
from inputs import SMALL
from popdist.plans.queries import REGISTRY

#: the core queries; the optional subpackage tests its own
QUERIES = REGISTRY
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in REGISTRY}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 12)
    if hasattr(v, "item"):
        return norm(v.item())
    return v if isinstance(v, (int, str, bool)) else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(cols, rows) == canon(ocols, orows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["medication_ingredient_name", "age", "gender", "state", "weighted", "total", "percent"]
    assert df.count() > 0
