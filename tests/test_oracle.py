"""Every query of the base library that SQL can express gives the rows that DuckDB gives."""

import math

import pytest

from cellwright import plans

from .conftest import DATA


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return repr(v + 0.0) if isinstance(v, float) else str(v)


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_value(r[k]) for k in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_same_rows(spark, duck, name):
    df = plans.QUERIES[name](spark, DATA)
    got = duck.execute(plans.ORACLES[name])
    columns, want = [d[0] for d in got.description], got.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, want)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_runs(spark, name):
    assert plans.QUERIES[name](spark, DATA).count() > 0
