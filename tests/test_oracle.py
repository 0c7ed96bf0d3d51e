"""Every registered query against its SQL restatement on DuckDB (sf0.001)."""

import math
from collections import Counter

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from isobar.plans import catalog

E.queries()  # loads the catalog
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in catalog.ORACLE}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _bag(df.columns, rows) == _bag(ocols, orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["run", "step", "iy", "ix", "pet_pm"]
    assert df.count() == 183


SURVEY_IDS = (
    [f"S{i}_" for i in range(1, 10)] + [f"P{i}_" for i in range(1, 15)] + [f"J{i}_" for i in range(1, 11)]
    + [f"A{i}_" for i in range(1, 12)] + [f"W{i}_" for i in range(1, 5)] + [f"T{i}_" for i in range(1, 4)]
    + [f"U{i}_" for i in range(1, 5)] + ["D1_", "R1_"])


def test_every_survey_operator_is_registered():
    missing = [i for i in SURVEY_IDS if not any(k.startswith(i) for k in QUERIES)]
    assert missing == []
    unknown = [k for k in QUERIES if not any(k.startswith(i) for i in [*SURVEY_IDS, "flow_"])]
    assert unknown == []
