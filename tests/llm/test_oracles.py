"""The SQL forms, on the small tables; and the queries' registration."""

import re
from collections import Counter

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from isobar.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = duck.execute(queries.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(want.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    found = E.queries()
    assert {int(m[1]) for k in found if (m := re.match(r"op(\d+)_", k))} == set(range(1, 14))
    assert "pipeline" in found
