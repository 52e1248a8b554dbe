"""Every registered query against its check SQL on the smallest test tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import inheritable_thread_target

from checks import oracle, registry
from tests.conftest import SMALL
from tests.helpers import frame_rows, rows_of

QUERIES = registry.all_queries()


@pytest.fixture(scope="module")
def results(spark, request):
    """The asked-for queries, a few at a time; one alone leaves most of the machine idle."""
    names = [item.callspec.params["name"] for item in request.session.items if "results" in item.fixturenames]
    registry.context(spark, SMALL).path  # loaded once, before the threads ask for it

    @inheritable_thread_target(spark)
    def run(name):
        df = QUERIES[name](spark, SMALL)
        return df.columns, frame_rows(df)

    with ThreadPoolExecutor(4) as pool:
        yield {name: pool.submit(run, name) for name in names}


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(oracle.ALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(results, duck, name):
    columns, rows = results.pop(name).result()
    expected = duck.sql(oracle.ALL[name])
    assert sorted(columns) == sorted(expected.columns)
    assert rows == rows_of(expected.columns, expected.fetchall())
