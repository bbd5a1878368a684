"""The registered queries of the subpackage against their SQL, on the whole smallest sample."""

import pytest

import __spark_entry__ as entry
from newstape.checks.compare import compare, duck
from newstape.llm.queries import QUERIES


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_equals_sql(spark, sample, name):
    assert compare(QUERIES[name][0](spark, sample), duck(sample), QUERIES[name][1]) == ""


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
