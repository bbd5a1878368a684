"""Every registered query of the library against its SQL, on the whole smallest sample."""

import pytest

import __spark_entry__ as entry
from newstape.checks import registry
from newstape.checks.compare import compare, duck
from newstape.schemas import FEATURE_COLUMNS

REGISTRY = registry()


@pytest.fixture(scope="module")
def con(sample):
    return duck(sample)


def test_every_query_is_registered_with_its_sql():
    assert set(REGISTRY) <= set(entry.queries())
    assert all(text for _, text in REGISTRY.values())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_equals_sql(spark, sample, con, name):
    build, text = REGISTRY[name]
    assert compare(build(spark, sample), con, text) == ""


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == FEATURE_COLUMNS and not out.isEmpty()
