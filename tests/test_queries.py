"""Every registered query against its SQL on the smallest tables."""

import pytest

from conftest import SF
from corpusweave.plans.registry import load_all
from tools import check_queries


@pytest.fixture(scope="module")
def duck():
    return check_queries.connect(SF)


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query(spark, duck, name):
    verdict = check_queries.compare(spark, duck, load_all()[name], SF)
    assert not verdict.startswith("FAIL"), verdict
