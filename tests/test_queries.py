"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.oracle import compare
from tidemark.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, duck):
    assert not compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name])
