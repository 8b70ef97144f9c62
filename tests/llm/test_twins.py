"""Queries with a SQL form against it."""

import pytest
from checking import connect, differences

from ferrytab.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(session, sf_dir, name):
    assert differences(QUERIES[name](session, sf_dir), connect(sf_dir), ORACLE[name]) == []
