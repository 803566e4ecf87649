"""Every training-data query that SQL can express, against its SQL."""

import pytest
from compare import SF_DIR, assert_same

from vecloom.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), ORACLE[name])
