"""Every registered query of the subpackage against its SQL."""

import pytest

from checks.compare import canonical, duck
from funnelwise.llm.oracles import ORACLES
from funnelwise.llm.queries import QUERIES

from .conftest import SF_DIR


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    df = QUERIES[key](spark, SF_DIR)
    want = duck(SF_DIR).execute(ORACLES[key])
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical([c[0] for c in want.description], want.fetchall())
