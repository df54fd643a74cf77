"""Names of registered queries."""

from types import SimpleNamespace

import pytest

from leasegrid.plans import registry


def test_no_query_hides_another():
    assert len(registry.queries()) == sum(len(m.ALL) for m in registry.MODULES)
    assert {"q_x24_cascade", "q_x24_tier_cascade"} <= registry.oracle_sql().keys()
    one, two = (SimpleNamespace(__name__=n, ALL={"q": (None, None)}) for n in "ab")
    with pytest.raises(ValueError, match="b registers again: q"):
        registry.merged([one, two])
