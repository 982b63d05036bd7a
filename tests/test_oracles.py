"""Every registered query of the library against its SQL."""

import pytest

from tallyguard.plans import registry
from tests.helpers import oracle, same


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, name):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    if name in registry.ORACLES:
        same(got, oracle(sf_dir, registry.ORACLES[name]))
    else:
        assert len(got)
