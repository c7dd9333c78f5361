"""Every registered query of the engine against its SQL."""

import pytest

from brightwater.plans import catalog
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_rows_as_sql(spark, name):
    assert oracle.differences(catalog.QUERIES[name](spark, SF), catalog.ORACLE_SQL[name], SF) == ""


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
