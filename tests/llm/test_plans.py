"""Plans of the queries of this subpackage: no products, no row-wise Python."""

import pytest

import __spark_entry__ as entry
from guestlens.llm import catalog


@pytest.mark.parametrize("name", [*sorted(catalog.queries()), "pipeline"])
def test_no_products_and_no_python_rows(spark, tiny, name):
    text = entry.queries()[name](spark, tiny)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "RDDScan" not in text.replace("Scan ExistingRDD", "")
