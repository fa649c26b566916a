
import pytest

import __spark_entry__ as E
from conftest import SF01
from riskspark.plans import catalog

KEYS = sorted(catalog.query_callables())


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(spark, key):
    lines = E.queries()[key](spark, SF01)._jdf.queryExecution().executedPlan().toString().splitlines()
    text = "\n".join(lines)
    # no pairs: no cartesian products or nested-loop joins
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, text
    # a single-partition exchange only ever carries aggregated rows (global aggregates,
    # per-segment totals), never fact rows
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1], text


def test_scans_are_pruned(spark):
    text = E.queries()["q18_date_range_scan"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in text
