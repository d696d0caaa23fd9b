"""Plan shape of every catalogue query: no cross products, no nested-loop
joins, and scans read only the columns they need."""

import pytest

import __spark_entry__ as E
from islet.plans.catalogue import ROWS_ONLY
from tests.conftest import SF

NAMES = sorted(k for k in E.queries() if k not in ROWS_ONLY)


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_product(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"video_id", "total_hours", "hours_creation", "creation_day_span"} <= set(df.columns)


def test_event_scan_is_pruned(spark):
    df = E.queries()["entity_rollup"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan  # the unused JSON column is never read


BOUNDED = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject",
           "GlobalLimit", "LocalLimit", "CollectLimit")


def _children(node):
    if node.nodeName() == "AdaptiveSparkPlan":
        return [node.initialPlan()]
    ch = node.children()
    return [ch.apply(i) for i in range(ch.size())]


def _bounded_below(node):
    """True when an aggregate / limit sits between this exchange and the
    next exchange or leaf (so what it gathers is bounded)."""
    for c in _children(node):
        name = c.nodeName()
        if any(name.startswith(b) for b in BOUNDED):
            return True
        if "Exchange" in name or not _children(c):
            return False
        if not _bounded_below(c):
            return False
    return True


def _single_partition_exchanges(node, out):
    if node.nodeName() == "Exchange" and "SinglePartition" in node.toString().split("\n")[0]:
        out.append(node)
    for c in _children(node):
        _single_partition_exchanges(c, out)
    return out


@pytest.mark.parametrize("name", NAMES)
def test_single_partition_only_over_bounded_data(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan()
    bad = [n.toString().split("\n")[0] for n in _single_partition_exchanges(plan, []) if not _bounded_below(n)]
    assert not bad, bad
