import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketpulse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="4g")


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def values(df, *columns):
    """The rows as sorted tuples, timestamps as text so that no local zone shows."""
    picked = df.select(*(columns or df.columns))
    texts = [
        f"CAST(`{f.name}` AS STRING) AS `{f.name}`"
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz", "date") else f"`{f.name}`"
        for f in picked.schema
    ]
    return sorted((tuple(r) for r in picked.selectExpr(*texts).collect()), key=repr)


def folders_read(df):
    """Folders that the scan of a query has opened, from the metrics of its run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    plans, found = [text], []
    while plans:
        node = plans.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plans.append(node.executedPlan())
        metrics = node.metrics()
        if metrics.contains("numPartitions") and "Scan" in node.getClass().getSimpleName():
            found.append(metrics.apply("numPartitions").value())
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            plans.append(node.plan())
        children = node.children()
        plans += [children.apply(i) for i in range(children.size())]
    return sum(found)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
