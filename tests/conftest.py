import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kilowatt.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, app="kilowatt-tests")
    yield s


def rows(df, *order):
    """Collected rows as dicts, ordered by ``order`` columns."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda d: tuple((d[c] is None, d[c]) for c in order))
    return out


def shuffle_records(df) -> list[int]:
    """Records written by each shuffle exchange of ``df``'s last execution
    (walks the final adaptive plan through its query stages)."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    out = []

    def walk(node):
        name = node.nodeName()
        m = node.metrics()
        if name == "Exchange" and m.contains("shuffleRecordsWritten"):
            out.append(int(m.apply("shuffleRecordsWritten").value()))
        if "QueryStage" in name:
            walk(node.plan())
        ch = node.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(plan)
    return out
