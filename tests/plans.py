"""What a query did: rows its scans returned, and its physical plan."""

from __future__ import annotations

from contextlib import contextmanager


@contextmanager
def static_plans(spark):
    """Without adaptive execution, so that a frame's plan is the one that runs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def collect_and_count(df) -> tuple[list, int]:
    """A frame's rows and how many its file scans returned for them; the frame must not have run before. Use within `static_plans`."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return rows, sum(s.metrics().get("numOutputRows").get().value() for s in scans if s.nodeName().startswith("Scan"))


def nodes_above(plan: str, marker: str) -> list[str]:
    """The plan's lines from the root down to the line that has `marker`, by indentation."""
    path: list[tuple[int, str]] = []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        path = [(d, text) for d, text in path if d < depth]
        if marker in line:
            return [text for _, text in path]
        path.append((depth, line))
    raise AssertionError(f"no {marker} in the plan")
