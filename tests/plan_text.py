"""Text of physical plans."""

from __future__ import annotations


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan that ran, without the initial plans that are printed with it."""
    kept, skipped = [], None
    for line in plan_of(df).splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if skipped is not None and depth > skipped:
            continue
        skipped = depth if "== Initial Plan ==" in line else None
        if skipped is None:
            kept.append(line)
    return "\n".join(kept)
