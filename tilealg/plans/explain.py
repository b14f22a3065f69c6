"""Plan inspection helpers: the physical operators a DataFrame's plan contains.

Used by the tests to guard performance properties (no cartesian products, no
row-at-a-time Python UDFs, broadcasts where intended, exchange reuse).
"""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import DataFrame

# Physical operators that must never appear in a tilealg plan.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")

_NODE = re.compile(r"^[\s:+\-|*()0-9]*([A-Z][A-Za-z]+)")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The physical plan as printed by ``df.explain`` (final plan once ``df`` ran)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def operators(df: DataFrame) -> Counter:
    """Count of each physical operator name in the plan."""
    counts: Counter = Counter()
    for line in plan_text(df).splitlines():
        m = _NODE.match(line)
        if m:
            counts[m.group(1)] += 1
    return counts


def forbidden(df: DataFrame) -> list[str]:
    ops = operators(df)
    return [op for op in FORBIDDEN if ops.get(op)]
