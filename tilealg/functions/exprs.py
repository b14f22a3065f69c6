"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**53: a 53-bit integer divided by it is a double uniform on [0, 1).
_TWO_53 = 9007199254740992.0


def ieee_div(x: Column, y: Column) -> Column:
    """IEEE-754 division: x/0 gives +-Inf and 0/0 NaN, as JVM doubles do.

    Under ANSI mode Spark raises ``DIVIDE_BY_ZERO`` for ``/``; ``try_divide`` returns NULL
    instead, and that NULL case is filled with ``x * y^-1`` (``pow(+-0, -1)`` is +-Inf).
    """
    return F.coalesce(F.try_divide(x, y), x * F.pow(y, F.lit(-1.0)))


def idiv(x: Column, n) -> Column:
    """Integer division of non-negative bigints (exact beyond 2^53, unlike ``/`` and floor)."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return F.call_function("div", x.cast("bigint"), n.cast("bigint"))


def uniform01(i: Column, j: Column, seed: int) -> Column:
    """Deterministic U[0,1) per cell from a 64-bit hash of ``(i, j, seed)``.

    Unlike ``F.rand`` the value depends only on the cell, never on partitioning, so a
    recomputed partition (lost executor, retile, repartition) yields the same numbers.
    """
    h = F.xxhash64(i.cast("bigint"), j.cast("bigint"), F.lit(int(seed)).cast("bigint"))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(_TWO_53)


def zeros_array(n: Column) -> Column:
    return F.array_repeat(F.lit(0.0), n)
