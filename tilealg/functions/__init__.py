"""Column expressions (JVM-side) and numpy tile kernels (Arrow tasks)."""

from .exprs import ieee_div, uniform01  # noqa: F401
