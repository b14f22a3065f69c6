"""Query catalogue: base matrices derived from the test tables and one named query per
operator, each paired with DuckDB SQL that computes the same result."""

from .catalogue import OPERATORS, oracle_sql, queries  # noqa: F401
