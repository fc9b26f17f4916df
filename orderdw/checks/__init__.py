"""Every operator as a query over the test tables, for comparison with a second engine."""

from orderdw.checks import jobs, relational, rules, scalar  # noqa: F401  (they register their queries)
from orderdw.checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
