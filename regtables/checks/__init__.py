"""The registered queries: each operator on the driver's tables, next to the SQL that gives its rows."""

from regtables.checks import conforming, datasets, dates_text, grids, groups, loads, pages, rules, sources, states  # noqa: F401
from regtables.checks.registry import CHECKS

__all__ = ["CHECKS"]
