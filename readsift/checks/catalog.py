"""All registered queries."""

from readsift.checks import file_queries, read_queries, report_queries, search_queries  # noqa: F401
from readsift.checks.registry import ORACLES, QUERIES  # noqa: F401
