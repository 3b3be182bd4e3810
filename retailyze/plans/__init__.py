"""Query plans: fixtures over the driver tables and the registered queries."""

from . import q_clean, q_odd, q_orders, q_profile, q_sales, q_shape, q_stream  # noqa: F401  (registers queries)
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
