"""All registered queries."""

from postmill.plans import q_captures, q_functions, q_reconcile, q_reports, q_shapes
from postmill.plans.registry import QUERIES, Inputs

__all__ = ["QUERIES", "Inputs", "q_captures", "q_functions", "q_reconcile", "q_reports", "q_shapes"]
