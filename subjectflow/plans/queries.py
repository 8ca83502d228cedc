"""All registered queries."""

from subjectflow.plans import event_queries, more_queries, quality_queries, report_queries, subject_queries  # noqa: F401
from subjectflow.plans.registry import QUERIES, SQL

FLAGSHIP = "km_curve"

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]
