"""All named queries with the SQL that gives the same rows."""

from __future__ import annotations

from kinelake.plans import document_plans, feature_plans, frame_plans, run_plans  # noqa: F401  (they register their queries)
from kinelake.plans.tables import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
