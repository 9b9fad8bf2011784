"""Named queries over the driver tables: Spark builders plus DuckDB oracle SQL."""

from crease.plans import history_q, profile_q, report_q, transform_q, bivar_q, eval_q, model_q, prep_q  # noqa: F401  (register queries)
from crease.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
