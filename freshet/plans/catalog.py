"""All plans by name."""

from freshet.plans import changes, records, sql, tables, telemetry  # noqa: F401
from freshet.plans.base import PLANS, Plan

__all__ = ["PLANS", "Plan"]
