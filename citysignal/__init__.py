"""City-signal feeds to timed decisions and reports, on Spark."""

from citysignal.config import DEFAULT, DOCUMENTED, ScoringConfig
from citysignal.plans.decisions import decision_plan
from citysignal.session import build_session, configure

__all__ = [
    "DEFAULT",
    "DOCUMENTED",
    "ScoringConfig",
    "build_session",
    "configure",
    "decision_plan",
]
