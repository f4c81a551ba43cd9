"""Data-quality checks and publication of environmental measurement deliveries, on Spark."""

from tidegate.config import Settings
from tidegate.operators.references import References
from tidegate.plans.validate import Result, run_checks, validate
from tidegate.runtime import build_session

__all__ = ["References", "Result", "Settings", "build_session", "run_checks", "validate"]
