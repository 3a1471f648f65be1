"""streakflow: engagement analytics (events, points, streaks) as Spark DataFrame operators."""
from streakflow.config import DEFAULT_LIMITS, Limits, configure, local_session

__all__ = ["DEFAULT_LIMITS", "Limits", "configure", "local_session"]
