"""P5: the data behind the four charts (streak timeline, cumulative
points, streak distribution, quality funnel). Drawing is not ours."""
from __future__ import annotations

from pyspark.sql import DataFrame

from streakflow.operators import streaks, warehouse
from streakflow.plans import curate as curate_plan


def chart_tables(daily: DataFrame, curated_events: DataFrame, snapshot: DataFrame, raw: DataFrame,
                 dim: DataFrame) -> dict[str, DataFrame]:
    return {
        "streak_timeline": streaks.streak_timeline(daily),
        "points_timeline": streaks.points_timeline(curated_events),
        "streak_distribution": warehouse.streak_distribution(snapshot),
        "quality_funnel": curate_plan.quality_funnel(raw, dim),
    }
