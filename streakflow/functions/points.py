from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from streakflow.config import POINTS_MAP


def points_map_column(points: dict[str, int] | None = None) -> Column:
    """Literal ``map<string,int>`` of event type to points."""
    points = points or POINTS_MAP
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in points.items()))


def award_points(event_type: Column | str, points: dict[str, int] | None = None) -> Column:
    """Points for an event type; null for a type outside the map."""
    col = F.col(event_type) if isinstance(event_type, str) else event_type
    return F.try_element_at(points_map_column(points), col).cast("int")
