from __future__ import annotations

from pyspark.sql import Column, functions as F

from streakflow.config import STREAK_BUCKET_ELSE, STREAK_BUCKETS


def streak_bucket(streak: Column | str) -> Column:
    """Bucket label of the streak distribution view; a null streak falls
    into the last bucket, as in the view's CASE."""
    s = F.col(streak) if isinstance(streak, str) else streak
    expr = None
    for label, low, high in STREAK_BUCKETS:
        cond = (s == low) if low == high else s.between(low, high)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(STREAK_BUCKET_ELSE))
