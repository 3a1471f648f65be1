from __future__ import annotations

import zoneinfo
from functools import lru_cache

from pyspark.sql import Column, functions as F

# IANA names the Python zone database accepts but the JVM does
# not resolve, mapped to the zone they stand for.
JVM_ALIASES = {"ROC": "Asia/Taipei", "Factory": "UTC", "localtime": "UTC"}


@lru_cache(maxsize=1)
def valid_zones() -> tuple[str, ...]:
    """The zone names an event may carry: the IANA database shipped with
    Python (about 600 names, a bounded literal set)."""
    return tuple(sorted(zoneinfo.available_timezones()))


def is_valid_zone(zone: Column | str) -> Column:
    z = F.col(zone) if isinstance(zone, str) else zone
    return z.isNotNull() & z.isin(list(valid_zones()))


def safe_zone(zone: Column | str) -> Column:
    """B4 guard: a zone that conversion functions accept; invalid -> 'UTC'.
    The conversion never sees an unknown name, so it cannot raise."""
    z = F.col(zone) if isinstance(zone, str) else zone
    aliased = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in JVM_ALIASES.items() for x in kv]), z), z)
    return F.when(is_valid_zone(z), aliased).otherwise(F.lit("UTC"))


def zone_table(spark):
    """The valid zone names with the name the JVM resolves (a fixed,
    bounded table of about 600 rows: safe to broadcast)."""
    rows = [(z, JVM_ALIASES.get(z, z)) for z in valid_zones()]
    return spark.createDataFrame(rows, "zone_name string, jvm_zone string")
