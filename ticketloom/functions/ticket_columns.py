"""Column expressions of the cleaned ticket and its risk features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
RESOLVED_AT_PATTERN = "M/d/yy H:mm"
HIGH_PRIORITIES = ("Critical", "High")


def resolved_date(resolved_at: Column) -> Column:
    """The resolution day. Text that does not match the pattern gives null, not
    an error, so one bad cell cannot stop a load."""
    return F.to_date(F.try_to_timestamp(resolved_at, F.lit(RESOLVED_AT_PATTERN)))


def clean_hours(resolved_at: Column, resolution_hours: Column) -> Column:
    """Hours of a resolved ticket; null while the ticket is open."""
    return F.when(resolved_at.isNotNull(), resolution_hours)


def day_of_week(created_at: Column) -> Column:
    """Short English day name: Mon, Tue, ..."""
    return F.dayname(created_at)


def is_high_priority(priority: Column) -> Column:
    return F.coalesce(priority.isin(*HIGH_PRIORITIES), F.lit(False))


def is_long_resolution(hours: Column, sla_hours: Column) -> Column:
    """Strictly over the allowance; false when either side is unknown."""
    return F.coalesce(hours > sla_hours, F.lit(False))
