"""Reading an adapter's last message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.periods import is_recent


def looks_like_no_data(message: Column) -> Column:
    """"Checked, nothing published": a period and a no-word, and no sign of a real failure."""
    m = F.coalesce(message, F.lit(""))
    return (
        m.rlike(fv.PERIOD_IN_MESSAGE_PATTERN) & m.rlike(fv.NO_DATA_PATTERN) & ~m.rlike(fv.SITE_CHANGED_PATTERN)
        & ~m.rlike(fv.HTTP_ERROR_PATTERN) & ~m.rlike(fv.INVALID_FILE_PATTERN)
    )


def classify_failure(message: Column) -> Column:
    m = F.coalesce(message, F.lit(""))
    return (
        F.when(m.rlike(fv.SITE_CHANGED_PATTERN), "SITE_CHANGED").when(m.rlike(fv.INVALID_FILE_PATTERN), "INVALID_FILE")
        .when(m.rlike(fv.HTTP_ERROR_PATTERN), "HTTP_ERROR").when(m.rlike(fv.DISCOVERY_FAILED_PATTERN), "DISCOVERY_FAILED")
        .otherwise("UNKNOWN_ERROR")
    )


def classify_unavailable(period: Column, today: Column, lag_months: int) -> Column:
    return F.when(is_recent(period, today, lag_months), "NOT_YET_PUBLISHED").otherwise("NO_DATA")
