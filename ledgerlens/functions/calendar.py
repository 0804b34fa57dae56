"""Date expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole days inside the range of 64-bit nanosecond timestamps; other dates load as NULL.
EARLIEST_DAY = date(1677, 9, 22)
LATEST_DAY = date(2262, 4, 11)


def month_start(day: Column) -> Column:
    """First day of the month, as a DATE (date_trunc would give a timestamp)."""
    return F.trunc(day, "MONTH")


def lenient_date(text: Column) -> Column:
    """Year-month-day text to DATE; one-digit months and days are fine, anything else becomes NULL."""
    well_formed = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z")
    day = F.when(well_formed, text).try_cast("date")  # a cast parses faster than a date pattern
    return F.when(day.between(F.lit(EARLIEST_DAY), F.lit(LATEST_DAY)), day)
