"""Date parsing with one fixed day format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the day format of the source files.
DAY_FORMAT = "yyyy-MM-dd"


def parse_day(c: Column) -> Column:
    """Text to ``date``; unparseable (e.g. month 13) or NULL gives NULL."""
    return F.try_to_timestamp(c, F.lit(DAY_FORMAT)).cast("date")


def parse_day_strict(c: Column, what: str) -> Column:
    """Text to ``date``; a non-NULL value that does not parse fails the job."""
    parsed = parse_day(c)
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"unparseable date in {what}: "), c))
                  ).otherwise(parsed)
