"""Date parsing and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.numbers import clip

_DAY_FIRST = r"(?U)^\s*([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\s*$"
_ISO = r"(?U)^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"


def parse_date(c: Column) -> Column:
    """Read ``dd/MM/yyyy`` and ``yyyy-MM-dd`` dates; anything else is null.

    The two spellings are told apart by shape, never by row order, so the
    result does not depend on partitioning. A day-first date is turned round
    and both go through the same native cast; words for "missing" fit neither.
    """
    turned = F.regexp_replace(c.cast("string"), _DAY_FIRST, "$3-$2-$1")
    return F.when(turned.rlike(_ISO), turned.try_cast("date"))


def days_between(start: Column, end: Column, low: int = 0, high: int = 60) -> Column:
    """Whole days from start to end, limited to [low, high]."""
    return clip(F.datediff(end, start), low, high)


def calendar_parts(c: Column) -> dict[str, Column]:
    """Month, weekday (Monday = 0) and quarter as doubles."""
    day = c.cast("date")
    return {
        "month": F.month(day).cast("double"),
        "weekday": F.weekday(day).cast("double"),
        "quarter": F.quarter(day).cast("double"),
    }
