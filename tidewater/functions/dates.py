"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import ColumnOrName, _c

END_OF_TIME = "9999-12-31"   # fixed value: open-ended validity sentinel


def end_of_time() -> Column:
    return F.lit(END_OF_TIME).cast("date")


def date_key(c: ColumnOrName) -> Column:
    """yyyymmdd as INT."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_parts(c: ColumnOrName) -> dict[str, Column]:
    """Calendar columns: day_of_week is 1=Sunday .. 7=Saturday."""
    d = _c(c)
    return {
        "date_key": date_key(d),
        "day": F.dayofmonth(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
    }
