"""Column expressions: calendar attributes and surrogate keys."""

from stellate.functions.calendar import (
    CALENDAR_COLUMNS,
    calendar_columns,
    calendar_end,
    date_key,
    day_suffix,
    first_date_of_week,
    last_date_of_week,
    months_back,
    reformat_date,
    week_day,
    week_of_month,
    week_of_year,
    with_calendar_columns,
)
from stellate.functions.keys import dense_key, hash_key

__all__ = [
    "CALENDAR_COLUMNS",
    "calendar_columns",
    "calendar_end",
    "date_key",
    "day_suffix",
    "dense_key",
    "first_date_of_week",
    "hash_key",
    "last_date_of_week",
    "months_back",
    "reformat_date",
    "week_day",
    "week_of_month",
    "week_of_year",
    "with_calendar_columns",
]
