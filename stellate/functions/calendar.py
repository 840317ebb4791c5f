"""Calendar dimension attributes as Spark column expressions.

Every attribute is a built-in expression of the date, so a calendar of any
length is computed inside whole-stage codegen on the executors; no per-day
driver loop, no UDF.

Week rules follow the US convention: weeks start on Sunday and week 1 is the
week holding the 1st (of the month, or of January). Spark's ``weekofyear`` is
ISO-8601 (Monday start, 4-day first week) and is deliberately not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The calendar's output columns, in table order.
CALENDAR_COLUMNS = (
    "date_key",
    "date",
    "day",
    "day_suffix",
    "week_day",
    "week_day_name",
    "week_day_name_short",
    "week_day_name_first_letter",
    "day_of_year",
    "week_of_month",
    "week_of_year",
    "month",
    "month_name",
    "month_name_short",
    "month_name_first_letter",
    "quarter",
    "quarter_name",
    "year",
    "yyyymm",
    "month_year",
    "is_weekend",
    "is_holiday",
    "first_date_of_year",
    "last_date_of_year",
    "first_date_of_quarter",
    "last_date_of_quarter",
    "first_date_of_month",
    "last_date_of_month",
    "first_date_of_week",
    "last_date_of_week",
    "last_12_month_flag",
    "last_6_month_flag",
    "last_month_flag",
    "load_date",
)


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def date_key(d: Column) -> Column:
    """yyyyMMdd as an int (arithmetic, no string round trip)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_suffix(d: Column) -> Column:
    """English ordinal suffix of the day of month: 1st 2nd 3rd 4th .. 21st 22nd 23rd .. 31st."""
    day = F.dayofmonth(d)
    return (
        F.when(day.isin(1, 21, 31), F.lit("st"))
        .when(day.isin(2, 22), F.lit("nd"))
        .when(day.isin(3, 23), F.lit("rd"))
        .otherwise(F.lit("th"))
    )


def week_day(d: Column) -> Column:
    """Day of week with Sunday = 1 .. Saturday = 7."""
    return F.dayofweek(d)


def week_of_month(d: Column) -> Column:
    """Sunday-start week of the month; the week holding the 1st is week 1."""
    first = F.trunc(d, "MM")
    return (F.floor((F.dayofmonth(d) + F.dayofweek(first) - 2) / 7) + 1).cast("int")


def first_date_of_week(d: Column) -> Column:
    """The Sunday on or before ``d``."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def last_date_of_week(d: Column) -> Column:
    """The Saturday on or after ``d``."""
    return F.date_add(d, 7 - F.dayofweek(d))


def week_of_year(d: Column) -> Column:
    """Sunday-start week of the week-based year, week 1 holding January 1st.

    The last days of December belong to week 1 of the next year when their
    week's Saturday already lies in January.
    """
    next_new_year = F.make_date(F.year(d) + 1, F.lit(1), F.lit(1))
    in_year = F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "YEAR")) - 2) / 7) + 1
    return F.when(last_date_of_week(d) >= next_new_year, F.lit(1)).otherwise(in_year).cast("int")


def month_index(d: Column) -> Column:
    """Months since year 0, so that month differences are a subtraction."""
    return F.year(d) * 12 + F.month(d)


def months_back(d: Column, as_of: Column) -> Column:
    """Whole calendar months from ``d``'s month back from ``as_of``'s month (0 = same month)."""
    return month_index(as_of) - month_index(d)


def calendar_columns(d: Column, as_of: Column, load_ts: Column) -> list[Column]:
    """The 34 calendar attributes of date column ``d``, in table order.

    ``as_of`` is the run date the rolling flags are relative to (the running
    month is not counted: last month is 1 month back); ``load_ts`` fills
    ``load_date``.
    """
    e_short = F.date_format(d, "E")
    m_short = F.date_format(d, "MMM")
    back = months_back(d, as_of)
    first_q = F.trunc(d, "QUARTER")
    return [
        date_key(d).alias("date_key"),
        d.cast("date").alias("date"),
        F.dayofmonth(d).alias("day"),
        day_suffix(d).alias("day_suffix"),
        week_day(d).alias("week_day"),
        F.date_format(d, "EEEE").alias("week_day_name"),
        F.upper(e_short).alias("week_day_name_short"),
        F.substring(e_short, 1, 1).alias("week_day_name_first_letter"),
        F.dayofyear(d).alias("day_of_year"),
        week_of_month(d).alias("week_of_month"),
        week_of_year(d).alias("week_of_year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.upper(m_short).alias("month_name_short"),
        F.substring(m_short, 1, 1).alias("month_name_first_letter"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.year(d).alias("year"),
        F.date_format(d, "yyyyMM").alias("yyyymm"),
        F.upper(F.date_format(d, "yyyy MMM")).alias("month_year"),
        _flag(F.dayofweek(d).isin(1, 7)).alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
        F.trunc(d, "YEAR").alias("first_date_of_year"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("last_date_of_year"),
        first_q.alias("first_date_of_quarter"),
        F.last_day(F.add_months(first_q, 2)).alias("last_date_of_quarter"),
        F.trunc(d, "MM").alias("first_date_of_month"),
        F.last_day(d).alias("last_date_of_month"),
        first_date_of_week(d).alias("first_date_of_week"),
        last_date_of_week(d).alias("last_date_of_week"),
        _flag(back.between(1, 12)).alias("last_12_month_flag"),
        _flag(back.between(1, 6)).alias("last_6_month_flag"),
        _flag(back == 1).alias("last_month_flag"),
        load_ts.alias("load_date"),
    ]


def with_calendar_columns(
    df: DataFrame,
    date_col: str,
    as_of: Column | None = None,
    load_ts: Column | None = None,
) -> DataFrame:
    """Project ``df``'s date column into the calendar table.

    ``as_of`` defaults to ``current_date()`` and ``load_ts`` to
    ``current_timestamp()``; pass them to get a reproducible table.
    """
    as_of = F.current_date() if as_of is None else as_of
    load_ts = F.current_timestamp() if load_ts is None else load_ts
    return df.select(*calendar_columns(F.col(date_col), as_of, load_ts))


def calendar_end(as_of: Column, months_ahead: int) -> Column:
    """Exclusive end of the calendar: last day of the month ``months_ahead`` after ``as_of``."""
    return F.last_day(F.add_months(as_of, months_ahead))


def reformat_date(s: Column, in_pattern: str, out_pattern: str) -> Column:
    """Re-format a date string from one pattern to another.

    Spark's formatter refuses the localized week patterns (e, w, W, u, Y);
    use ``week_day``, ``week_of_month``, ``week_of_year`` and ``F.year``.
    """
    return F.date_format(F.to_date(s, in_pattern), out_pattern)
