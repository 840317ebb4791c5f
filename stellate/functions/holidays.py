"""Public holidays as column expressions: fixed dates and feasts that move with Easter.

Easter Sunday of a year follows from integer arithmetic alone (the Gregorian
computus), so the holidays of any span of years are generated on the executors
from the years, a few rows each, and joined to the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# National holidays of the marketplace's country, as (month, day, name).
FIXED_HOLIDAYS = (
    (1, 1, "New Year"),
    (4, 21, "Tiradentes"),
    (5, 1, "Labour Day"),
    (9, 7, "Independence Day"),
    (10, 12, "Our Lady of Aparecida"),
    (11, 2, "All Souls"),
    (11, 15, "Republic Day"),
    (12, 25, "Christmas"),
)
# Feasts as (days after Easter Sunday, name).
EASTER_HOLIDAYS = (
    (-48, "Carnival Monday"),
    (-47, "Carnival Tuesday"),
    (-2, "Good Friday"),
    (0, "Easter Sunday"),
    (60, "Corpus Christi"),
)


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def easter(year: Column) -> Column:
    """Easter Sunday of a (Gregorian) year."""
    golden = year % 19
    century = _div(year, 100)
    # the moon's age on the equinox, corrected for skipped leap days and for the lunar drift
    epact = (century - _div(century, 4) - _div(8 * century + 13, 25) + 19 * golden + 15) % 30
    moon = epact - _div(epact, 28) * (1 - _div(epact, 28) * F.floor(F.lit(29) / (epact + 1)).cast("int") * _div(21 - golden, 11))
    weekday = (year + _div(year, 4) + moon + 2 - century + _div(century, 4)) % 7
    after = moon - weekday  # days from March 28th to Easter
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), after.cast("int"))


def holidays_of(years: DataFrame, year: str = "year") -> DataFrame:
    """(date, holiday_name): one row a date that is a holiday, names that meet joined in their order."""
    y = F.col(year).cast("int")
    fixed = [F.struct(F.make_date(y, F.lit(m), F.lit(d)).alias("date"), F.lit(n).alias("name")) for m, d, n in FIXED_HOLIDAYS]
    moving = [F.struct(F.date_add(easter(y), off).alias("date"), F.lit(n).alias("name")) for off, n in EASTER_HOLIDAYS]
    each = years.select(y.alias(year)).where(y.isNotNull()).distinct().select(F.explode(F.array(*fixed, *moving)).alias("h"))
    names = F.array_join(F.sort_array(F.collect_list("name")), ", ")
    return each.select("h.*").groupBy("date").agg(names.alias("holiday_name"))


def mark_holidays(calendar: DataFrame) -> DataFrame:
    """The calendar with ``is_holiday`` set and ``holiday_name`` added."""
    # a dozen rows for each year of the calendar
    days = holidays_of(calendar.select("year")).select(F.col("date").alias("_date"), "holiday_name")
    marked = calendar.join(F.broadcast(days), F.col("date") == F.col("_date"), "left").drop("_date")
    return marked.withColumn("is_holiday", F.col("holiday_name").isNotNull().cast("int"))
