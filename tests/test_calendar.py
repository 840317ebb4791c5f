"""Calendar dimension: every column against an independent Python model."""

import calendar as pycal
import datetime as dt

import pytest
from pyspark.sql import functions as F

from stellate.functions import CALENDAR_COLUMNS, reformat_date
from stellate.plans import mart
from stellate.sources import date_spine

AS_OF = dt.date(2019, 12, 15)
LOAD = "2019-12-15 06:00:00"


def _add_months(d: dt.date, n: int) -> dt.date:
    m = d.month - 1 + n
    y, m = d.year + m // 12, m % 12 + 1
    return dt.date(y, m, min(d.day, pycal.monthrange(y, m)[1]))


def _sunday1(d: dt.date) -> int:
    return d.isoweekday() % 7 + 1


def _sundays_between(lo: dt.date, hi: dt.date) -> int:
    """Sundays x with lo < x <= hi."""
    return sum(1 for k in range(1, (hi - lo).days + 1) if (lo + dt.timedelta(k)).isoweekday() == 7)


def model(d: dt.date, as_of: dt.date) -> dict:
    """Brute-force US-calendar attributes of one day (no shared code with the library)."""
    wd = _sunday1(d)
    week_start = d - dt.timedelta(days=wd - 1)
    week_end = d + dt.timedelta(days=7 - wd)
    if week_end.year > d.year:
        woy = 1
    else:
        woy = 1 + _sundays_between(dt.date(d.year, 1, 1), d)
    q = (d.month - 1) // 3 + 1
    q_first = dt.date(d.year, 3 * q - 2, 1)
    q_last_month = 3 * q
    last12 = [_add_months(as_of, -i).strftime("%Y%m") for i in range(1, 13)]
    suffix = {1: "st", 21: "st", 31: "st", 2: "nd", 22: "nd", 3: "rd", 23: "rd"}.get(d.day, "th")
    return {
        "date_key": int(d.strftime("%Y%m%d")),
        "date": d,
        "day": d.day,
        "day_suffix": suffix,
        "week_day": wd,
        "week_day_name": d.strftime("%A"),
        "week_day_name_short": d.strftime("%a").upper(),
        "week_day_name_first_letter": d.strftime("%a")[0],
        "day_of_year": d.timetuple().tm_yday,
        "week_of_month": 1 + _sundays_between(d.replace(day=1), d),
        "week_of_year": woy,
        "month": d.month,
        "month_name": d.strftime("%B"),
        "month_name_short": d.strftime("%b").upper(),
        "month_name_first_letter": d.strftime("%b")[0],
        "quarter": q,
        "quarter_name": f"Q{q}",
        "year": d.year,
        "yyyymm": d.strftime("%Y%m"),
        "month_year": d.strftime("%Y %b").upper(),
        "is_weekend": 1 if wd in (1, 7) else 0,
        "is_holiday": 0,
        "first_date_of_year": dt.date(d.year, 1, 1),
        "last_date_of_year": dt.date(d.year, 12, 31),
        "first_date_of_quarter": q_first,
        "last_date_of_quarter": dt.date(d.year, q_last_month, pycal.monthrange(d.year, q_last_month)[1]),
        "first_date_of_month": d.replace(day=1),
        "last_date_of_month": d.replace(day=pycal.monthrange(d.year, d.month)[1]),
        "first_date_of_week": week_start,
        "last_date_of_week": week_end,
        "last_12_month_flag": int(d.strftime("%Y%m") in last12),
        "last_6_month_flag": int(d.strftime("%Y%m") in last12[:6]),
        "last_month_flag": int(d.strftime("%Y%m") == last12[0]),
    }


@pytest.fixture(scope="module")
def cal(spark):
    return mart.calendar_dim(spark, "2016-01-01", as_of=AS_OF.isoformat(), load_ts=LOAD)


@pytest.fixture(scope="module")
def cal_rows(cal):
    return {r["date"]: r.asDict() for r in cal.collect()}


def test_schema(cal):
    assert tuple(cal.columns) == CALENDAR_COLUMNS
    types = dict(cal.dtypes)
    for c in ("date_key", "day", "week_day", "day_of_year", "week_of_month", "week_of_year",
              "month", "quarter", "year", "is_weekend", "is_holiday", "last_12_month_flag",
              "last_6_month_flag", "last_month_flag"):
        assert types[c] == "int", c
    for c in CALENDAR_COLUMNS:
        if c == "date" or c.startswith(("first_date", "last_date")):
            assert types[c] == "date", c
    assert types["load_date"] == "timestamp"


def test_range_end_is_exclusive(cal_rows):
    # as_of + 60 months = 2024-12-15 -> last day 2024-12-31, left out
    assert min(cal_rows) == dt.date(2016, 1, 1)
    assert max(cal_rows) == dt.date(2024, 12, 30)
    assert len(cal_rows) == (dt.date(2024, 12, 31) - dt.date(2016, 1, 1)).days


def test_every_day_matches_model(cal_rows):
    bad = []
    for d, row in cal_rows.items():
        expect = model(d, AS_OF)
        for k, v in expect.items():
            if row[k] != v:
                bad.append((d, k, row[k], v))
    assert not bad, bad[:10]


def test_fixture_days(cal_rows):
    r = cal_rows[dt.date(2016, 1, 1)]
    assert (r["week_day"], r["week_of_month"], r["week_of_year"]) == (6, 1, 1)
    assert r["first_date_of_week"] == dt.date(2015, 12, 27)
    assert r["last_date_of_week"] == dt.date(2016, 1, 2)
    assert r["month_year"] == "2016 JAN"
    r = cal_rows[dt.date(2018, 12, 30)]
    assert (r["week_day"], r["day_of_year"], r["week_of_year"]) == (1, 364, 1)
    assert cal_rows[dt.date(2016, 2, 29)]["last_date_of_month"] == dt.date(2016, 2, 29)
    suffix = {d: cal_rows[dt.date(2016, 1, d)]["day_suffix"] for d in (1, 2, 3, 11, 12, 13, 21, 22, 23, 31)}
    assert list(suffix.values()) == ["st", "nd", "rd", "th", "th", "th", "st", "nd", "rd", "st"]


def test_rolling_flags(cal_rows):
    months12 = {r["yyyymm"] for r in cal_rows.values() if r["last_12_month_flag"]}
    months6 = {r["yyyymm"] for r in cal_rows.values() if r["last_6_month_flag"]}
    last = {r["yyyymm"] for r in cal_rows.values() if r["last_month_flag"]}
    assert months12 == {f"2018{12}"} | {f"2019{m:02d}" for m in range(1, 12)}
    assert months6 == {f"2019{m:02d}" for m in range(6, 12)}
    assert last == {"201911"}
    assert not cal_rows[AS_OF]["last_12_month_flag"]


def test_between_filter(cal):
    assert mart.calendar_between(cal, 20160101, 20191231).count() == 1461


def test_reversed_range_is_empty(spark):
    assert date_spine(spark, "2020-01-02", "2020-01-01").count() == 0
    assert mart.calendar_dim(spark, "2030-01-01", as_of="2019-12-15").count() == 0


def test_spine_inclusive(spark):
    days = [r["calendarDate"] for r in date_spine(spark, "2016-01-01", "2023-12-31").collect()]
    assert len(days) == len(set(days)) == 2922
    assert min(days) == dt.date(2016, 1, 1) and max(days) == dt.date(2023, 12, 31)
    # a range inside one month, and one crossing a year end
    mid = [r[0] for r in date_spine(spark, "2016-02-10", "2016-02-12").collect()]
    assert sorted(mid) == [dt.date(2016, 2, d) for d in (10, 11, 12)]
    assert date_spine(spark, "2015-12-30", "2016-01-02").count() == 4


def test_reformat_date(spark):
    df = spark.createDataFrame([("2016-01-31",)], "s string")
    assert df.select(reformat_date(F.col("s"), "yyyy-MM-dd", "yyyyMMdd")).first()[0] == "20160131"


def test_data_sized_calendar(spark):
    from data_dirs import SMALL
    from stellate.sources import Marketplace

    mp = Marketplace.from_driver(spark, SMALL)
    cal = mart.calendar_for(mp.orders, "order_purchase_timestamp")
    first, last, as_of_flag = cal.agg(
        F.min("date"), F.max("date"), F.max(F.when(F.col("last_month_flag") == 1, F.col("yyyymm")))
    ).first()
    lo, hi = mp.orders.agg(F.min("order_purchase_timestamp"), F.max("order_purchase_timestamp")).first()
    assert first == dt.date(lo.year, 1, 1)
    end = _add_months(hi.date(), 60)
    assert last == end.replace(day=pycal.monthrange(end.year, end.month)[1]) - dt.timedelta(1)
    assert as_of_flag == _add_months(hi.date(), -1).strftime("%Y%m")
    years = mart.calendar_years_of(cal, mp.orders, "order_purchase_timestamp")
    assert years.count() == (dt.date(hi.year, 12, 31) - dt.date(lo.year, 1, 1)).days + 1
    one_pass = mart.calendar_years_for(mp.orders, "order_purchase_timestamp")
    assert one_pass.columns == years.columns
    assert sorted(one_pass.collect()) == sorted(years.collect())


def test_random_dates_match_model(spark):
    """Property check over two centuries (century leap rules, year ends, month ends)."""
    import random

    from stellate.functions import calendar_columns

    rng = random.Random(7)
    lo, hi = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 12, 31).toordinal()
    days = {dt.date.fromordinal(rng.randint(lo, hi)) for _ in range(1500)}
    days |= {dt.date(y, m, d) for y in (1900, 2000, 2100) for m, d in ((2, 28), (3, 1), (12, 31), (1, 1))}
    as_of = dt.date(2000, 3, 31)
    df = spark.createDataFrame([(d,) for d in sorted(days)], "d date")
    got = df.select(*calendar_columns(F.col("d"), F.lit(as_of), F.lit(None).cast("timestamp"))).collect()
    bad = []
    for row in got:
        expect = model(row["date"], as_of)
        bad += [(row["date"], k, row[k], v) for k, v in expect.items() if row[k] != v]
    assert not bad, bad[:10]


def test_calendar_of_no_data_is_empty(spark):
    empty = spark.createDataFrame([], "order_purchase_timestamp timestamp")
    nulls = spark.createDataFrame([(None,), (None,)], "order_purchase_timestamp timestamp")
    for df in (empty, nulls):
        assert mart.calendar_for(df, "order_purchase_timestamp").count() == 0
        assert mart.calendar_years_for(df, "order_purchase_timestamp").count() == 0
        assert mart.spine_of(df, "order_purchase_timestamp").count() == 0
