"""DTE-1..6: period keys, bounds, flight regularity, due periods.

Period keys are integers: month ``yyyyMM`` (6 digits), ISO week ``GGGG0VV``
(7 digits, ISO week-year, '0', two-digit ISO week), day ``yyyyMMdd``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

TS_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm")


def parse_day(c) -> Column:
    """'yyyyMMdd' or 'yyyy-MM-dd' text → DATE ('-' removed first)."""
    return F.to_date(F.regexp_replace(_col(c).cast("string"), "-", ""), "yyyyMMdd")


def month_key(d) -> Column:
    """DTE-1: calendar month key yyyyMM as INT."""
    return F.date_format(_col(d), "yyyyMM").cast("int")


def week_key(d) -> Column:
    """DTE-1: ISO week key GGGG0VV as INT."""
    d = _col(d)
    return F.concat(F.date_part(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("0"),
                    F.lpad(F.weekofyear(d).cast("string"), 2, "0")).cast("int")


def period_keys(day_text) -> tuple[Column, Column]:
    d = parse_day(day_text)
    return month_key(d), week_key(d)


def period_bounds(key) -> tuple[Column, Column]:
    """DTE-2: period key (6 = month, 7 = ISO week digits) → first, last day (DATE)."""
    k = _col(key).cast("string")
    y = k.substr(1, 4).cast("int")
    is_week = F.length(k) == 7
    mon = k.substr(5, 2).cast("int")
    wk = k.substr(6, 2).cast("int")
    month_start = F.make_date(y, F.when(is_week, F.lit(1)).otherwise(mon), F.lit(1))
    # Monday of ISO week 1 is the Monday of the week holding 4 January.
    week1 = F.date_trunc("week", F.make_date(y, F.lit(1), F.lit(4))).cast("date")
    week_start = F.date_add(week1, (wk - 1) * 7)
    first = F.when(is_week, week_start).otherwise(month_start)
    last = F.when(is_week, F.date_add(week_start, 6)).otherwise(F.last_day(month_start))
    return first, last


def day_text(d) -> Column:
    return F.date_format(_col(d), "yyyyMMdd")


def parse_ts(c) -> Column:
    """Timestamp text in either accepted format; '0', '' and bad text → NULL."""
    x = _col(c).cast("string")
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(fmt)) for fmt in TS_FORMATS])


def irregular_flag(dep_plan, dep_actual, arr_plan, arr_actual, arrival_gap: str = "reference") -> Column:
    """DTE-3: 1 = regular flight, 0 = irregular or unknown arrival.

    ``arrival_gap='reference'`` keeps the original sign (planned − actual, so an
    arrival more than 30 min early counts as irregular); ``'late'`` uses
    actual − planned.
    """
    aa, ap = parse_ts(arr_actual), parse_ts(arr_plan)
    da, dp = parse_ts(dep_actual), parse_ts(dep_plan)
    if arrival_gap == "reference":
        arr_gap = (F.unix_timestamp(ap) - F.unix_timestamp(aa)) / 60.0
    elif arrival_gap == "late":
        arr_gap = (F.unix_timestamp(aa) - F.unix_timestamp(ap)) / 60.0
    else:
        raise ValueError(f"arrival_gap must be 'reference' or 'late', not {arrival_gap!r}")
    dep_gap = (F.unix_timestamp(da) - F.unix_timestamp(dp)) / 60.0
    irregular = F.coalesce(arr_gap > 30, F.lit(False)) | F.coalesce(dep_gap > 30, F.lit(False))
    return (F.when(aa.isNull(), F.lit(0))
             .when(irregular, F.lit(0))
             .otherwise(F.lit(1))).cast("int")


def epoch_to_text(c) -> Column:
    """DTE-4: epoch seconds → UTC 'yyyy-MM-dd HH:mm:ss', whatever the session time zone."""
    x = _col(c).cast("long")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        days=F.floor(x / 86400).cast("int"), secs=(x - F.floor(x / 86400) * 86400).cast("decimal(18,6)"))
    return F.date_format(utc, "yyyy-MM-dd HH:mm:ss")


def due_periods(run_date) -> Column:
    """DTE-5: periods due on a run date, as an array of keys.

    On the 1st the previous calendar month is due, on a Monday the previous
    ISO week, both if both; on other days nothing (the daily job handles
    yesterday).
    """
    d = _col(run_date)
    prev_month = month_key(F.add_months(d, -1))
    prev_week = week_key(F.date_sub(d, 7))
    first = F.dayofmonth(d) == 1
    monday = F.dayofweek(d) == 2
    return (F.when(first & monday, F.array(prev_month, prev_week))
             .when(first, F.array(prev_month))
             .when(monday, F.array(prev_week))
             .otherwise(F.array().cast("array<int>")))


def valid_period(key, run_date) -> Column:
    """DTE-6: key is a month or week of the run date's year, up to the last finished one."""
    k = _col(key)
    d = _col(run_date)
    y = F.year(d)
    last_month = month_key(F.add_months(d, -1))
    last_week = week_key(F.date_sub(d, 7))
    is_month = (k >= y * 100 + 1) & (k <= last_month)
    is_week = (k >= y * 1000 + 1) & (k <= last_week)
    return is_month | is_week
