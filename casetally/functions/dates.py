"""Date expressions. Every function returns a Column; nothing runs on the driver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_FIRST = "dd/MM/yyyy"
DAY_FIRST_DASHED = "dd-MM-yyyy"

# Month names as printed in the reports, in calendar order.
MONTH_NAMES = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
    "septiembre", "octubre", "noviembre", "diciembre",
)
TOTAL_LABEL = "Total"
TOTAL_ORDER = 13  # a total row sorts after diciembre


def to_day(value: str | dt.date) -> dt.date:
    """A report argument (ISO text or date) as a date."""
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day(value: str | dt.date) -> Column:
    """A report argument as a DATE literal."""
    return F.lit(to_day(value))


def date_of(df: DataFrame, name: str, fmt: str = DAY_FIRST) -> Column:
    """Column ``name`` as a DATE, whatever the source stores.

    Text is parsed leniently (an impossible date is NULL); dates pass through and
    timestamps lose their time, so a typed table pays for no parsing.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.try_to_date(F.col(f"`{name}`"), fmt)
    if isinstance(kind, T.DateType):
        return F.col(f"`{name}`")
    return F.to_date(F.col(f"`{name}`"))


def with_dates(df: DataFrame, *names: str) -> DataFrame:
    """Parse the named text dates in place, once per row.

    Reports compare a date many times; as a column of its own it is parsed before
    the comparisons instead of inside each of them.
    """
    text = [n for n in names if isinstance(df.schema[n].dataType, T.StringType)]
    return df.withColumns({n: date_of(df, n) for n in text}) if text else df


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def month_label(c: Column) -> Column:
    """Month name of a date, from a constant list."""
    return F.element_at(F.split(F.lit(" ".join(MONTH_NAMES)), " "), F.month(c))


def day_before(c: Column) -> Column:
    """Last inclusive day of a half-open interval that ends at ``c``."""
    return F.date_sub(c, 1)


def day_text(c: Column, fmt: str = DAY_FIRST_DASHED) -> Column:
    return F.date_format(c, fmt)


def timestamp_day(c: Column) -> Column:
    """Day part of a timestamp kept as text."""
    return F.substring(c.cast("string"), 1, 10)


def whole_months(start: Column, end: Column) -> Column:
    """Complete months from ``start`` to ``end``."""
    return F.floor(F.months_between(end, start)).cast("int")


def covers_one_month(start: str | dt.date, end: str | dt.date) -> bool:
    """Whether the report arguments span one month, also over a year's end."""
    a, b = to_day(start), to_day(end)
    return (b.year - a.year) * 12 + b.month - a.month == 1


def period_label(start: Column, end: Column) -> Column:
    """Name of a half-open reporting period.

    The most specific name wins: one month, a half-year, a year, and otherwise a
    range of months. A range longer than a year names the year of ``end`` itself.
    """
    months = whole_months(start, end)
    first, last = month_label(start), month_label(day_before(end))
    year = F.year(start).cast("string")
    return (
        F.when(months == 1, F.concat_ws(" ", first, year))
        .when((months == 6) & (F.month(start) == 1), F.concat(F.lit("primer semestre "), year))
        .when((months == 6) & (F.month(start) == 7), F.concat(F.lit("segundo semestre "), year))
        .when(months == 12, F.concat(F.lit("anual "), year))
        .when(months < 12, F.concat_ws(" ", first, F.lit("-"), last, year))
        .when(
            months > 12,
            F.concat_ws(" ", first, year, F.lit("-"), last, F.year(end).cast("string")),
        )
    )


def _weekdays_before(c: Column) -> Column:
    """Weekdays from a fixed Monday up to, but not including, the date."""
    n = F.datediff(c, F.lit(dt.date(1900, 1, 1)))  # a Monday
    full_weeks = F.floor(n / F.lit(7)).cast("int")
    return full_weeks * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def business_days(start: Column, end: Column, holidays: Sequence[str | dt.date] = ()) -> Column:
    """Working days after ``start`` up to and including ``end``.

    Weekdays are counted in closed form. Holidays are counted from a constant list
    that holds, for each day from the first holiday to the last, how many there were
    so far. No calendar table is joined to the cases.
    """
    count = _weekdays_before(F.date_add(end, 1)) - _weekdays_before(F.date_add(start, 1))
    off = {h for h in map(to_day, holidays) if h.weekday() < 5}
    if not off:
        return count
    first, days = min(off), (max(off) - min(off)).days + 1
    so_far, running = 0, ["0"]
    for i in range(days):
        so_far += first + dt.timedelta(i) in off
        running.append(str(so_far))
    listed = F.split(F.lit(" ".join(running)), " ").cast("array<int>")

    def holidays_to(c: Column) -> Column:
        place = F.greatest(F.datediff(c, F.lit(first)) + 2, F.lit(1))
        return F.element_at(listed, F.least(place, F.lit(days + 1)))

    return count - (holidays_to(end) - holidays_to(start))
