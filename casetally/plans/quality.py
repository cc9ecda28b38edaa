"""Quality of the listings: rules per row, shares per submission."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import business_days, date_of, with_dates
from casetally.functions.timing import in_own_interval

DIGITS = "^[0-9]+$"


def conforms(c: Column, optional: bool = False) -> Column:
    """A numeric field holds digits only; an optional one may be empty."""
    empty = c.isNull() | (c == "")
    ok = F.coalesce(c.rlike(DIGITS), F.lit(False))
    return ok | empty if optional else ok


def valid_ruling(
    df: DataFrame, dispatched: str = "fdesp", due: str = "fvenc1", ruled: str = "fres",
    kind: str = "as",
) -> Column:
    """A ruling counts as declared when its dates and its type are all there."""
    dates = [date_of(df, c).isNotNull() for c in (dispatched, due, ruled)]
    return dates[0] & dates[1] & dates[2] & F.coalesce(F.trim(kind) != "", F.lit(False))


# Fixed value: the ruling type of a dismissal.
DISMISSAL = "6"


def valid_dismissal(df: DataFrame, ruled: str = "fres", kind: str = "tres", persons: str = "personas") -> Column:
    """A dismissal counts as declared with its date, its type and whom it reaches."""
    return (
        date_of(df, ruled).isNotNull() & F.coalesce(F.trim(kind) == DISMISSAL, F.lit(False))
        & conforms(F.col(persons).cast("string"))
    )


def valid_hearing(df: DataFrame, penal: bool = False) -> Column:
    """A hearing counts as declared when date, type, state, result and lengths are there.

    In penal listings the judge has to be given as well.
    """
    given = F.lit(True)
    for c in ("ta", "ra", "esta", *(["jaud"] if penal else [])):
        given = given & F.coalesce(F.trim(c) != "", F.lit(False))
    for c in ("duracm", "duracb"):
        given = given & conforms(F.col(c).cast("string"))
    return given & date_of(df, "fea").isNotNull()


def quality_index(df: DataFrame, rules: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """Share of rows per group that pass each rule, and the mean of the shares.

    A rule that is NULL for a row counts as not passed. Shares come from two
    integer counts, so they do not depend on the order rows are added in.
    """
    passed = {
        name: F.count_if(F.coalesce(rule, F.lit(False))) / F.count("*")
        for name, rule in rules.items()
    }
    shares = df.groupBy(*by).agg(
        F.count("*").alias("filas"), *[c.alias(name) for name, c in passed.items()]
    )
    mean = sum((F.col(name) for name in rules), F.lit(0.0)) / F.lit(len(rules))
    return shares.withColumn("indice_calidad", mean)


def crowded_events(df: DataFrame, event: Sequence[str], limit: int = 2) -> DataFrame:
    """Events with more than ``limit`` records."""
    return (
        df.groupBy(*event).agg(F.count("*").alias("registros")).filter(F.col("registros") > limit)
    )


def outside_interval(df: DataFrame, date: str) -> DataFrame:
    """Rows whose date lies outside their own reporting interval.

    The complement of the interval test; a missing date is neither in nor out.
    """
    df = with_dates(df, date)
    return df.filter(~in_own_interval(F.col(date)))


def share_within_business_days(
    df: DataFrame,
    by: Sequence[str],
    days: int = 50,
    start: str = "fdesp",
    end: str = "fres",
    holidays: Sequence[str | dt.date] = (),
) -> DataFrame:
    """Rulings per group and the share made in fewer than ``days`` working days."""
    df = with_dates(df, start, end)
    a, b = F.col(start), F.col(end)
    ruled = df.filter(a.isNotNull() & b.isNotNull())
    quick = business_days(a, b, holidays) < days
    return ruled.groupBy(*by).agg(
        F.count("*").alias("resoluciones"),
        F.count_if(quick).alias("en_termino"),
        (F.count_if(quick) / F.count("*")).alias("proporcion"),
    )
