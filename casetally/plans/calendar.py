"""Working days from a table of holidays, by district."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casetally.functions.dates import day, with_dates


def working_calendar(
    districts: DataFrame, holidays: DataFrame, start: str | dt.date, end: str | dt.date,
    district: str = "circunscripcion", date: str = "fecha",
) -> DataFrame:
    """``district, date, habiles``: working days of the district up to and including a date.

    ``districts`` lists the districts and ``holidays`` their holidays (``district, date``),
    any number of times; holidays of other districts or dates are not used. The table has a
    row for each district and date from ``start`` to ``end``, both included, and no window
    sees more than one district's. The difference of two dates' counts is the number of
    working days after the first up to the second.
    """
    dates = districts.select(F.col(district)).distinct().select(
        district, F.explode(F.sequence(day(start), day(end), F.expr("interval 1 day"))).alias(date)
    )
    off = holidays.select(district, F.col(date).cast("date").alias(date)).distinct().withColumn("_off", F.lit(1))
    works = (F.weekday(date) < 5) & F.col("_off").isNull()
    so_far = Window.partitionBy(district).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dates.join(off, [district, date], "left").select(
        district, date, F.sum(works.cast("bigint")).over(so_far).alias("habiles")
    )


def share_within_working_days(
    df: DataFrame, calendar: DataFrame, by: Sequence[str], days: int = 50,
    start: str = "fdesp", end: str = "fres", district: str = "circunscripcion", date: str = "fecha",
) -> DataFrame:
    """Rulings per group and the share made in fewer than ``days`` working days.

    ``calendar`` comes from :func:`working_calendar`. Cases are counted by group and both
    dates before the calendar is joined, so what is joined grows with the dates and not with
    the cases. A case without a date, without a district or beyond the calendar is left out.
    """
    dated = with_dates(df, start, end).filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    # The group's columns may name the dates or the district as well.
    counted = dated.select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(district).alias("_district"),
        F.col(start).alias("_start"), F.col(end).alias("_end"),
    )
    counted = counted.groupBy(*counted.columns).agg(F.count("*").alias("_n"))
    for name in ("_start", "_end"):
        counted = counted.join(
            calendar.select(F.col(district).alias("_district"), F.col(date).alias(name), F.col("habiles").alias(f"{name}_no")),
            ["_district", name],
        )
    quick = F.sum(F.when(F.col("_end_no") - F.col("_start_no") < days, F.col("_n")).otherwise(0))
    return counted.groupBy(*[F.col(f"_by{i}").alias(c) for i, c in enumerate(by)]).agg(
        F.sum("_n").alias("resoluciones"), quick.alias("en_termino"),
        (quick / F.sum("_n")).alias("proporcion"),
    )
