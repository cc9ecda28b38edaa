"""A known reporting error, and the raw rows of one court."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import day
from casetally.operators.scope import in_interval

# The court, dates, column and procedures of the known error.
ERROR_COURT = "jdopaz0000man"
ERROR_START = "2018-01-01"
ERROR_END = "2019-01-01"
ERROR_COLUMN = "iniciados"
ERROR_PROCEDURES = "RESIDUAL"


def without_known_error(
    started: DataFrame,
    court: str = ERROR_COURT,
    after: str | dt.date = ERROR_START,
    until: str | dt.date = ERROR_END,
    column: str = ERROR_COLUMN,
    procedures: str = ERROR_PROCEDURES,
) -> DataFrame:
    """Drop one court's residual rows when the table covers the error.

    The table covers it when *some* row is of the court, *some* row starts after
    the first date and *some* row ends at or past the second: three tests over the
    table, answered by one aggregate of a single row.
    """
    if column not in started.columns:
        return started

    def any_row(test: Column) -> Column:
        return F.coalesce(F.bool_or(test), F.lit(False))

    covered = started.agg(
        any_row(F.col("iep") == court)
        & any_row(F.col("data_interval_start") > day(after))
        & any_row(F.col("data_interval_end") >= day(until))
    ).scalar()
    wrong = (F.col("iep") == court) & F.col("tipo_procesos").rlike(procedures)
    return started.filter(~covered | ~wrong)


def court_rows(
    cases: DataFrame, court: str, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """Rows one court submitted for the period, as they are."""
    return in_interval(cases, start, end).filter(F.col("iep") == court)
