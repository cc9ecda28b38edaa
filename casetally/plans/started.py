"""Started cases from two sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import day, with_dates
from casetally.operators.latest import latest_per_key
from casetally.operators.scope import excluding, members

# The day the older source ends, and procedures that are no cases.
CUT_OVER = "2018-07-01"
NOT_STARTED = "OFICIO|EXHORTO"
STARTED_COLUMNS = ("iep", "nro", "caratula", "tproc", "finicio")


def started_cases(
    older: DataFrame,
    newer: DataFrame,
    population: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    cut_over: str | dt.date = CUT_OVER,
) -> DataFrame:
    """Distinct started cases; a case moved between courts counts at its latest one.

    The older source counts up to ``cut_over``, the newer up to ``end``. Copies are
    merged map-side by the final ``distinct``.
    """

    def between(df: DataFrame, last: str | dt.date) -> DataFrame:
        return df.filter((F.col("finicio") >= day(start)) & (F.col("finicio") < day(last)))

    moved = members(older, population).filter(
        F.col("finicio").isNotNull() & F.col("fmov").isNotNull()
    )
    moved = with_dates(excluding(moved, "tproc", NOT_STARTED), "finicio", "fmov")
    current = latest_per_key(between(moved, cut_over), ["nro", "caratula"], "fmov")

    direct = with_dates(excluding(members(newer, population), "tproc", NOT_STARTED), "finicio")
    direct = between(direct, end).select(*STARTED_COLUMNS)
    return current.select(*STARTED_COLUMNS).unionByName(direct).distinct()
