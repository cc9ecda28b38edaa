"""The submission log: what was submitted, what is missing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import day, month_start, timestamp_day, to_day
from casetally.operators.cells import entries_in_cells
from casetally.operators.scope import in_interval, members
from casetally.sources.readers import without_payload


UNKNOWN = "?"


def current_submissions(log: DataFrame) -> DataFrame:
    """Submissions in force; replaced ones are disabled in the log."""
    return without_payload(log).filter(F.col("enabled"))


def submission_tracking(
    log: DataFrame,
    population: DataFrame,
    courts: DataFrame,
    operations: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    per_cell: int,
) -> DataFrame:
    """Months submitted per court and operation, as ``month (id/day)`` in order.

    ``per_cell`` is how many submissions one row prints; longer lists go on in further
    rows (``part``). An unknown id or day is printed as ``?``. Every court gets a
    subtotal. Courts and operations are named before the text exists and subtotals are
    counted from the log, so that the text is neither shuffled again nor aggregated.
    """
    court = ["circunscripcion", "organismo_descripcion"]

    def shown(c: Column) -> Column:
        return F.coalesce(c, F.lit(UNKNOWN))

    entry = F.concat(
        shown(F.month("data_interval_start").cast("string")), F.lit(" ("),
        shown(F.col("id_submission").cast("string")), F.lit("/"),
        shown(timestamp_day(F.col("datetime"))), F.lit(")"),
    )
    current = current_submissions(in_interval(log, start, end))
    named = (
        members(current, population)
        .join(operations.withColumnRenamed("operacion", "operation"), "operation", "left")
        .join(
            courts.select(F.col("organismo").alias("iep"), "organismo_descripcion", "circunscripcion"),
            "iep", "left",
        )
        .select(
            *court, "iep", "operation", "operacion_descripcion", "id_submission",
            month_start(F.col("data_interval_start")).alias("_month"), entry.alias("_entry"),
        )
    )
    listed = entries_in_cells(
        named, [*court, "iep", "operation", "operacion_descripcion"], "_month", "id_submission", "_entry",
        per_cell, into="periodos_informados", count="presentaciones", missing=UNKNOWN,
    )
    totals = named.groupBy(*court).agg(F.count("*").alias("presentaciones"))
    rows = listed.drop("operation").withColumn("is_total", F.lit(False)).unionByName(
        totals.withColumn("is_total", F.lit(True)), allowMissingColumns=True
    )
    return rows.select(
        *court, "iep", "operacion_descripcion", "part", "periodos_informados",
        "presentaciones", "is_total",
    )


def has_submission(
    log: DataFrame,
    population: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    operation: str,
) -> DataFrame:
    """One row, one boolean: did any court submit this operation?

    The log shrinks to one flag per court before the population is joined.
    """
    named = F.coalesce(F.bool_or(F.col("operation").rlike(operation)), F.lit(False))
    courts = (
        current_submissions(in_interval(log, start, end)).groupBy("iep").agg(named.alias("_any"))
    )
    return members(courts, population).agg(
        F.coalesce(F.bool_or("_any"), F.lit(False)).alias("presentada")
    )


def _months(start: str | dt.date, end: str | dt.date) -> Column:
    """First days of the months from ``start`` up to, not including, ``end``."""
    last = to_day(end) - dt.timedelta(days=1)
    return F.sequence(
        month_start(day(start)), month_start(F.lit(last)), F.expr("interval 1 month")
    )


def scheduled(courts: DataFrame, operations: Sequence[str]) -> DataFrame:
    """What is expected: every operation of every court, made inside the court's row."""
    each = F.explode(F.array(*[F.lit(o) for o in operations])).alias("operation")
    return courts.select(F.col("organismo").alias("iep"), each)


def pending_submissions(
    log: DataFrame, expected: DataFrame, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """Months an expected ``(iep, operation)`` pair has not submitted.

    ``expected`` comes from :func:`scheduled`, so that a court that never submitted is
    found as well.
    The months are generated inside each pair's row. The log is reduced to its
    distinct months before the anti join, so a court with many submissions weighs
    no more than its months.
    """
    due = expected.select(
        "iep", "operation", F.explode(_months(start, end)).alias("mes_inicio")
    )
    done = (
        current_submissions(in_interval(log, start, end))
        .select("iep", "operation", month_start(F.col("data_interval_start")).alias("mes_inicio"))
        .distinct()
    )
    return due.join(done, ["iep", "operation", "mes_inicio"], "left_anti")
