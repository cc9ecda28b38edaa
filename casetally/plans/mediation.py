"""Mediation results by outcome."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import TOTAL_LABEL, covers_one_month, day_before, month_label
from casetally.operators.ordering import calendar_order
from casetally.operators.reshape import widen, widen_to_map
from casetally.operators.scope import in_interval, members
from casetally.operators.totals import row_total, with_total_rows

_INTERVAL = ("data_interval_start", "data_interval_end")


def mediation_indicators(mediations: DataFrame, monthly: bool = True) -> DataFrame:
    """Mediations and their median duration in days per district and outcome.

    Durations are whole days: mediations are counted per day first, by a plain hash
    aggregate, and the exact median is taken over the days with their counts.
    """
    keys = ["tipo_circ", "tres_disc", *(_INTERVAL if monthly else ())]
    return _medians(mediations.groupBy(*keys, "duracion").agg(F.count("*").alias("casos")), keys)


def duration_days(mediations: DataFrame) -> DataFrame:
    """How many mediations took how many days, by district, outcome and interval.

    These histograms can be stored by month, as what is known of a month for good: any
    months' histograms add up to that of their range.
    """
    return mediations.groupBy("tipo_circ", "tres_disc", *_INTERVAL, "duracion").agg(
        F.count("*").alias("casos")
    )


def indicators_of_days(days: DataFrame, monthly: bool = True) -> DataFrame:
    """:func:`mediation_indicators` from :func:`duration_days`, exact for any range."""
    keys = ["tipo_circ", "tres_disc", *(_INTERVAL if monthly else ())]
    if not monthly:
        days = days.groupBy(*keys, "duracion").agg(F.sum("casos").alias("casos"))
    return _medians(days, keys)


def _medians(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    return days.groupBy(*keys).agg(
        F.sum("casos").alias("resultado"),
        F.percentile("duracion", 0.5, F.col("casos")).alias("mediana_durac_inic_fin"),
    )


def mediation_report(
    mediations: DataFrame,
    population: DataFrame | None,
    start: str | dt.date,
    end: str | dt.date,
    outcomes: Mapping[str, str] | None = None,
    monthly: bool = True,
    closing_date: bool = False,
    rest: str = "otros",
) -> DataFrame:
    """Mediations with one column per outcome, a total column and total rows.

    ``outcomes`` maps outcome codes to columns; outcomes not listed are counted in
    ``rest``, so that the schema is fixed. Left out, one column ``resultados`` maps every
    outcome that a row has to its count, in order of the code, however many outcomes
    there are; a NULL outcome is counted in ``rest``. Neither way runs a job. Cases are counted per court when a population is given, and only counts are
    restricted, pivoted and totalled.
    """
    scoped = in_interval(mediations, start, end)
    keys = ["circunscripcion", *(_INTERVAL if monthly else ())]
    court = ["iep"] if population is not None else []
    scoped = scoped.withColumnRenamed("tipo_circ", "circunscripcion")
    counted = scoped.groupBy(*keys, *court, "tres_disc").agg(F.count("*").alias("_n"))
    if population is not None:
        counted = members(counted, population)
    single = covers_one_month(start, end)
    detail = ["circunscripcion", *(_INTERVAL if monthly else ())]
    group = ["circunscripcion"] if monthly and not single else []
    if outcomes is None:
        measures = ["resultados", rest, "total"]
        rows = widen_to_map(counted, detail, "tres_disc", F.col("_n"), "resultados", rest, group=group)
    else:
        wide = widen(counted, keys, "tres_disc", outcomes, F.col("_n"), rest)
        values = [*outcomes.values(), rest]
        measures = [*values, "total"]
        rows = with_total_rows(wide.withColumn("total", row_total(*values)), detail, measures, group=group)
    if not monthly:
        return rows.withColumn(
            "circunscripcion", F.when(F.col("is_total"), TOTAL_LABEL).otherwise(F.col("circunscripcion"))
        )
    total, month = F.col("is_total"), F.col("data_interval_start")
    district = F.col("circunscripcion")
    if single:
        district = F.when(total, TOTAL_LABEL).otherwise(district).alias("circunscripcion")
    return rows.select(
        district,
        month.alias("mes_inicio"),
        F.when(total, TOTAL_LABEL).otherwise(month_label(month)).alias("mes"),
        calendar_order(F.month(month), total).alias("mes_orden"),
        *measures,
        *([day_before(F.col("data_interval_end")).alias("fecha")] if closing_date else []),
        "is_total",
    )
