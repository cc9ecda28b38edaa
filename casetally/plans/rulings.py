"""Rulings per court and month: pending, resolved, on time, late, by class."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetally.functions.codes import MERGED_COURTS, remap
from casetally.functions.dates import (
    TOTAL_LABEL, covers_one_month, date_of, day_before, month_label, month_start, to_day,
    with_dates,
)
from casetally.functions.text import percent_label
from casetally.functions.timing import add_ignoring_null, share_of_classes, timing
from casetally.operators.ordering import calendar_order
from casetally.operators.scope import dispatch_column, excluding, in_interval, members, with_court_names
from casetally.operators.totals import with_total_rows


@dataclass(frozen=True)
class RulingsSettings:
    """What differs between the reports of the subject matters."""

    operation: str
    due: tuple[str, ...] = ("fvenc1", "fvenc2")
    late_columns: tuple[str, ...] = ("luego_1er_venc", "luego_2do_venc")
    exclude: str | None = None  # procedures left out
    merged: Mapping[str, str] | None = None  # court codes replaced, rulings only
    appeal_split: str | None = None  # flag that splits late rulings in two counts
    total_over_range: bool = True  # grand total when not by month


# Procedures the peace-court reports leave out.
VIOLENCE = "VIOLENCIA"
PEACE_23_EXCLUDED = "VIOLENCIA|CERTIFICACION|PROBATION|DILIGENCIAS|INFORMACION SUMARIA|SU "

CIVIL = RulingsSettings("CADR1C")
LABOUR = RulingsSettings("CADR1L", due=("fvenc",), late_columns=("luego_1er_venc",))
LABOUR_APPEAL = replace(LABOUR, appeal_split="recirc")
FAMILY = RulingsSettings("CADR1C", exclude=VIOLENCE, merged=MERGED_COURTS)
PEACE = RulingsSettings("CADR1C", exclude=VIOLENCE, total_over_range=False)
PEACE_23 = RulingsSettings("CADRA23", exclude=PEACE_23_EXCLUDED, total_over_range=False)
ADMINISTRATIVE = RulingsSettings(
    "CADRCAD", due=("fvenc",), late_columns=("luego_venc",), total_over_range=False
)
ADMINISTRATIVE_SUPREME = replace(ADMINISTRATIVE, operation="CADRCADS")


def ruling_measures(settings: RulingsSettings) -> list[str]:
    return ["causas_resueltas", "a_termino", *settings.late_columns, "sentencias", "autos", "sin_clasif"]


def _measured(
    cases: DataFrame, settings: RulingsSettings
) -> tuple[DataFrame, Column, dict[str, Column]]:
    """The cases that count, their date of dispatch, and each measure as a flag."""
    if settings.exclude:
        cases = excluding(cases, "tproc", settings.exclude)
    cases = with_dates(cases, "fres", *settings.due, dispatch_column(cases))
    flags = timing(F.col("fres"), F.col("tres"), *[F.col(c) for c in settings.due])
    late = [f for f in (flags.after_first, flags.after_second) if f is not None]
    measures: dict[str, Column] = {
        "causas_resueltas": flags.resolved,
        "a_termino": flags.on_time,
        **dict(zip(settings.late_columns, late)),
        **share_of_classes(flags.resolved, F.col("as")),
    }
    if settings.appeal_split:
        again = F.col(settings.appeal_split)
        first = settings.late_columns[0]
        measures[first] = flags.after_first & again
        measures["_late_other"] = flags.after_first & ~F.coalesce(again, F.lit(False))
    return cases, F.col(dispatch_column(cases)), measures


_INTERVAL = ["data_interval_start", "data_interval_end"]


def ruling_counts(
    cases: DataFrame,
    population: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    settings: RulingsSettings = CIVIL,
    monthly: bool = True,
) -> DataFrame:
    """Indicators per court (and reporting interval), with its pending cases.

    Rulings are counted by reporting interval and pending cases by the month of
    their dispatch. Cases are counted once, by court, interval and month of dispatch;
    the population and then the grouping sets of both keys are applied to the counts,
    and the pending count moves to the rulings of its month. Months are whole dates,
    so two years never mix. No case is doubled or shuffled by its court.
    """
    scoped, dispatched, measures = _measured(in_interval(cases, start, end), settings)
    in_range = (dispatched >= month_start(F.lit(to_day(start)))) & (dispatched < F.lit(to_day(end)))
    narrow = scoped.select(
        "iep",
        *(_INTERVAL if monthly else []),
        *([month_start(dispatched).alias("_dispatch_month")] if monthly else []),
        in_range.alias("_pending"),
        *[m.alias(name) for name, m in measures.items()],
    )
    counts = [F.count_if(c).alias(c) for c in ("_pending", *measures)]
    keys = ["iep", *(_INTERVAL + ["_dispatch_month"] if monthly else [])]
    once = members(narrow.groupBy(*keys).agg(*counts), population)
    return _assembled(once, list(measures), settings, monthly)


def stored_counts(cases: DataFrame, settings: RulingsSettings = CIVIL) -> DataFrame:
    """What reports are made of, to be stored: counts by court, interval and month of dispatch.

    They can be added up over any courts and months, and a month that is submitted again
    replaces the counts of its own interval only.
    """
    scoped, dispatched, measures = _measured(cases, settings)
    return (
        scoped.select(
            "iep", *_INTERVAL, month_start(dispatched).alias("mes_despacho"),
            dispatched.isNotNull().alias("despachadas"), *[m.alias(name) for name, m in measures.items()],
        )
        .groupBy("iep", *_INTERVAL, "mes_despacho")
        .agg(*[F.count_if(c).alias(c) for c in ("despachadas", *measures)])
    )


def ruling_counts_from(
    stored: DataFrame,
    population: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    settings: RulingsSettings = CIVIL,
    monthly: bool = True,
) -> DataFrame:
    """:func:`ruling_counts` from :func:`stored_counts`, without reading a case.

    Counts know the month of dispatch but not the day, so ``end`` has to begin a month.
    """
    if to_day(end).day != 1:
        raise ValueError("stored counts are by month: end has to be the first day of one")
    month = F.col("mes_despacho")
    in_range = (month >= month_start(F.lit(to_day(start)))) & (month < F.lit(to_day(end)))
    rows = in_interval(stored, start, end).withColumn(
        "_pending", F.when(in_range, F.col("despachadas")).otherwise(0)
    )
    measures = [c for c in stored.columns if c not in ("iep", *_INTERVAL, "mes_despacho", "despachadas")]
    rows = members(rows, population).withColumnRenamed("mes_despacho", "_dispatch_month")
    if not monthly:
        rows = rows.groupBy("iep").agg(*[F.sum(c).alias(c) for c in ("_pending", *measures)])
    return _assembled(rows, measures, settings, monthly)


def _assembled(
    once: DataFrame, measures: Sequence[str], settings: RulingsSettings, monthly: bool
) -> DataFrame:
    """Rulings by interval beside the pending cases of their month, from counts by both."""
    interval = _INTERVAL if monthly else []
    if monthly:
        keys = ["iep", *interval, "_dispatch_month"]
        sets = [[F.col(k) for k in ("iep", *interval)], [F.col("iep"), F.col("_dispatch_month")]]
        counted = once.groupingSets(sets, *keys).agg(
            (F.grouping("_dispatch_month") == 1).alias("_is_ruling"),
            *[F.sum(c).alias(c) for c in ("_pending", *measures)],
        )
    else:
        keys = ["iep"]
        counted = once.withColumn("_is_ruling", F.explode(F.array(F.lit(True), F.lit(False))))

    is_ruling = F.col("_is_ruling")
    if settings.merged:
        current = F.when(is_ruling, remap(F.col("iep"), settings.merged)).otherwise(F.col("iep"))
        counted = counted.withColumn("iep", current).groupBy(*keys, "_is_ruling").agg(
            *[F.sum(c).alias(c) for c in ("_pending", *measures)]
        )
    place = ["iep"]
    if monthly:
        month = F.when(is_ruling, month_start(F.col("data_interval_start")))
        counted = counted.withColumn("mes_inicio", month.otherwise(F.col("_dispatch_month")))
        place.append("mes_inicio")
    pending = F.max(F.when(~is_ruling & (F.col("_pending") > 0), F.col("_pending")))
    out = counted.withColumn("causas_adespacho", pending.over(Window.partitionBy(*place)))
    out = out.filter(is_ruling)
    if settings.appeal_split:
        first = settings.late_columns[0]
        out = out.withColumn(first, add_ignoring_null(F.col(first), F.col("_late_other")))
    dates = ["mes_inicio", *interval] if monthly else []
    return out.select(
        F.col("iep").alias("organismo"), *dates, "causas_adespacho", *ruling_measures(settings)
    )


def rulings_report(
    cases: DataFrame,
    population: DataFrame,
    courts: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    settings: RulingsSettings = CIVIL,
    monthly: bool = True,
    closing_date: bool = False,
) -> DataFrame:
    """The rulings report with totals and the share of late rulings.

    By month over several months every court gets a total row; over a single month,
    or over the whole range, there is one grand total. Rows without rulings are
    hidden after the totals are taken, so the totals still include them.
    """
    counts = ruling_counts(cases, population, start, end, settings, monthly)
    return _report(counts, courts, start, end, settings, monthly, closing_date)


def rulings_report_from(
    stored: DataFrame,
    population: DataFrame,
    courts: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    settings: RulingsSettings = CIVIL,
    monthly: bool = True,
    closing_date: bool = False,
) -> DataFrame:
    """The same report from :func:`stored_counts`."""
    counts = ruling_counts_from(stored, population, start, end, settings, monthly)
    return _report(counts, courts, start, end, settings, monthly, closing_date)


def _report(
    counts: DataFrame, courts: DataFrame, start: str | dt.date, end: str | dt.date,
    settings: RulingsSettings, monthly: bool, closing_date: bool,
) -> DataFrame:
    measures = ["causas_adespacho", *ruling_measures(settings)]
    named = with_court_names(counts, courts)
    court = ["circunscripcion", "organismo", "organismo_descripcion"]
    single = monthly and covers_one_month(start, end)
    if monthly:
        detail = [*court, "mes_inicio", "data_interval_end"]
        rows = with_total_rows(named, detail, measures, group=[] if single else court)
    elif settings.total_over_range:
        rows = with_total_rows(named, court, measures)
    else:
        rows = named.withColumn("is_total", F.lit(False))

    late = sum((F.col(c) for c in settings.late_columns), F.lit(0))
    shown = rows.filter(F.col("causas_resueltas") > 0).withColumn(
        "resol_vencidas", percent_label(late, F.col("causas_resueltas"))
    )
    total = F.col("is_total")
    if single or not monthly:
        shown = shown.withColumn(
            "circunscripcion", F.when(total, TOTAL_LABEL).otherwise(F.col("circunscripcion"))
        )
    months = []
    if monthly:
        month = F.col("mes_inicio")
        months = [
            month,
            F.when(total, TOTAL_LABEL).otherwise(month_label(month)).alias("mes"),
            calendar_order(F.month(month), total).alias("mes_orden"),
        ]
    dates = [day_before(F.col("data_interval_end")).alias("fecha")] if monthly and closing_date else []
    return shown.select(*court, *months, *measures, "resol_vencidas", *dates, "is_total")


def pending_by_month(
    cases: DataFrame, population: DataFrame, start: str | dt.date, end: str | dt.date,
    exclude: str | None = None,
) -> DataFrame:
    """Cases awaiting a ruling per court and month of dispatch."""
    scoped = in_interval(cases, start, end)
    if exclude:
        scoped = excluding(scoped, "tproc", exclude)
    month = month_start(date_of(scoped, dispatch_column(scoped)))
    counted = (
        scoped.groupBy("iep", month.alias("mes_inicio"))
        .agg(F.count("*").alias("causas_adespacho"))
        .filter(
            (F.col("mes_inicio") >= month_start(F.lit(to_day(start))))
            & (F.col("mes_inicio") < F.lit(to_day(end)))
        )
        .withColumn("mes", month_label(F.col("mes_inicio")))
    )
    return members(counted, population)
