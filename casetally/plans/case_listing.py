"""Case-level listings with timing marks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.functions.codes import remap
from casetally.functions.dates import month_label, with_dates
from casetally.functions.timing import INTERIM_CODE, add_ignoring_null, one_or_null, timing
from casetally.operators.scope import dispatch_column, in_interval, members, with_court_names

HIGHER_COURT = "sal"
MARKS = ("med_mej_prov", "atermino", "res_luego1venc", "res_luego2venc", "inconsistencia2venc")


def _ruled_cases(
    cases: DataFrame, population: DataFrame, start: str | dt.date, end: str | dt.date,
    due: tuple[str, ...],
) -> tuple[DataFrame, dict[str, Column], str]:
    """Ruled cases of the period, their marks, and the name of the dispatch column.

    With two deadlines a population of higher courts uses the first one only; that is
    asked once of the population, not of the cases.
    """
    scoped = in_interval(cases, start, end)
    dispatched = dispatch_column(scoped)
    scoped = with_dates(scoped, "fres", *due, dispatched)
    ruled, dues = F.col("fres"), [F.col(c) for c in due]
    one_deadline = None
    if len(dues) == 2:
        one_deadline = population.agg(
            F.coalesce(F.bool_or(F.col("organismo").rlike(HIGHER_COURT)), F.lit(False))
        ).scalar()
    flags = timing(ruled, F.col("tres"), *dues, one_deadline=one_deadline)
    second = flags.after_second if flags.after_second is not None else F.lit(None).cast("boolean")
    twice = add_ignoring_null(flags.on_time, flags.after_first, second) == 2
    marks = dict(zip(MARKS, (
        one_or_null(F.col("tres") == INTERIM_CODE),
        one_or_null(flags.on_time),
        one_or_null(flags.after_first),
        one_or_null(second),
        one_or_null(twice),
    )))
    if len(dues) == 1:
        del marks["res_luego2venc"]
    return scoped.filter(ruled.isNotNull()), marks, dispatched


def case_listing(
    cases: DataFrame,
    population: DataFrame,
    courts: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    due: tuple[str, ...] = ("fvenc1", "fvenc2"),
    show_due: bool = True,
    total: bool = False,
) -> DataFrame:
    """Every ruled case with its marks: interim, on time, late, inconsistent.

    One narrow pass: the population and the directory are small tables next to the
    cases. ``total`` appends the row of :func:`listing_total`, which counts marks in a
    pass of its own.
    """
    scoped, marks, dispatched = _ruled_cases(cases, population, start, end, due)
    rows = members(scoped, population).select(
        remap(F.col("iep")).alias("organismo"),
        F.month("data_interval_start").alias("mes_orden"),
        month_label(F.col("data_interval_start")).alias("mes"),
        "nro",
        F.col(dispatched).alias("fecha_despacho"),
        *(due if show_due else ()),
        F.col("fres").alias("fecha_resolucion"),
        *[m.alias(name) for name, m in marks.items()],
    )
    columns = [c for c in rows.columns if c != "organismo"]
    listing = with_court_names(rows, courts).select(
        "circunscripcion", "organismo_descripcion", *columns
    )
    if not total:
        return listing
    return listing.withColumn("is_total", F.lit(False)).unionByName(
        listing_total(cases, population, start, end, due), allowMissingColumns=True
    )


def listing_total(
    cases: DataFrame, population: DataFrame, start: str | dt.date, end: str | dt.date,
    due: tuple[str, ...] = ("fvenc1", "fvenc2"),
) -> DataFrame:
    """The total row of a listing: marks counted per court, the population on the counts."""
    scoped, marks, _ = _ruled_cases(cases, population, start, end, due)
    counted = scoped.groupBy("iep").agg(*[F.count(m).alias(name) for name, m in marks.items()])
    return members(counted, population).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in marks]
    ).withColumn("is_total", F.lit(True))
