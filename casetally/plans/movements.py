"""Movements under the two violence laws."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import day, day_before
from casetally.functions.text import title_case
from casetally.operators.reshape import widen
from casetally.operators.totals import row_total

# Movement types and their columns.
MOVEMENT_TYPES = {
    "violencia_familiar": "violencia_familiar",
    "violencia_c-mujer": "violencia_c_mujer",
}
NOT_A_COURT = "defensor"


def movements_between(
    movements: DataFrame, first: str | dt.date, last: str | dt.date
) -> DataFrame:
    """Movements per court and type between two days, both included."""
    return (
        movements.filter(F.col("fecha").between(day(first), day(last)))
        .groupBy("jurisdiccion", "juzgado", "movimientos_tipo")
        .agg(F.sum("cantidad").alias("cantidad"))
    )


def violence_movements(
    movements: DataFrame, population: DataFrame, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """Movements of family courts, or of peace courts when no family court is in scope.

    Both types are counted in one pass over the movements. ``end`` is exclusive.
    """
    family = population.agg(
        F.coalesce(F.bool_or(F.col("organismo").rlike("fam")), F.lit(False))
    ).scalar()
    name = F.lower("juzgado")
    scoped = movements.filter(
        (F.col("fecha") >= day(start)) & (F.col("fecha") <= day_before(day(end)))
        & F.col("movimientos_tipo").isin(*MOVEMENT_TYPES)
        & name.contains(F.when(family, "fam").otherwise("paz"))
        & ~name.contains(NOT_A_COURT)
    )
    wide = widen(
        scoped, ["jurisdiccion", "juzgado"], "movimientos_tipo", MOVEMENT_TYPES,
        value=F.col("cantidad"),
    )
    return wide.select(
        title_case(F.col("jurisdiccion")).alias("jurisdiccion"),
        title_case(F.col("juzgado")).alias("juzgado"),
        *MOVEMENT_TYPES.values(),
        row_total(*MOVEMENT_TYPES.values()).alias("total"),
    )
