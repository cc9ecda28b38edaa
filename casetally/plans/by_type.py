"""Rulings by type and court."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.functions import codes
from casetally.functions.dates import with_dates
from casetally.functions.timing import INTERIM_CODE, in_own_interval
from casetally.operators.scope import in_interval, members, with_court_names
from casetally.operators.totals import with_total_rows


@dataclass(frozen=True)
class TypeSettings:
    operation: str
    labels: Mapping[str, str]
    default: str
    keep_missing_code: bool = True  # a NULL code takes the default label
    classes: tuple[str, ...] = ("S",)
    overrides: Mapping[str, str] | None = None  # ruling class replaces the label
    type_column: str = "tipo_resolucion"


CIVIL_TYPES = TypeSettings("CADR1C", codes.CIVIL_RULINGS, "Sent.Definitiva")
ENFORCEMENT_TYPES = TypeSettings(
    "CADR1C", codes.ENFORCEMENT_RULINGS, "Sentencia",
    classes=("S", *codes.BANKRUPTCY_CLASSES), overrides=codes.BANKRUPTCY_CLASSES,
    type_column="tipo_sentencia",
)
LABOUR_TYPES = TypeSettings("CADR1L", codes.LABOUR_RULINGS, "Sent.Definitiva")
CIVIL_THIRD_TYPES = TypeSettings(
    "CADR3C", codes.CIVIL_THIRD_RULINGS, "sin dato", keep_missing_code=False
)
LABOUR_THIRD_TYPES = TypeSettings(
    "CADR3L", codes.LABOUR_THIRD_RULINGS, "sin dato", keep_missing_code=False
)


def rulings_by_type(
    cases: DataFrame,
    population: DataFrame,
    courts: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    settings: TypeSettings = CIVIL_TYPES,
) -> DataFrame:
    """Final rulings of the interval counted per court and type, with court totals.

    Counts are taken per court code and label before the population and the
    directory are joined.
    """
    scoped = with_dates(in_interval(cases, start, end), "fres")
    code = F.col("tres")
    final = ~code.eqNullSafe(INTERIM_CODE) if settings.keep_missing_code else code != INTERIM_CODE
    ruling_class = F.upper(F.col("as"))
    kind = codes.label(code, settings.labels, settings.default)
    if settings.overrides:
        kind = codes.overridden(kind, ruling_class, settings.overrides)
    name = settings.type_column
    counted = (
        scoped.filter(
            ruling_class.isin(*settings.classes) & final & in_own_interval(F.col("fres"))
        )
        .groupBy(F.col("iep").alias("organismo"), kind.alias(name))
        .agg(F.count("*").alias("cantidad"))
    )
    counted = members(counted, population, key="organismo")
    court = ["circunscripcion", "organismo_descripcion"]
    return with_total_rows(
        with_court_names(counted, courts), [*court, name], ["cantidad"], group=court
    )
