"""Optional columns, renames and printed headers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import TOTAL_LABEL

# Printed headers of the report columns.
HEADERS = {
    "circunscripcion": "circunscripción",
    "causas_adespacho": "causas a despacho del mes",
    "causas_resueltas": "causas resueltas",
    "a_termino": "a termino",
    "luego_1er_venc": "luego 1er Vencim",
    "luego_2do_venc": "luego 2do Vencim",
    "luego_venc": "luego Vencim",
    "sin_clasif": "sin clasif",
    "resol_vencidas": "resol vencidas",
    "periodos_informados": "mes (nro_file-fechahora)",
    "violencia_c_mujer": "violencia_c-mujer",
    "total": "Total",
}


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Names that match a pattern, in table order; none is no error."""
    return [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]


def rename_like(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Rename every column whose name contains the pattern."""
    names = {c: re.sub(pattern, replacement, c) for c in df.columns if re.search(pattern, c)}
    return df.withColumnsRenamed(names)


def printed(df: DataFrame, label_columns: tuple[str, ...] = ()) -> DataFrame:
    """The report as printed: one court column, headers in words, no helper columns.

    ``label_columns`` get the word for total on the first and a dash on the others
    in total rows, for reports whose totals are not labelled by month.
    """
    total = F.col("is_total") if "is_total" in df.columns else F.lit(False)
    for i, c in enumerate(label_columns):
        mark = TOTAL_LABEL if i == 0 else "-"
        df = df.withColumn(c, F.when(total, mark).otherwise(F.col(c)))
    if "organismo_descripcion" in df.columns:
        df = df.drop("organismo").withColumnRenamed("organismo_descripcion", "organismo")
    helpers = [c for c in ("is_total", "mes_orden", "mes_inicio", "residuo") if c in df.columns]
    return df.drop(*helpers).withColumnsRenamed({k: v for k, v in HEADERS.items() if k in df.columns})
