"""Report order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import TOTAL_ORDER


def in_report_order(df: DataFrame, *keys: str | Column, spread: Sequence[str] = ()) -> DataFrame:
    """Sort by ``keys``, then by ``spread``.

    A total sort cuts the data into ranges. Columns in ``spread`` break the ties of
    a court that owns a large share of the rows, so that its range can be cut too.
    """
    return df.orderBy(*keys, *spread)


def calendar_order(month: Column, is_total: Column) -> Column:
    """Sort key of a month: 1 to 12, and the total after diciembre."""
    return F.when(is_total, TOTAL_ORDER).otherwise(month)
