"""Subtotal rows, grand totals and total columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_total_rows(
    df: DataFrame,
    detail: Sequence[str],
    measures: Sequence[str],
    group: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Detail rows plus one total row per ``group`` (one in all when it is empty).

    One pass with grouping sets over rows that are already counted. A total row is
    known by ``is_total``, taken from ``grouping()``, because a court missing from
    the directory has NULL keys of its own. ``carry`` columns follow their detail
    row and are NULL on totals. NULL measures add nothing.
    """
    inner = [c for c in detail if c not in group]
    sets = [[F.col(c) for c in detail], [F.col(c) for c in group]]
    summed = df.groupingSets(sets, *detail).agg(
        (F.grouping(inner[0]) == 1).alias("is_total"),
        *[F.sum(m).alias(m) for m in measures],
        *[F.first(c).alias(c) for c in carry],
    )
    total = F.col("is_total")
    return summed.select(
        *detail,
        *[F.when(total & F.col(m).isNull(), 0).otherwise(F.col(m)).alias(m) for m in measures],
        *[F.when(~total, F.col(c)).alias(c) for c in carry],
        "is_total",
    )


def with_grand_total(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Append one total row to a listing too long to be grouped.

    The listing itself is not shuffled; the total is a partial sum per task and
    one final row.
    """
    total = df.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    return df.withColumn("is_total", F.lit(False)).unionByName(
        total.withColumn("is_total", F.lit(True)), allowMissingColumns=True
    )


def row_total(*columns: str) -> Column:
    """Sum of columns in a row, NULL adding nothing."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(f"`{c}`"), F.lit(0))
    return total
