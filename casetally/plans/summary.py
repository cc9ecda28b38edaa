"""Amounts by category in millions, with text labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.functions.text import half_even, millions_label

# Label groups of the budget concepts and the digits of each.
BUDGET_GROUPS = {
    "gasto_personal": ("gasto_personal",),
    "ingresos": ("activos_intangibles", "aportes_no_reintegrables"),
}
BUDGET_DIGITS = {"gasto_personal": 1, "ingresos": 2}
MILLION = 1_000_000


def amounts_in_millions(
    df: DataFrame, keys: Sequence[str], amount: str, digits: int = 1
) -> DataFrame:
    """Amounts summed per key, in rounded millions; what rounds to 0 is left out."""
    millions = half_even(F.sum(amount) / F.lit(MILLION), digits)
    return (
        df.groupBy(*keys)
        .agg(millions.cast(f"decimal(28,{digits})").alias("millones"))
        .filter(F.col("millones") != 0)
    )


def category_labels(
    df: DataFrame,
    category: str,
    keys: Sequence[str],
    amount: str,
    groups: Mapping[str, Sequence[str]],
    digits: Mapping[str, int],
    row_digits: int = 1,
) -> DataFrame:
    """One row: a money label per group of categories, from the rounded amounts."""
    rows = amounts_in_millions(df, [category, *keys], amount, row_digits)
    return rows.agg(*[
        millions_label(
            F.coalesce(F.sum(F.when(F.col(category).isin(*members), F.col("millones"))), F.lit(0)),
            digits.get(name, row_digits),
        ).alias(name)
        for name, members in groups.items()
    ])
