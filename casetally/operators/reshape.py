"""Long to wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def widen(
    df: DataFrame,
    keys: Sequence[str | Column],
    on: str,
    columns: Mapping[str, str],
    value: Column | None = None,
    rest: str | None = None,
) -> DataFrame:
    """One column per listed value of ``on``, 0 where a key has none.

    ``columns`` maps values to column names, so the schema is stable and no job is
    run to find the values. Without ``value`` rows are counted, otherwise it is
    summed. ``rest`` names a column for values that are not listed, so that no row
    is lost. Keys met twice are added up.
    """
    amount = F.lit(1) if value is None else value
    listed = F.col(on).isin(*columns)

    def cell(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, amount)), F.lit(0))

    cells = [cell(F.col(on) == v).alias(name) for v, name in columns.items()]
    if rest:
        cells.append(cell(~F.coalesce(listed, F.lit(False))).alias(rest))
    return df.groupBy(*keys).agg(*cells)


def widen_to_map(
    df: DataFrame, keys: Sequence[str], on: str, value: Column, into: str, rest: str,
    group: Sequence[str] = (), total: str = "total",
) -> DataFrame:
    """One map cell per key, from each value of ``on`` that occurs to its sum; total rows.

    The values need not be known when the plan is made, and there may be any number of
    them; entries are in order of the value. NULL values are summed in the column
    ``rest``. Total rows, one per ``group`` (one in all when it is empty), are added up
    before cells are made, so that no cell is taken apart again. ``df`` is counted first:
    a cell holds one entry per value, not per row.
    """
    summed = df.groupBy(*keys, on).agg(F.sum(value).alias("_sum"))
    inner = [c for c in keys if c not in group]
    sets = [[F.col(c) for c in (*keys, on)], [F.col(c) for c in (*group, on)]]
    both = summed.groupingSets(sets, *keys, on).agg(
        (F.grouping(inner[0]) == 1).alias("is_total"), F.sum("_sum").alias("_sum")
    )
    entries = F.sort_array(F.collect_list(F.when(F.col(on).isNotNull(), F.struct(on, "_sum"))))
    cells = both.groupBy(*keys, "is_total").agg(
        F.map_from_entries(entries).alias(into),
        F.coalesce(F.sum(F.when(F.col(on).isNull(), F.col("_sum"))), F.lit(0)).alias(rest),
        F.sum("_sum").alias(total),
    )
    return cells.select(*keys, into, rest, total, "is_total")
