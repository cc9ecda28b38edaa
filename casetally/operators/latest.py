"""Latest rows per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows that hold the greatest ``order`` of their key; ties are all kept.

    The greatest value is a map-side aggregate, and rows are matched to it on key
    *and* value. So a key that owns a large share of the rows is spread over its
    values, and what is left of it can be split by Spark's skew-join handling; a
    window would sort the whole key in one task. NULL keys form a group.
    """
    peak = df.groupBy(*keys).agg(F.max(order).alias("_peak"))
    peak = peak.select(*[F.col(k).alias(f"_{k}") for k in keys], "_peak")
    same = [df[k].eqNullSafe(peak[f"_{k}"]) for k in keys] + [df[order] == peak["_peak"]]
    return df.join(peak, reduce(lambda a, b: a & b, same), "left_semi")
