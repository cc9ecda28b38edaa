"""What if some courts lost a group of cases to others?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.functions.text import half_even

SUBTOTAL = "subtotal"
_KEYS = ("circunscripcion", "organismo", "grupo_proceso", "tipo_proceso")


def _apportioned(amount: Column, receivers: Sequence[str], weights: Mapping[str, int]) -> Column:
    """Receivers with their quota rounded down, the largest remainder first."""
    total = sum(weights[r] for r in receivers)
    if total <= 0 or min(weights[r] for r in receivers) < 0:
        raise ValueError("weights have to be whole numbers, not all 0")

    def floor(r: str) -> Column:
        return F.call_function("div", amount * F.lit(weights[r]).cast("bigint"), F.lit(total).cast("bigint"))

    floors = sum((floor(r) for r in receivers), F.lit(0).cast("bigint"))
    quotas = [
        F.struct(
            (-F.pmod(amount * F.lit(weights[r]).cast("bigint"), F.lit(total).cast("bigint"))).alias("_less"),
            F.lit(r).alias("organismo"), floor(r).alias("_floor"), floors.alias("_floors"),
        )
        for r in receivers
    ]
    return F.sort_array(F.array(*quotas))


def reallocate(
    started: DataFrame,
    losers: Sequence[str],
    receivers: Sequence[str],
    groups: Sequence[str],
    inverse: bool = False,
    weights: Mapping[str, int] | None = None,
) -> DataFrame:
    """Started cases after ``losers`` hand the given groups to ``receivers``.

    ``inverse`` hands over every group but the given ones. One receiver takes all;
    several take equal rounded shares, and ``residuo`` on their rows says how many
    cases of the district and group the rounding gained or lost. Each summed group
    is repeated per receiver inside its row, in place of a cross join, and the
    remaining rows are those the condition does not meet, in place of an anti join.

    With ``weights``, a whole number for each receiver, the shares are in proportion and
    add up exactly: each receiver gets its quota rounded down, and what is left goes, one
    each, to the largest remainders, ties to the smaller court code (``residuo`` is 0).
    """
    cases = started.filter(F.col("tipo_proceso") != SUBTOTAL)
    listed = F.coalesce(F.col("grupo_proceso").isin(*groups), F.lit(False))
    moved = F.coalesce(F.col("organismo").isin(*losers), F.lit(False)) & (
        ~listed if inverse else listed
    )
    n = len(receivers)
    summed = cases.filter(moved).groupBy("circunscripcion", "grupo_proceso").agg(
        F.coalesce(F.sum("cantidad"), F.lit(0)).alias("_all")
    )
    if weights is not None:
        shared = summed.select(
            "circunscripcion", F.posexplode(_apportioned(F.col("_all"), receivers, weights)).alias("_place", "_r"),
            "grupo_proceso", "_all",
        )
        left = F.col("_all") - F.col("_r._floors")
        shared = shared.select(
            "circunscripcion", F.col("_r.organismo").alias("organismo"), "grupo_proceso",
            F.lit("-").alias("tipo_proceso"),
            (F.col("_r._floor") + (F.col("_place") < left).cast("bigint")).alias("cantidad"),
            F.lit(0).cast("bigint").alias("residuo"),
        )
        kept = cases.filter(~moved).select(*_KEYS, "cantidad")
        return kept.withColumn("residuo", F.lit(None).cast("bigint")).unionByName(shared)
    share = F.col("_all") if n == 1 else half_even(F.col("_all") / F.lit(n)).cast("bigint")
    shared = summed.select(
        "circunscripcion",
        F.explode(F.array(*[F.lit(r) for r in receivers])).alias("organismo"),
        "grupo_proceso",
        F.lit("-").alias("tipo_proceso"),
        share.alias("cantidad"),
        (F.col("_all") - share * n).alias("residuo"),
    )
    kept = cases.filter(~moved).select(*_KEYS, "cantidad")
    return kept.withColumn("residuo", F.lit(None).cast("bigint")).unionByName(shared)
