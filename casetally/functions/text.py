"""Text expressions used in the printed reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(c: Column) -> Column:
    """Capitalize every word, words being split at any sign but an inner ``'_.``.

    ``initcap`` alone splits at blanks only and would leave ``SAN-JOSE`` as
    ``San-jose``.
    """
    words = F.split(F.lower(c), r"(?<=[^\p{L}\p{M}\p{N}'’_.])")
    return F.array_join(F.transform(words, F.initcap), "")


def half_even(c: Column, digits: int = 0) -> Column:
    """Rounding with ties to the even digit."""
    return F.bround(c, digits)


def percent_label(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` as rounded percent text, NULL when ``whole`` is 0."""
    ratio = F.try_divide(part, whole) * 100
    return F.concat(half_even(ratio).cast("bigint").cast("string"), F.lit(" %"))


def millions_label(amount: Column, digits: int) -> Column:
    """``$10.7 millones`` from an amount in millions; no trailing zeros."""
    fixed = half_even(amount, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.concat(F.lit("$"), F.regexp_replace(fixed, r"\.?0+$", "") if digits else fixed,
                    F.lit(" millones"))
