"""Was a ruling on time? Flags per case and the indicators counted from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

INTERIM_CODE = "0"  # interim measures do not count as rulings


@dataclass(frozen=True)
class Timing:
    """Three-valued flags of one case; NULL where a date is missing."""

    in_interval: Column
    final: Column
    resolved: Column
    on_time: Column
    after_first: Column
    after_second: Column | None


def in_own_interval(
    date: Column, start: str = "data_interval_start", end: str = "data_interval_end"
) -> Column:
    """Half-open test of a date against the row's reporting interval."""
    return (date >= F.col(start)) & (date < F.col(end))


def is_final(code: Column) -> Column:
    """Not an interim measure; a missing code counts as final."""
    return code.isNull() | (code != INTERIM_CODE)


def timing(
    ruled: Column,
    code: Column,
    first_due: Column,
    second_due: Column | None = None,
    one_deadline: Column | None = None,
) -> Timing:
    """Timing flags for one or two deadlines.

    ``one_deadline`` is an optional boolean that switches the second deadline off
    for the whole table (higher courts have only the first).
    """
    inside, final = in_own_interval(ruled), is_final(code)
    counts = inside & final
    late = (ruled > first_due) & counts
    if second_due is None:
        return Timing(inside, final, counts & ruled.isNotNull(),
                      (ruled <= first_due) & counts, late, None)
    first = late & (ruled <= second_due)
    second = (ruled > second_due) & counts
    if one_deadline is not None:
        first = F.when(one_deadline, late).otherwise(first)
        second = F.when(one_deadline, F.lit(None).cast("boolean")).otherwise(second)
    return Timing(inside, final, counts & ruled.isNotNull(),
                  (ruled <= first_due) & counts, first, second)


def one_or_null(flag: Column) -> Column:
    """1 where the flag is true, otherwise NULL."""
    return F.when(flag, 1)


def add_ignoring_null(*parts: Column) -> Column:
    """Sum of columns where NULL (and a false or NULL flag) adds nothing."""
    total = F.lit(0)
    for part in parts:
        total = total + F.coalesce(part.cast("bigint"), F.lit(0))
    return total


def share_of_classes(resolved: Column, ruling_class: Column) -> dict[str, Column]:
    """Resolved cases split into sentences, orders and the unclassified rest."""
    sentence = F.coalesce(F.upper(ruling_class) == "S", F.lit(False))
    order = F.coalesce(F.upper(ruling_class) == "A", F.lit(False))
    return {
        "sentencias": resolved & sentence,
        "autos": resolved & order,
        "sin_clasif": resolved & ~sentence & ~order,
    }
