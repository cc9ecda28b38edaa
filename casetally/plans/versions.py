"""Which version of a submission was in force on which day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _next_days(days: DataFrame, day: str) -> DataFrame:
    """``_date, _no, day``: every date up to the last day asked for, with the first such
    day that is not before it. Dates before the first day count as that day itself."""
    numbered = days.select(F.col(day).cast("date").alias("day")).filter("day IS NOT NULL").distinct().withColumns({
        "_no": F.row_number().over(Window.orderBy("day")),
        "_before": F.lag("day").over(Window.orderBy("day")),
    })
    since = F.coalesce(F.date_add("_before", 1), F.col("day"))
    return numbered.select("_no", "day", F.explode(F.sequence(since, F.col("day"))).alias("_date"))


def validity(
    log: DataFrame, days: DataFrame, keys: Sequence[str], version: str = "id_submission",
    at: str = "datetime", day: str = "day",
) -> DataFrame:
    """``keys, version, valid_from, valid_to``: from which to which of the days asked for a
    version was in force (``valid_to`` inclusive).

    A version is in force from its day until a later one of its key comes; of one day's,
    the one submitted last, and at one time the larger id. Only the last version before
    each of the days can matter, so versions are reduced to one per key and day asked for,
    map-side first: a key with any number of versions weighs no more than ``days`` has
    rows, and no window sees more than that. Versions without a time were never in force;
    NULL keys are keys like others.
    """
    calendar = _next_days(days, day)
    first = days.agg(F.min(F.col(day).cast("date"))).scalar()
    stamped = (
        log.select(*keys, F.col(version).alias("_version"), F.try_to_timestamp(F.col(at)).alias("_at"))
        .filter(F.col("_at").isNotNull())
        .withColumn("_date", F.greatest(F.to_date("_at"), first))
    )
    last = (
        stamped.join(calendar, "_date").groupBy(*keys, "_no", F.col("day").alias("valid_from"))
        .agg(F.max(F.struct("_at", "_version")).alias("_last"))
    )
    following = F.lead("_no").over(Window.partitionBy(*keys).orderBy("_no"))
    numbers = calendar.select((F.col("_no") + 1).alias("_until"), F.col("day").alias("valid_to")).distinct()
    open_end = days.agg(F.count_distinct(F.col(day).cast("date"))).scalar() + 1
    return (
        last.withColumn("_until", F.coalesce(following, open_end)).join(numbers, "_until")
        .select(*keys, F.col("_last._version").alias(version), "valid_from", "valid_to")
    )


def in_force(
    log: DataFrame, days: DataFrame, keys: Sequence[str], version: str = "id_submission",
    at: str = "datetime", day: str = "day",
) -> DataFrame:
    """``keys, day, version``: for every day of ``days``, what was in force of each key.

    Keys without a version by then have no row for that day. The days are joined to the
    validity intervals by the day on which an interval may begin or go on, in one pass
    over the log; see :func:`validity`.
    """
    spans = validity(log, days, keys, version, at, day)
    month = F.trunc("day", "month").alias("_month")
    wanted = days.select(F.col(day).cast("date").alias("day")).distinct().select("day", month)
    months = F.sequence(F.trunc("valid_from", "month"), F.trunc("valid_to", "month"), F.expr("interval 1 month"))
    return (
        spans.select("*", F.explode(months).alias("_month")).join(wanted, "_month")
        .filter(F.col("day").between(F.col("valid_from"), F.col("valid_to")))
        .select(*keys, "day", version)
    )
