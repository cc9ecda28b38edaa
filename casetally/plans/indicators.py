"""Indicators by operation code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casetally.functions.dates import day, month_start, with_dates
from casetally.functions.timing import share_of_classes, timing
from casetally.operators.scope import in_interval, members
from casetally.plans import rulings
from casetally.plans.mediation import mediation_indicators

RULINGS_BY_OPERATION = {
    s.operation: s
    for s in (
        rulings.CIVIL, rulings.LABOUR, rulings.PEACE_23, rulings.ADMINISTRATIVE,
        rulings.ADMINISTRATIVE_SUPREME,
    )
}
MEDIATION_OPERATION = "CRMED"


def indicators(
    rows: DataFrame,
    operation: str,
    population: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    monthly: bool = True,
) -> DataFrame:
    """The indicators an operation is counted by, per court (and reporting interval)."""
    if operation == MEDIATION_OPERATION:
        return mediation_indicators(members(in_interval(rows, start, end), population), monthly)
    if operation not in RULINGS_BY_OPERATION:
        raise ValueError(f"no indicators for operation {operation!r}")
    return rulings.ruling_counts(
        rows, population, start, end, RULINGS_BY_OPERATION[operation], monthly
    )


def all_indicators(
    rows: DataFrame, population: DataFrame, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """The monthly indicators of every operation, from one pass over ``rows``.

    ``rows`` has the columns of all operations and says in ``operation`` which one a row
    belongs to; rows of other operations are left out. Each operation is counted by its own
    settings: its due dates, and its excluded procedures. Result rows are by operation,
    interval and, for rulings, court (``organismo``), for mediations district and outcome;
    columns that an operation does not have are NULL. An operation with one deadline
    counts all late rulings in ``luego_1er_venc``.

    All rows are counted map-side once, by court, interval, month of dispatch and day of
    duration; the population, the grouping sets and medians are taken over the counts.
    """
    settings = list(RULINGS_BY_OPERATION.values())
    operation = F.col("operation")
    mediates = operation == MEDIATION_OPERATION
    two = operation.isin(*[s.operation for s in settings if len(s.due) == 2])
    excluded = F.lit(False)
    for s in settings:
        if s.exclude:
            # A missing procedure is left out as well, as in the operation's own report.
            procedure = F.coalesce(F.col("tproc").rlike(s.exclude), F.lit(True))
            excluded = excluded | ((operation == s.operation) & procedure)

    scoped = in_interval(rows, start, end).filter(
        operation.isin(*RULINGS_BY_OPERATION, MEDIATION_OPERATION) & ~excluded
    )
    scoped = with_dates(scoped, "fres", "fvenc1", "fvenc2", "fvenc", "fdesp")
    first_due = F.when(two, F.col("fvenc1")).otherwise(F.col("fvenc"))
    flags = timing(F.col("fres"), F.col("tres"), first_due, F.col("fvenc2"), one_deadline=~two)
    in_range = (F.col("fdesp") >= month_start(day(start))) & (F.col("fdesp") < day(end))
    measures = {
        "_pending": in_range, "causas_resueltas": flags.resolved, "a_termino": flags.on_time,
        "luego_1er_venc": flags.after_first, "luego_2do_venc": flags.after_second,
        **share_of_classes(flags.resolved, F.col("as")),
    }
    interval = ["data_interval_start", "data_interval_end"]
    own = {"tipo_circ": mediates, "tres_disc": mediates, "duracion": mediates}
    narrow = scoped.select(
        "operation", "iep", *interval,
        F.when(~mediates, month_start(F.col("fdesp"))).alias("_dispatch_month"),
        *[F.when(has, F.col(c)).alias(c) for c, has in own.items()],
        *[(m & ~mediates).alias(name) for name, m in measures.items()],
    )
    keys = ["operation", "iep", *interval, "_dispatch_month", *own]
    once = narrow.groupBy(*keys).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c)).alias(c) for c in measures]
    )
    once = members(once, population).withColumn("iep", F.when(~mediates, F.col("iep")))
    sets = [
        [F.col(k) for k in ("operation", "iep", *interval, "tipo_circ", "tres_disc")],
        [F.col(k) for k in ("operation", "iep", "_dispatch_month")],
    ]
    counted = once.groupingSets(
        sets, "operation", "iep", *interval, "tipo_circ", "tres_disc", "_dispatch_month"
    ).agg(
        (F.grouping("_dispatch_month") == 1).alias("_is_row"),
        *[F.sum(c).alias(c) for c in ("_n", *measures)],
        F.percentile("duracion", 0.5, F.col("_n")).alias("mediana_durac_inic_fin"),
    )
    is_row = F.col("_is_row")
    counted = counted.withColumn(
        "mes_inicio",
        F.when(is_row, month_start(F.col("data_interval_start"))).otherwise(F.col("_dispatch_month")),
    )
    pending = F.max(F.when(~is_row & (F.col("_pending") > 0), F.col("_pending")))
    same_month = Window.partitionBy("operation", "iep", "mes_inicio")
    out = counted.withColumn("_pending", pending.over(same_month)).filter(is_row)
    counts = [c for c in measures if c != "_pending"]
    return out.select(
        "operation", F.col("iep").alias("organismo"), "tipo_circ", "tres_disc", *interval,
        F.when(~mediates, F.col("_pending")).alias("causas_adespacho"),
        *[F.when(~mediates if c != "luego_2do_venc" else two, F.col(c)).alias(c) for c in counts],
        F.when(mediates, F.col("_n")).alias("resultado"),
        F.when(mediates, F.col("mediana_durac_inic_fin")).alias("mediana_durac_inic_fin"),
    )
