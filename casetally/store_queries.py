"""Registered queries that write a table from the given ones, change it and read it back.

They run jobs while they are built, as writing does; the others run none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetally.oracle import _DURATION, _MEDIATIONS, _PLAIN, _TWO_LATE, _rulings
from casetally.plans import mediation, rulings
from casetally.sources import readers, store
from casetally.sources import starschema as star
from casetally.sources.hearings import judged, quarantined

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MONTH, EMPTIED = "1997-03-01", "1997-05-01"
AGAIN = ("1", "2", "3")  # courts that submit MONTH again
WITHDRAWN = "4"  # the court whose EMPTIED month is submitted again without a case


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _courts(spark: SparkSession, sf_dir: str, *codes: str) -> DataFrame:
    courts = star.population(spark, sf_dir).withColumnRenamed("organismo", "iep")
    return courts.filter(F.col("iep").isin(*codes))


@query
def operation_store_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cases stored by month; some courts submit a month again, one of them nothing.

    What comes back are the rows of three courts in the months that a table lists.
    """
    cases = star.court_cases(spark, sf_dir)
    path = store.scratch_folder(spark)
    readers.write_operation(cases.withColumn("operation", F.lit("CADR1C")), path)
    late = cases.filter(F.col("iep").isin(*AGAIN) & (F.col("data_interval_start") == F.lit(MONTH).cast("date")))
    corrected = late.filter(F.col("linea") % 2 == 1).withColumn("tres", F.lit("9"))
    for _ in range(2):  # a second time changes nothing
        store.replace_month(corrected, path, "CADR1C", MONTH, _courts(spark, sf_dir, *AGAIN))
    store.replace_month(cases.limit(0), path, "CADR1C", EMPTIED, _courts(spark, sf_dir, WITHDRAWN))

    orders = star.table(spark, sf_dir, "orders").filter((F.col("o_custkey") <= 5) & (F.col("o_orderstatus") != "F"))
    listed = orders.select(F.trunc(F.to_date("o_orderdate"), "month").alias("data_interval_start"))
    fixed = spark.range(2).select(
        F.when(F.col("id") == 0, MONTH).otherwise(EMPTIED).cast("date").alias("data_interval_start")
    )
    back = store.read_months(spark, path, "CADR1C", cases.schema, listed.unionByName(fixed))
    return back.filter(F.col("iep").isin("1", "3", "4")).select(
        "iep", "data_interval_start", "nro", "linea", "tres", "fdesp", "fres", "as"
    )


ORACLE["operation_store_replaced"] = f"""
WITH {_PLAIN}, listed AS (
  SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes FROM orders
  WHERE o_custkey <= 5 AND o_orderstatus <> 'F'
  UNION SELECT DATE '{MONTH}' UNION SELECT DATE '{EMPTIED}'
)
SELECT iep, istart AS data_interval_start, nro, linea,
  CASE WHEN istart = DATE '{MONTH}' AND iep IN {AGAIN} THEN '9' ELSE tres END AS tres, fdesp, fres, clase AS "as"
FROM cases JOIN listed ON istart = mes
WHERE iep IN ('1', '3', '4') AND NOT (istart = DATE '{MONTH}' AND iep IN {AGAIN} AND linea % 2 = 0)
  AND NOT (istart = DATE '{EMPTIED}' AND iep = '{WITHDRAWN}')"""


@query
def rulings_from_stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly report from stored counts, after some courts submitted a month again."""
    cases = star.court_cases(spark, sf_dir)
    path = store.scratch_folder(spark)
    counts = rulings.stored_counts(cases, rulings.CIVIL)
    readers.write_operation(counts.withColumn("operation", F.lit("CADR1C")), path)
    late = cases.filter(F.col("iep").isin(*AGAIN) & (F.col("data_interval_start") == F.lit(MONTH).cast("date")))
    corrected = rulings.stored_counts(late.filter(F.col("linea") % 2 == 1), rulings.CIVIL)
    store.replace_month(corrected, path, "CADR1C", MONTH, _courts(spark, sf_dir, *AGAIN))
    kept = readers.read_operation(spark, path, "CADR1C", counts.schema)
    return rulings.rulings_report_from(
        kept, star.population(spark, sf_dir), star.court_directory(spark, sf_dir), star.START, star.END,
        rulings.CIVIL, closing_date=True,
    )


ORACLE["rulings_from_stored_counts"] = _rulings(
    _TWO_LATE, True, "court", closing_date=True,
    where=f"NOT (istart = DATE '{MONTH}' AND iep IN {AGAIN} AND linea % 2 = 0)",
)


@query
def median_from_stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians over a range of months from histograms stored by month."""
    days = mediation.duration_days(star.ended_mediations(spark, sf_dir))
    path = store.scratch_folder(spark)
    readers.write_operation(days.withColumn("operation", F.lit("CRMED")), path)
    kept = readers.read_operation(spark, path, "CRMED", days.schema)
    return mediation.indicators_of_days(
        kept.filter("data_interval_start >= '1996-02-01' AND data_interval_end <= '1998-10-01'"), monthly=False
    )


ORACLE["median_from_stored_days"] = f"""
WITH {_MEDIATIONS} SELECT tipo_circ, tres_disc, {_DURATION}
WHERE istart >= DATE '1996-02-01' AND iend <= DATE '1998-10-01' GROUP BY tipo_circ, tres_disc"""


@query
def hearing_listing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of all events with planted faults, written as text, read and split."""
    events, no = star.table(spark, sf_dir, "events"), F.col("event_id")
    number, date = no.cast("string"), F.date_format("ts", "dd/MM/yyyy")
    fields = {
        "nro": F.when(no % 13 == 0, F.concat(F.lit("x"), number)).otherwise(number),
        "caratula": F.when(no % 5 == 0, F.concat(F.lit('Ana "la" Gil c/ '), "event_type")).otherwise(F.col("event_type")),
        "tproc": F.col("event_type"),
        "asis": F.when(no % 17 == 0, "dos").otherwise((no % 10).cast("string")),
        "finicio": F.when(no % 19 == 0, "31/02/2024").otherwise(date),
        "duracm": F.lit("45"),
        "duracb": F.when(no % 3 == 0, "").when(no % 31 == 0, "99999999999").otherwise((no % 100).cast("string")),
        "ffa": date, "fea": F.when(no % 4 != 0, date), "faprueb": F.lit(None), "fprog": F.lit(" "),
        "ta": F.lit("1"), "ra": F.lit("A"), "esta": F.lit("3"), "jaud": F.lit(None), "oralidad": F.lit("1"),
        "audvid": F.lit("0"),
        "justiables": F.when(no % 23 == 0, "Solo$9%").otherwise('Ana$1$ACTOR$Calle "1"%Beto$$DEMANDADO$%'),
    }
    whole = readers.hearing_lines(events.filter(no % 29 != 0).select(*[c.alias(n) for n, c in fields.items()]))
    short = events.filter(no % 29 == 0).select(F.concat_ws("\t", number, F.lit("corta")).alias("value"))
    path = store.scratch_folder(spark)
    whole.unionByName(short).write.text(path)

    raw = readers.read_hearings(spark, path, header=False)
    checked = store.scratch_folder(spark)
    judged(raw).write.parquet(checked)  # the text is read once for both parts
    typed, rejected = quarantined(spark.read.parquet(checked))
    none = F.lit(None)
    return typed.select(
        F.col("nro").cast("string").alias("nro"), F.lit("typed").alias("estado"), none.cast("string").alias("error"),
        F.lit("").alias("errores"), "caratula", "finicio", "fea", "duracb", F.size("justiables").alias("partes"),
        F.col("justiables")[0]["address"].alias("domicilio"),
    ).unionByName(rejected.select(
        "nro", F.lit("rejected").alias("estado"), "error", F.array_join("errores", " ").alias("errores"), "caratula",
    ), allowMissingColumns=True)


ORACLE["hearing_listing_quarantine"] = """
WITH e AS (
  SELECT event_id AS no, event_type, CAST(ts AS DATE) AS dia, event_id % 29 = 0 AS corta,
    CASE WHEN event_id % 13 = 0 THEN 'x' ELSE '' END || CAST(event_id AS VARCHAR) AS nro
  FROM events
), f AS (
  SELECT *, concat_ws(' ', CASE WHEN corta THEN 'campos' END,
    CASE WHEN NOT corta AND no % 13 = 0 THEN 'numero:nro' END,
    CASE WHEN NOT corta AND no % 17 = 0 THEN 'numero:asis' END,
    CASE WHEN NOT corta AND no % 19 = 0 THEN 'fecha:finicio' END,
    CASE WHEN NOT corta AND no % 31 = 0 AND no % 3 <> 0 THEN 'numero:duracb' END,
    CASE WHEN NOT corta AND no % 23 = 0 THEN 'partes' END) AS errores
  FROM e
)
SELECT CASE WHEN corta THEN CAST(no AS VARCHAR) ELSE nro END AS nro,
  CASE WHEN errores = '' THEN 'typed' ELSE 'rejected' END AS estado,
  CASE WHEN errores <> '' THEN split_part(errores, ' ', 1) END AS error, errores,
  CASE WHEN corta THEN 'corta' WHEN no % 5 = 0 THEN 'Ana "la" Gil c/ ' || event_type ELSE event_type END AS caratula,
  CASE WHEN errores = '' THEN dia END AS finicio, CASE WHEN errores = '' AND no % 4 <> 0 THEN dia END AS fea,
  CASE WHEN errores = '' AND no % 3 <> 0 THEN CAST(no % 100 AS INTEGER) END AS duracb,
  CASE WHEN errores = '' THEN 2 END AS partes, CASE WHEN errores = '' THEN 'Calle "1"' END AS domicilio
FROM f"""
