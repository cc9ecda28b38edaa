"""Court tables derived from a star schema of orders, line items and events.

Every report reads its court table through one of these views, so that the
operators see the same columns as on real listings. The views are lazy selects:
Spark prunes the columns a report does not use.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casetally.functions.dates import DAY_FIRST, day

# The whole period the tables cover.
START, END = "1995-01-01", "2002-01-01"
LOG_START, LOG_END = "2022-01-01", "2024-02-01"

# Procedure names built from a part's type and the two words of its name.
PROCEDURES = {
    "ECONOMY": "ORDINARIO", "STANDARD": "MEDIDA CAUTELAR", "LARGE": "EJECUCION",
    "MEDIUM": "COBRO DE PESOS", "PROMO": "OFICIO", "SMALL": "",
}
FIRST_WORDS = {
    "small": "VIOLENCIA FAMILIAR", "red": "DIVORCIO", "blue": "MONITORIO", "hot": "HABEAS",
    "old": "SALARIO", "large": "CERTIFICACION", "new": "INCIDENTE", "cold": "SUCESORIO",
}
SECOND_WORDS = {
    "ring": "DE PAZ", "widget": "GUARDA", "bolt": "", "gear": "PERSONAL", "plate": "USUCAPION",
    "anvil": "INFORMACION SUMARIA", "gizmo": "ALIMENTO", "rod": "AMPARO",
}


# Schemas of the tables, so that no job reads file footers to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(key: str) -> Column:
    return F.col(key).cast("string")


def _word(c: Column, words: dict[str, str]) -> Column:
    chain = None
    for word, name in words.items():
        chain = F.when(c == word, name) if chain is None else chain.when(c == word, name)
    return chain.otherwise(F.upper(c))


def procedure_name() -> Column:
    """A procedure name for a part."""
    words = F.split("p_name", " ")
    return F.trim(F.concat_ws(
        " ", _word(F.col("p_type"), PROCEDURES),
        _word(F.get(words, F.lit(0)), FIRST_WORDS), _word(F.get(words, F.lit(1)), SECOND_WORDS),
    ))


def court_cases(
    spark: SparkSession,
    sf_dir: str,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    procedures: bool = False,
    text_dates: bool = False,
    higher_court: bool = False,
    flag_gaps: bool = False,
) -> DataFrame:
    """One case per line item: dispatched with its order, ruled when shipped.

    With ``higher_court`` the dispatch date is called ``fdesp1``, and with ``flag_gaps``
    the appeal flag is unknown for every third order. ``start`` and ``end`` repeat the report's period on the stored ship date, which
    Parquet can filter on. Orders meet their customers before the larger line items
    do, so the large side is shuffled once at most.
    """
    items = table(spark, sf_dir, "lineitem")
    if start is not None:
        items = items.filter(F.col("l_shipdate") >= day(start))
    if end is not None:
        items = items.filter(F.col("l_shipdate") < day(end))
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    rows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if procedures:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    shipped, ordered = F.to_date("l_shipdate"), F.to_date("o_orderdate")
    no_ruling = (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7)
    month = F.trunc(shipped, "month")

    def stored(c: Column) -> Column:
        return F.date_format(c, DAY_FIRST) if text_dates else c

    columns = {
        "iep": _text("c_nationkey"),
        "data_interval_start": month,
        "data_interval_end": F.add_months(month, 1),
        "nro": F.col("l_orderkey"),
        "linea": F.col("l_linenumber"),
        "as": F.when(F.col("l_returnflag") == "R", "s").when(F.col("l_returnflag") == "A", "A"),
        "tres": F.when(F.col("l_linenumber") != 6, (F.col("l_linenumber") - 1).cast("string")),
        "fdesp": stored(ordered),
        "fres": stored(F.when(~no_ruling, shipped)),
        "fvenc1": stored(F.date_add(ordered, 30)),
        "fvenc2": stored(F.date_add(ordered, 60)),
        "fvenc": stored(F.date_add(ordered, 30)),
        "recirc": F.col("o_orderstatus") == "F",
    }
    if higher_court:
        columns["fdesp1"] = columns.pop("fdesp")
    if flag_gaps:
        columns["recirc"] = F.when(F.col("o_orderkey") % 3 != 0, columns["recirc"])
    if procedures:
        columns["tproc"] = procedure_name()
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def court_directory(spark: SparkSession, sf_dir: str, gap: bool = True) -> DataFrame:
    """Courts with name and district; one court is missing when ``gap``."""
    nation = table(spark, sf_dir, "nation")
    if gap:
        nation = nation.filter(F.col("n_name") != "NATION_24")
    return nation.join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        _text("n_nationkey").alias("organismo"),
        F.col("n_name").alias("organismo_descripcion"),
        F.col("r_name").alias("circunscripcion"),
        F.lower("r_name").alias("materia"),
    )


def population(spark: SparkSession, sf_dir: str, without: tuple[str, ...] = ()) -> DataFrame:
    """Every court, but for those left out."""
    courts = table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("organismo"))
    return courts.filter(~F.col("organismo").isin(*without)) if without else courts


# Courts that the reports over part of the courts leave out.
LEFT_OUT = ("3", "7", "11", "24")


def third_instance(df: DataFrame, code: str) -> DataFrame:
    """The same rows of courts whose codes are those of a third instance."""
    return df.withColumn(code, F.concat(F.lit("sal"), code))


def submission_log(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """One submission per event; the month goes back up to two years from the event.

    With ``gaps`` every seventh submission has no time.
    """
    events = table(spark, sf_dir, "events")
    back = F.pmod(F.col("event_id"), F.lit(24)).cast("int")
    start = F.add_months(F.trunc(F.to_date("ts"), "month"), -back)
    return events.select(
        F.col("event_id").alias("id_submission"),
        _text("user_id").alias("iep"),
        F.col("event_type").alias("operation"),
        start.alias("data_interval_start"),
        F.add_months(start, 1).alias("data_interval_end"),
        (F.col("value") > 2).alias("enabled"),
        (F.when(F.col("event_id") % 7 != 0, _text("ts")) if gaps else _text("ts")).alias("datetime"),
        F.col("props").alias("input"),
    )


def submitting_courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory of the courts in the submission log; some courts are missing."""
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        _text("s_suppkey").alias("organismo"),
        F.col("s_name").alias("organismo_descripcion"),
        F.col("n_name").alias("circunscripcion"),
    )


def submitting_population(spark: SparkSession, sf_dir: str, districts: str | None = None) -> DataFrame:
    """Every customer, as a court that may submit; with ``districts`` only courts of the
    directory, in districts that match."""
    if districts is None:
        return table(spark, sf_dir, "customer").select(_text("c_custkey").alias("organismo"))
    courts = submitting_courts(spark, sf_dir)
    return courts.filter(F.col("circunscripcion").rlike(districts)).select("organismo")


def hearings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hearing per event, with fields that are missing or dirty now and then."""
    events, no = table(spark, sf_dir, "events"), F.col("event_id")
    return events.select(
        _text("user_id").alias("iep"),
        F.when(no % 5 != 0, F.col("event_type")).alias("ta"),
        F.when(no % 11 == 0, " ").otherwise("R").alias("ra"),
        _text("event_id").alias("esta"),
        F.when(no % 13 != 0, _text("user_id")).otherwise("x1").alias("duracm"),
        F.pmod(no, F.lit(90)).cast("int").alias("duracb"),
        F.when(no % 17 != 0, F.to_date("ts")).alias("fea"),
        F.when(no % 3 == 0, "").otherwise(_text("user_id")).alias("jaud"),
        F.when(no % 4 == 0, "6").otherwise("1").alias("tres"),
        F.when(no % 19 != 0, _text("event_id")).alias("personas"),
    )


# Event types are the operations; one has no description.
OPERATION_NAMES = {
    "view": "Resoluciones", "click": "Audiencias", "signup": "Iniciados", "purchase": "Mediaciones",
}


def operation_directory(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(OPERATION_NAMES.items()), "operacion string, operacion_descripcion string"
    )


def mediations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mediation per order: district of the customer, outcome by market segment."""
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    month = F.trunc(F.to_date("o_orderdate"), "month")
    return (
        table(spark, sf_dir, "orders")
        .join(
            table(spark, sf_dir, "customer").join(
                places, F.col("c_nationkey") == F.col("n_nationkey")
            ),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .select(
            F.col("o_orderkey").alias("nro"),
            _text("c_nationkey").alias("iep"),
            F.col("r_name").alias("tipo_circ"),
            F.col("c_mktsegment").alias("tres_disc"),
            F.to_date("o_orderdate").alias("finicio"),
            month.alias("data_interval_start"),
            F.add_months(month, 1).alias("data_interval_end"),
        )
    )


def ended_mediations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mediations with the days from order to each shipment as their duration."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    return mediations(spark, sf_dir).join(items, F.col("nro") == F.col("l_orderkey")).withColumn(
        "duracion", F.datediff(F.to_date("l_shipdate"), "finicio")
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of movements, from the events of the courts in the directory.

    Events are counted per court, day and type before the directory is joined.
    """
    kind = F.pmod(F.col("user_id"), F.lit(4))
    court = (
        F.when(kind == 0, "JUZGADO DE FAMILIA").when(kind == 1, "juzgado de paz")
        .when(kind == 2, "DEFENSORIA DE FAMILIA").otherwise("Juzgado FAM. y Penal")
    )
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type", F.to_date("ts").alias("fecha"))
        .agg(F.count("*").alias("cantidad"))
    )
    return daily.join(
        submitting_courts(spark, sf_dir).withColumnRenamed("organismo", "iep"),
        F.col("user_id").cast("string") == F.col("iep"),
    ).select(
        F.col("circunscripcion").alias("jurisdiccion"),
        F.concat_ws(" ", court, "iep").alias("juzgado"),
        "fecha",
        F.when(F.col("event_type") == "click", "violencia_familiar")
        .when(F.col("event_type") == "view", "violencia_c-mujer").alias("movimientos_tipo"),
        "cantidad",
    )


def started_source(spark: SparkSession, sf_dir: str, finished: bool) -> DataFrame:
    """Started cases of the older (finished orders) or the newer source."""
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus") == "F" if finished else F.col("o_orderstatus") != "F"
    return orders.filter(status).select(
        F.pmod(F.col("o_custkey"), F.lit(25)).cast("string").alias("iep"),
        _text("o_custkey").alias("nro"),
        F.col("o_orderpriority").alias("caratula"),
        F.when(F.col("o_orderpriority") == "5-LOW", "OFICIO").otherwise("ORDINARIO").alias("tproc"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("finicio"),
        F.to_date("o_orderdate").alias("fmov"),
    )


def started_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Started cases counted per district, court, group and procedure."""
    size = F.when(F.col("p_size") <= 25, "NORTE").otherwise("SUR")
    return (
        table(spark, sf_dir, "part")
        .groupBy(
            size.alias("circunscripcion"), F.col("p_brand").alias("organismo"),
            F.col("p_type").alias("grupo_proceso"), F.col("p_name").alias("tipo_proceso"),
        )
        .agg(F.count("*").alias("cantidad"))
    )


def started_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One started case per part, with its procedure name."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("organismo"), procedure_name().alias("tproc")
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staffed posts; the holder of a post is given by id."""
    return table(spark, sf_dir, "supplier").select(
        _text("s_suppkey").alias("puesto"), _text("s_nationkey").alias("idagente")
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.pmod(F.col("n_nationkey"), F.lit(4))
    return table(spark, sf_dir, "nation").select(
        _text("n_nationkey").alias("idagente"),
        F.when(rank == 0, "JUEZ DE CAMARA").when(rank == 1, "SECRETARIO")
        .when(rank == 2, "ESCRIBIENTE").alias("categoria"),
        F.col("n_name").alias("apellido"),
        _text("n_regionkey").alias("nombres"),
    )


# Line numbers as operations: cases of line 6 belong to an operation without indicators.
LINE_OPERATIONS = {1: "CADR1C", 2: "CADR1L", 3: "CADRCAD", 4: "CADRCADS", 5: "CADRA23", 7: "CADR1C"}


def district_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of some orders as the holidays of a district; days repeat."""
    orders = table(spark, sf_dir, "orders").select(F.pmod("o_orderkey", F.lit(149)).alias("_no"), "o_orderdate")
    return table(spark, sf_dir, "region").join(orders, F.col("r_regionkey") == F.col("_no")).select(
        F.col("r_name").alias("circunscripcion"), F.to_date("o_orderdate").alias("fecha")
    )
