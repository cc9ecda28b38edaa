"""The registered queries: every operator over the whole star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetally.functions import dates
from casetally.functions.classify import RULES, classified_counts, classify
from casetally.functions.codes import label, overridden, remap
from casetally.functions.timing import in_own_interval
from casetally.operators.columns import columns_like, printed, rename_like
from casetally.operators.latest import latest_per_key
from casetally.operators.ordering import in_report_order
from casetally.operators.scope import in_interval, matching, members, with_court_names
from casetally.operators.totals import row_total, with_total_rows
from casetally.plans import by_type, calendar, corrections, mediation, quality, reallocation, rulings
from casetally.plans import staff, submissions, summary
from casetally.plans.case_listing import case_listing
from casetally.plans.indicators import all_indicators
from casetally.plans.movements import movements_between, violence_movements
from casetally.plans.started import started_cases
from casetally.plans.versions import in_force
from casetally.sources import starschema as star
from casetally.sources.hearings import exploded_parties

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EXCLUDED = "VIOLENCIA"
MONTH = ("1997-03-01", "1997-04-01")
MERGED = {"21": "1", "22": "2", "23": "3", "20": "3"}
TYPE_LABELS = {"1": "Conciliación", "2": "Transacción", "4": "Desistimiento"}
CLASS_LABELS = {"A": "Sent_Quiebra"}
OUTCOMES = {"BUILDING": "building", "FURNITURE": "furniture", "HOUSEHOLD": "household"}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
HOLIDAYS = ("1996-05-01", "1997-01-01", "1998-12-25", "1999-05-25", "2000-07-09", "2000-07-10")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rulings(spark: SparkSession, sf_dir: str, settings: rulings.RulingsSettings,
             monthly: bool = True, closing_date: bool = False, without: tuple[str, ...] = (),
             start: str = star.START, end: str = star.END, **view: bool) -> DataFrame:
    return rulings.rulings_report(
        star.court_cases(spark, sf_dir, start, end, **view),
        star.population(spark, sf_dir, without), star.court_directory(spark, sf_dir),
        start, end, settings, monthly, closing_date,
    )


@query
def rulings_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _rulings(spark, sf_dir, rulings.CIVIL, closing_date=True)
    return in_report_order(report, "circunscripcion", "organismo", "is_total", "mes_inicio")


@query
def rulings_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.CIVIL, monthly=False)


@query
def rulings_range_no_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.ADMINISTRATIVE, monthly=False)


@query
def rulings_single_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.LABOUR)


@query
def rulings_excluding_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = replace(rulings.FAMILY, exclude=EXCLUDED, merged=MERGED)
    return _rulings(spark, sf_dir, settings, procedures=True)


@query
def rulings_peace_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.PEACE_23, monthly=False, procedures=True)


@query
def rulings_appeal_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.LABOUR_APPEAL)


@query
def rulings_appeal_null_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rulings without an appeal flag are late rulings all the same."""
    return _rulings(spark, sf_dir, rulings.LABOUR_APPEAL, flag_gaps=True, higher_court=True)


@query
def rulings_labour_higher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.LABOUR, higher_court=True)


@query
def rulings_some_courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.CIVIL, without=star.LEFT_OUT)


@query
def rulings_single_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.CIVIL, closing_date=True, start=MONTH[0], end=MONTH[1])


@query
def rulings_from_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rulings(spark, sf_dir, rulings.CIVIL, monthly=False, text_dates=True)


@query
def rulings_printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printed(_rulings(spark, sf_dir, rulings.ADMINISTRATIVE_SUPREME))


@query
def pending_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rulings.pending_by_month(
        star.court_cases(spark, sf_dir, star.START, star.END),
        star.population(spark, sf_dir), star.START, star.END,
    )


def _by_type(spark: SparkSession, sf_dir: str, settings: by_type.TypeSettings,
             without: tuple[str, ...] = ()) -> DataFrame:
    return by_type.rulings_by_type(
        star.court_cases(spark, sf_dir, star.START, star.END),
        star.population(spark, sf_dir, without), star.court_directory(spark, sf_dir),
        star.START, star.END, settings,
    )


@query
def rulings_by_type_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_type(spark, sf_dir, by_type.CIVIL_TYPES)


@query
def rulings_by_type_some_courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_type(spark, sf_dir, by_type.CIVIL_TYPES, star.LEFT_OUT)


@query
def rulings_by_type_drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_type(spark, sf_dir, by_type.CIVIL_THIRD_TYPES)


@query
def rulings_by_type_labour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_type(spark, sf_dir, by_type.LABOUR_TYPES)


@query
def rulings_by_type_labour_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_type(spark, sf_dir, by_type.LABOUR_THIRD_TYPES)


@query
def rulings_by_type_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = replace(by_type.ENFORCEMENT_TYPES, classes=("S", "A"), overrides=CLASS_LABELS)
    report = _by_type(spark, sf_dir, settings)
    return in_report_order(
        report, "circunscripcion", "organismo_descripcion", "is_total", F.desc("cantidad"),
        spread=("tipo_sentencia",),
    )


def _listing(spark: SparkSession, sf_dir: str, without: tuple[str, ...] = (),
             higher_court: bool = False, total: bool = True, **options: object) -> DataFrame:
    return case_listing(
        star.court_cases(spark, sf_dir, star.START, star.END, higher_court=higher_court),
        star.population(spark, sf_dir, without), star.court_directory(spark, sf_dir),
        star.START, star.END, total=total, **options,
    )


@query
def case_listing_two_deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listing(spark, sf_dir)


@query
def case_listing_one_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = _listing(spark, sf_dir, due=("fvenc",))
    return in_report_order(
        listing, "is_total", "circunscripcion", "organismo_descripcion", "mes_orden",
        spread=("nro", "fecha_resolucion"),
    )


@query
def case_listing_labour_higher(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labour layout, without due date, over higher courts."""
    return _listing(spark, sf_dir, higher_court=True, due=("fvenc",), show_due=False)


@query
def case_listing_some_courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain listing: one pass, no total row."""
    return _listing(spark, sf_dir, without=star.LEFT_OUT, total=False)


@query
def case_listing_third_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With courts of third instance in the population only the first deadline counts."""
    return case_listing(
        star.third_instance(star.court_cases(spark, sf_dir, star.START, star.END), "iep"),
        star.third_instance(star.population(spark, sf_dir, star.LEFT_OUT), "organismo"),
        star.third_instance(star.court_directory(spark, sf_dir), "organismo"),
        star.START, star.END, total=True,
    )


@query
def case_inconsistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Due dates in the wrong order: a ruling between them is on time and late."""
    cases = star.court_cases(spark, sf_dir, star.START, star.END).withColumn(
        "fvenc2", F.date_sub("fvenc1", 25)
    )
    listing = case_listing(
        cases, star.population(spark, sf_dir), star.court_directory(spark, sf_dir),
        star.START, star.END,
    )
    return listing.groupBy("circunscripcion", "organismo_descripcion", "mes_orden").agg(
        F.count("*").alias("causas"),
        F.sum("atermino").alias("atermino"),
        F.sum("res_luego2venc").alias("luego_2do"),
        F.sum("inconsistencia2venc").alias("inconsistentes"),
    )


@query
def mediation_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mediation.mediation_report(
        star.mediations(spark, sf_dir), star.population(spark, sf_dir), star.START, star.END,
        OUTCOMES, closing_date=True,
    )


@query
def mediation_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mediation.mediation_report(
        star.mediations(spark, sf_dir), star.population(spark, sf_dir), star.START, star.END,
        OUTCOMES, monthly=False,
    )


@query
def mediation_some_courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mediation.mediation_report(
        star.mediations(spark, sf_dir), star.population(spark, sf_dir, star.LEFT_OUT),
        star.START, star.END, OUTCOMES, monthly=False,
    )


@query
def mediation_single_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mediation.mediation_report(
        star.mediations(spark, sf_dir), star.population(spark, sf_dir), *MONTH, OUTCOMES,
        closing_date=True,
    )


@query
def mediation_all_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No outcome is named when the report is made; the columns are picked from its cells."""
    report = mediation.mediation_report(
        star.mediations(spark, sf_dir), star.population(spark, sf_dir), star.START, star.END
    )
    cells = {o: F.coalesce(F.col("resultados")[o], F.lit(0)) for o in SEGMENTS}
    return printed(report.withColumns(cells).drop("resultados"))


@query
def median_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mediation.mediation_indicators(star.ended_mediations(spark, sf_dir), monthly=False)


@query
def median_duration_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mediation.mediation_indicators(star.ended_mediations(spark, sf_dir))


@query
def movements_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    courts = star.movements(spark, sf_dir).select(F.lower("juzgado").alias("organismo"))
    report = violence_movements(star.movements(spark, sf_dir), courts, "2024-01-01", "2024-02-01")
    return in_report_order(report, "jurisdiccion", "juzgado")


@query
def movements_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movements_between(star.movements(spark, sf_dir), "2024-01-01", "2024-01-31")


@query
def grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        star.mediations(spark, sf_dir).groupBy(F.col("iep").alias("organismo"))
        .agg(F.count("*").alias("causas"),
             F.count_if(F.col("tres_disc") == "BUILDING").alias("edificios"))
    )
    named = with_court_names(counts, star.court_directory(spark, sf_dir))
    rows = with_total_rows(
        named, ["circunscripcion", "organismo", "organismo_descripcion"], ["causas", "edificios"]
    )
    return rows.withColumn("total", row_total("causas", "edificios"))


def _classification(matter: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return classified_counts(star.started_procedures(spark, sf_dir), matter, ("organismo",))

    QUERIES[f"classify_{matter}"] = run


for _matter in RULES:
    _classification(_matter)


@query
def classified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(star.started_procedures(spark, sf_dir), "civil")


@query
def latest_per_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders")
    return latest_per_key(orders, ["o_custkey", "o_orderpriority"], "o_orderdate").select(
        "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey"
    )


@query
def started_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return started_cases(
        star.started_source(spark, sf_dir, True), star.started_source(spark, sf_dir, False),
        star.population(spark, sf_dir), star.START, star.END, cut_over="1998-07-01",
    )


@query
def started_some_courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return started_cases(
        star.started_source(spark, sf_dir, True), star.started_source(spark, sf_dir, False),
        star.population(spark, sf_dir, star.LEFT_OUT), star.START, star.END, cut_over="1998-07-01",
    )


@query
def submission_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = submissions.submission_tracking(
        star.submission_log(spark, sf_dir), star.submitting_population(spark, sf_dir),
        star.submitting_courts(spark, sf_dir), star.operation_directory(spark),
        star.LOG_START, star.LOG_END, per_cell=1000,
    )
    return in_report_order(
        report, "circunscripcion", "organismo_descripcion", "is_total", "operacion_descripcion",
        spread=("iep", "part"),
    )


@query
def submission_tracking_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report with cells so small that lists go on in further rows."""
    return submissions.submission_tracking(
        star.submission_log(spark, sf_dir), star.submitting_population(spark, sf_dir),
        star.submitting_courts(spark, sf_dir), star.operation_directory(spark),
        star.LOG_START, star.LOG_END, per_cell=5,
    )


@query
def submission_tracking_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some courts only, and submissions whose time is unknown."""
    return submissions.submission_tracking(
        star.submission_log(spark, sf_dir, gaps=True),
        star.submitting_population(spark, sf_dir, "NATION_[0-9]$"),
        star.submitting_courts(spark, sf_dir), star.operation_directory(spark),
        star.LOG_START, star.LOG_END, per_cell=20,
    )


@query
def pending_by_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every operation is due from every court of the directory, also if it never came."""
    return submissions.pending_submissions(
        star.submission_log(spark, sf_dir),
        submissions.scheduled(star.submitting_courts(spark, sf_dir), [*star.OPERATION_NAMES, "closing"]),
        star.LOG_START, star.LOG_END,
    )


@query
def has_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return submissions.has_submission(
        star.submission_log(spark, sf_dir), star.submitting_population(spark, sf_dir),
        star.LOG_START, star.LOG_END, "click|view",
    )


@query
def pending_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = star.submission_log(spark, sf_dir)
    expected = log.select("iep", "operation").distinct()
    return submissions.pending_submissions(log, expected, star.LOG_START, star.LOG_END)


@query
def current_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return submissions.current_submissions(star.submission_log(spark, sf_dir)).select(
        "id_submission", "iep", "operation", "data_interval_start"
    )


@query
def reallocation_one_receiver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reallocation.reallocate(
        star.started_counts(spark, sf_dir), ["Brand#1", "Brand#2"], ["Brand#3"],
        ["ECONOMY", "PROMO"],
    )


@query
def reallocation_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = reallocation.reallocate(
        star.started_counts(spark, sf_dir), ["Brand#1", "Brand#2"],
        ["Brand#3", "Brand#4", "Brand#5", "Brand#6"], ["ECONOMY"], inverse=True,
    )
    return in_report_order(
        moved, "circunscripcion", "organismo", "grupo_proceso", F.desc("cantidad"),
        spread=("tipo_proceso",),
    )


@query
def conditional_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc(F.to_date("o_orderdate"), "month")
    started = star.table(spark, sf_dir, "orders").select(
        F.pmod(F.col("o_custkey"), F.lit(25)).cast("string").alias("iep"),
        F.col("o_orderpriority").alias("tipo_procesos"),
        F.col("o_orderkey").alias("iniciados"),
        month.alias("data_interval_start"), F.add_months(month, 1).alias("data_interval_end"),
    )
    return corrections.without_known_error(
        started, court="7", after="1998-01-01", until="1999-01-01", procedures="LOW|HIGH",
    )


@query
def code_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        star.table(spark, sf_dir, "customer")
        .groupBy(remap(F.col("c_nationkey").cast("string"), MERGED).alias("iep"))
        .agg(F.count("*").alias("causas"))
    )


@query
def code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = star.table(spark, sf_dir, "lineitem")
    kind = overridden(
        label(F.col("l_linenumber").cast("string"), TYPE_LABELS, "sin dato"),
        F.upper("l_returnflag"), CLASS_LABELS,
    )
    return items.groupBy(kind.alias("tipo")).agg(F.count("*").alias("cantidad"))


@query
def official_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staff.official_ids(star.posts(spark, sf_dir), star.persons(spark, sf_dir))


@query
def officials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staff.officials(star.posts(spark, sf_dir), star.persons(spark, sf_dir))


@query
def staff_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staff.agents(star.persons(spark, sf_dir), star.posts(spark, sf_dir))


@query
def period_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.trunc(F.to_date("o_orderdate"), "month")
    end = F.add_months(start, 1 + F.pmod(F.col("o_orderkey"), F.lit(18)).cast("int"))
    return (
        star.table(spark, sf_dir, "orders")
        .groupBy(dates.period_label(start, end).alias("periodo"))
        .agg(F.count("*").alias("causas"))
    )


@query
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.to_date("o_orderdate")
    return (
        star.table(spark, sf_dir, "orders")
        .groupBy(
            F.year(ordered).alias("anio"), F.month(ordered).alias("mes_orden"),
            dates.month_label(ordered).alias("mes"),
        )
        .agg(
            dates.day_text(F.max(ordered)).alias("ultimo"),
            dates.day_text(dates.day_before(F.min(ordered)), "dd/MM/yyyy").alias("anterior"),
            dates.whole_months(F.lit("1990-01-01").cast("date"), F.min(ordered)).alias("meses"),
        )
    )


@query
def category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.category_labels(
        star.table(spark, sf_dir, "orders").withColumn("anio", F.year("o_orderdate")),
        "o_orderpriority", ["anio"], "o_totalprice",
        {"altas": ("1-URGENT", "2-HIGH"), "medias": ("3-MEDIUM",), "bajas": ("5-LOW",)},
        {"altas": 1, "medias": 2, "bajas": 1},
    )


@query
def category_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders").withColumn("anio", F.year("o_orderdate"))
    rows = summary.amounts_in_millions(orders, ["o_orderpriority", "anio"], "o_totalprice")
    return rows.withColumn("millones", F.col("millones").cast("double"))


@query
def court_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrections.court_rows(
        star.court_cases(spark, sf_dir, star.START, star.END), "7", star.START, star.END
    ).select("nro", "linea", "as", "tres", "fdesp", "fres", "data_interval_start")


@query
def population_by_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = matching(star.court_directory(spark, sf_dir), "circunscripcion", "AMERICA|EUROPE")
    cases = in_interval(star.mediations(spark, sf_dir), star.START, star.END)
    return members(cases, scope).groupBy("iep", "data_interval_start").agg(
        F.count("*").alias("causas")
    )


@query
def columns_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders")
    picked = orders.select("o_orderkey", *columns_like(orders, "date|price|no_such_column"))
    return rename_like(picked, "^o_", "causa_")


@query
def quality_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = star.court_cases(spark, sf_dir)
    rules = {
        "codigo": quality.conforms(F.col("tres")),
        "codigo_o_vacio": quality.conforms(F.col("tres"), optional=True),
        "resolucion": quality.valid_ruling(cases),
        "despacho_en_intervalo": in_own_interval(F.col("fdesp")),
    }
    return quality.quality_index(cases, rules, ["iep", "data_interval_start"])


@query
def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hearings of both forms and dismissals that count as declared."""
    hearings = star.hearings(spark, sf_dir)
    rules = {
        "audiencia": quality.valid_hearing(hearings),
        "audiencia_penal": quality.valid_hearing(hearings, penal=True),
        "sobreseimiento": quality.valid_dismissal(hearings, ruled="fea"),
    }
    return quality.quality_index(hearings, rules, ["iep"])


@query
def field_conformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        star.table(spark, sf_dir, "events")
        .withColumn("clave", F.get_json_object("props", "$.k"))
        .groupBy("event_type")
        .agg(
            F.count_if(quality.conforms(F.col("clave"))).alias("conformes"),
            F.count_if(~quality.conforms(F.col("props"))).alias("no_conformes"),
        )
    )


@query
def duplicate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.crowded_events(
        star.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def out_of_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = star.court_cases(spark, sf_dir)
    return quality.outside_interval(cases, "fdesp").groupBy("iep").agg(F.count("*").alias("fuera"))


@query
def within_business_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.share_within_business_days(
        star.court_cases(spark, sf_dir), ["iep"], 50, holidays=HOLIDAYS
    )


@query
def participants_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parties per customer, one of them with an empty and a missing field."""
    packed = F.concat(
        "c_name", F.lit("$"), F.col("c_custkey").cast("string"), F.lit("$ACTOR$"),
        F.col("c_mktsegment"), F.lit("%"), F.lower("c_name"), F.lit("$$DEMANDADO%"),
    )
    customers = star.table(spark, sf_dir, "customer").withColumn("justiables", packed)
    return exploded_parties(customers, "justiables", "c_custkey")


@query
def mediation_open_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry of the open pivot's cells, with its place in the cell."""
    report = mediation.mediation_report(
        star.mediations(spark, sf_dir), star.population(spark, sf_dir), "1996-03-01", "1999-06-01"
    )
    return report.select(
        "circunscripcion", "mes_inicio", "mes", "total", "is_total",
        F.posexplode(F.map_entries("resultados")).alias("lugar", "_e"),
    ).select("circunscripcion", "mes_inicio", "mes", "total", "is_total", "lugar",
             F.col("_e.key").alias("resultado"), F.col("_e.value").alias("cantidad"))


@query
def submissions_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was in force of each court and operation on every fifth day of the log."""
    day = F.to_date("ts")
    days = star.table(spark, sf_dir, "events").filter(F.day(day) % 5 == 0).select(day.alias("day"))
    log = star.submission_log(spark, sf_dir, gaps=True)
    return in_force(log, days.distinct(), ["iep", "operation"])


@query
def indicators_all_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings of five operations and mediations, told apart by their code in one table."""
    cases = star.court_cases(spark, sf_dir, star.START, star.END, procedures=True)
    operation = F.element_at(F.create_map(*[F.lit(x) for kv in star.LINE_OPERATIONS.items() for x in kv]), F.col("linea"))
    ended = star.ended_mediations(spark, sf_dir).drop("nro", "finicio", "l_orderkey", "l_shipdate")
    rows = cases.withColumn("operation", F.coalesce(operation, F.lit("CETAL_XL"))).unionByName(
        ended.withColumn("operation", F.lit("CRMED")), allowMissingColumns=True
    )
    return all_indicators(rows, star.population(spark, sf_dir, star.LEFT_OUT), star.START, star.END)


@query
def within_district_business_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holidays differ by district and come from a table."""
    courts = star.court_directory(spark, sf_dir).select(F.col("organismo").alias("iep"), "circunscripcion")
    working = calendar.working_calendar(
        courts, star.district_holidays(spark, sf_dir), "1994-01-01", "2003-01-01"
    )
    cases = star.court_cases(spark, sf_dir).join(courts, "iep")
    return calendar.share_within_working_days(cases, working, ["circunscripcion", "iep"], 50)


@query
def reallocation_apportioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares in proportion to weights that add up to what was handed over."""
    weights = {"Brand#3": 5, "Brand#4": 3, "Brand#5": 3, "Brand#6": 0}
    return reallocation.reallocate(
        star.started_counts(spark, sf_dir), ["Brand#1", "Brand#2"], list(weights), ["ECONOMY"],
        inverse=True, weights=weights,
    )
