"""Every report by name, over tables stored in one folder.

    reports = Reports(spark, "/data/courts")
    civil = reports.population(["civil"], instances=[1])
    reports.rulings_civil(civil, "2018-07-01", "2018-09-01").write.parquet(...)

The folder holds ``operations`` (partitioned by operation and reporting month),
``courts``, ``operation_names``, ``submissions``, ``movements``, ``posts`` and
``persons`` as Parquet. Every method returns a lazy DataFrame in report order. The
counted reports are small; a case listing is not, and ``ordered=False`` saves its sort.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetally import schemas
from casetally.functions.classify import classify
from casetally.functions.codes import remap
from casetally.functions.dates import covers_one_month, period_label
from casetally.operators.ordering import in_report_order
from casetally.operators.scope import select_courts
from casetally.plans import (
    by_type, case_listing, corrections, indicators, mediation, movements, quality, rulings, staff,
    started, submissions, summary,
)
from casetally.plans.indicators import MEDIATION_OPERATION
from casetally.plans.reallocation import reallocate
from casetally.sources import readers
from casetally.sources.hearings import exploded_parties, typed_hearings

Day = str | dt.date


class Reports:
    """The reports over one folder of court tables."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # --- tables ---

    def _stored(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def operation(self, code: str, schema: T.StructType) -> DataFrame:
        return readers.read_operation(self.spark, f"{self.root}/operations", code, schema)

    def courts(self) -> DataFrame:
        return self._stored("courts", schemas.COURTS)

    def submissions(self) -> DataFrame:
        return self._stored("submissions", schemas.SUBMISSIONS)

    def population(
        self, matters: Sequence[str], instances: Sequence[int], district: str | None = None
    ) -> DataFrame:
        return select_courts(self.courts(), matters, instances, district)

    # --- rulings ---

    def _rulings(self, settings: rulings.RulingsSettings, schema: T.StructType, operation: str | None,
                 population: DataFrame, start: Day, end: Day, monthly: bool, closing_date: bool
                 ) -> DataFrame:
        cases = self.operation(operation or settings.operation, schema)
        report = rulings.rulings_report(
            cases, population, self.courts(), start, end, settings, monthly, closing_date
        )
        months = ["mes_inicio"] if monthly else []
        if monthly and not covers_one_month(start, end):
            return in_report_order(report, "circunscripcion", "organismo", "is_total", *months)
        return in_report_order(report, "is_total", "circunscripcion", "organismo", *months)

    def rulings_civil(self, population: DataFrame, start: Day, end: Day, monthly: bool = True,
                      closing_date: bool = False, operation: str | None = None,
                      higher_court: bool = False) -> DataFrame:
        schema = schemas.RULINGS_HIGHER_COURT if higher_court else schemas.RULINGS
        return self._rulings(rulings.CIVIL, schema, operation, population, start, end, monthly,
                             closing_date)

    def rulings_labour(self, population: DataFrame, start: Day, end: Day, monthly: bool = True,
                       closing_date: bool = False, operation: str | None = None,
                       higher_court: bool = False) -> DataFrame:
        return self._rulings(rulings.LABOUR, self._labour(higher_court), operation, population,
                             start, end, monthly, closing_date)

    @staticmethod
    def _labour(higher_court: bool) -> T.StructType:
        return schemas.RULINGS_ONE_DEADLINE_HIGHER_COURT if higher_court else schemas.RULINGS_ONE_DEADLINE

    def rulings_labour_appeal(self, population: DataFrame, start: Day, end: Day, monthly: bool = True,
                              closing_date: bool = False, operation: str | None = None) -> DataFrame:
        """Appeals come from higher courts only, which keep ``fdesp1``."""
        return self._rulings(rulings.LABOUR_APPEAL, schemas.RULINGS_APPEAL, operation, population,
                             start, end, monthly, closing_date)

    def rulings_family(self, population: DataFrame, start: Day, end: Day, monthly: bool = True,
                       closing_date: bool = False, operation: str | None = None) -> DataFrame:
        return self._rulings(rulings.FAMILY, schemas.RULINGS, operation, population, start, end,
                             monthly, closing_date)

    def rulings_peace(self, population: DataFrame, start: Day, end: Day, monthly: bool = True,
                      closing_date: bool = False, operation: str | None = None) -> DataFrame:
        return self._rulings(rulings.PEACE, schemas.RULINGS, operation, population, start, end,
                             monthly, closing_date)

    def rulings_peace_23(self, population: DataFrame, start: Day, end: Day, monthly: bool = True,
                         closing_date: bool = False) -> DataFrame:
        return self._rulings(rulings.PEACE_23, schemas.RULINGS, None, population, start, end,
                             monthly, closing_date)

    def rulings_administrative(self, population: DataFrame, start: Day, end: Day,
                               monthly: bool = True, closing_date: bool = False) -> DataFrame:
        return self._rulings(rulings.ADMINISTRATIVE, schemas.RULINGS_ONE_DEADLINE, None, population,
                             start, end, monthly, closing_date)

    def rulings_administrative_supreme(self, population: DataFrame, start: Day, end: Day,
                                       monthly: bool = True, closing_date: bool = False) -> DataFrame:
        return self._rulings(rulings.ADMINISTRATIVE_SUPREME, schemas.RULINGS_ONE_DEADLINE, None,
                             population, start, end, monthly, closing_date)

    def indicators(self, operation: str, population: DataFrame, start: Day, end: Day,
                   monthly: bool = True) -> DataFrame:
        settings = indicators.RULINGS_BY_OPERATION.get(operation)
        if settings is None:
            schema = schemas.MEDIATIONS
        else:
            schema = schemas.RULINGS if len(settings.due) == 2 else schemas.RULINGS_ONE_DEADLINE
        rows = self.operation(operation, schema)
        return indicators.indicators(rows, operation, population, start, end, monthly)

    # --- rulings by type ---

    def _by_type(self, settings: by_type.TypeSettings, schema: T.StructType,
                 population: DataFrame, start: Day, end: Day) -> DataFrame:
        cases = self.operation(settings.operation, schema)
        report = by_type.rulings_by_type(cases, population, self.courts(), start, end, settings)
        by = [F.desc("cantidad")] if settings.overrides else []
        return in_report_order(
            report, "circunscripcion", "organismo_descripcion", "is_total", *by,
            spread=(settings.type_column,),
        )

    def types_civil(self, population: DataFrame, start: Day, end: Day) -> DataFrame:
        return self._by_type(by_type.CIVIL_TYPES, schemas.RULINGS, population, start, end)

    def types_enforcement(self, population: DataFrame, start: Day, end: Day) -> DataFrame:
        return self._by_type(by_type.ENFORCEMENT_TYPES, schemas.RULINGS, population, start, end)

    def types_labour(self, population: DataFrame, start: Day, end: Day) -> DataFrame:
        return self._by_type(by_type.LABOUR_TYPES, schemas.RULINGS_ONE_DEADLINE, population, start, end)

    def types_civil_third(self, population: DataFrame, start: Day, end: Day) -> DataFrame:
        return self._by_type(by_type.CIVIL_THIRD_TYPES, schemas.RULINGS_THIRD_INSTANCE, population,
                             start, end)

    def types_labour_third(self, population: DataFrame, start: Day, end: Day) -> DataFrame:
        return self._by_type(by_type.LABOUR_THIRD_TYPES, schemas.RULINGS_THIRD_INSTANCE, population,
                             start, end)

    # --- cases ---

    def _cases(self, operation: str, schema: T.StructType, population: DataFrame, start: Day,
               end: Day, due: tuple[str, ...], show_due: bool, ordered: bool) -> DataFrame:
        listing = case_listing.case_listing(
            self.operation(operation, schema), population, self.courts(), start, end, due, show_due,
            total=True)
        if not ordered:
            return listing
        return in_report_order(
            listing, "is_total", "circunscripcion", "organismo_descripcion", "mes_orden",
            spread=("nro", "fecha_resolucion"),
        )

    def cases_civil(self, population: DataFrame, start: Day, end: Day, operation: str = "CADR1C",
                    higher_court: bool = False, ordered: bool = True) -> DataFrame:
        schema = schemas.RULINGS_HIGHER_COURT if higher_court else schemas.RULINGS
        return self._cases(operation, schema, population, start, end, ("fvenc1", "fvenc2"), True,
                           ordered)

    def cases_labour(self, population: DataFrame, start: Day, end: Day,
                     operation: str = "CADR1L", higher_court: bool = False,
                     ordered: bool = True) -> DataFrame:
        return self._cases(operation, self._labour(higher_court), population, start, end,
                           ("fvenc",), False, ordered)

    def cases_administrative(self, population: DataFrame, start: Day, end: Day,
                             operation: str = "CADRCAD", ordered: bool = True) -> DataFrame:
        return self._cases(operation, schemas.RULINGS_ONE_DEADLINE, population, start, end,
                           ("fvenc",), True, ordered)

    def court_rows(self, court: str, operation: str, start: Day, end: Day,
                   schema: T.StructType = schemas.RULINGS) -> DataFrame:
        return corrections.court_rows(self.operation(operation, schema), court, start, end)

    # --- mediation and movements ---

    def mediation(self, population: DataFrame, start: Day, end: Day,
                  outcomes: Mapping[str, str] | None = None, monthly: bool = True, closing_date: bool = False,
                  operation: str = MEDIATION_OPERATION) -> DataFrame:
        rows = self.operation(operation, schemas.MEDIATIONS)
        report = mediation.mediation_report(
            rows, population, start, end, outcomes, monthly, closing_date)
        if not monthly:
            return in_report_order(report, "is_total", "circunscripcion")
        first = [] if covers_one_month(start, end) else ["circunscripcion"]
        return in_report_order(report, *first, "is_total", "circunscripcion", "mes_inicio")

    def violence_movements(self, population: DataFrame, start: Day, end: Day) -> DataFrame:
        rows = self._stored("movements", schemas.MOVEMENTS)
        report = movements.violence_movements(rows, population, start, end)
        return in_report_order(report, "jurisdiccion", "juzgado")

    # --- started cases and scenarios ---

    def started(self, population: DataFrame, operation: str, start: Day, end: Day,
                older: str = "CETAL_XL") -> DataFrame:
        return started.started_cases(
            self.operation(older, schemas.STARTED_CASES),
            self.operation(operation, schemas.STARTED_CASES), population, start, end)

    @staticmethod
    def classified(cases: DataFrame, matter: str) -> DataFrame:
        return classify(cases, matter)

    @staticmethod
    def current_codes(df: DataFrame) -> DataFrame:
        return df.withColumn("iep", remap(F.col("iep")))

    @staticmethod
    def reallocated(started: DataFrame, losers: Sequence[str], receivers: Sequence[str],
                    groups: Sequence[str], inverse: bool = False) -> DataFrame:
        return in_report_order(
            reallocate(started, losers, receivers, groups, inverse),
            "circunscripcion", "organismo", "grupo_proceso", F.desc("cantidad"),
            spread=("tipo_proceso",),
        )

    corrected = staticmethod(corrections.without_known_error)

    # --- submissions and staff ---

    def submission_tracking(self, population: DataFrame, start: Day, end: Day,
                            per_cell: int) -> DataFrame:
        names = self._stored("operation_names", schemas.OPERATIONS)
        report = submissions.submission_tracking(
            self.submissions(), population, self.courts(), names, start, end, per_cell)
        return in_report_order(
            report, "circunscripcion", "organismo_descripcion", "is_total",
            "operacion_descripcion", spread=("iep", "part"),
        )

    def has_submission(self, population: DataFrame, start: Day, end: Day, operation: str) -> DataFrame:
        return submissions.has_submission(self.submissions(), population, start, end, operation)

    def pending_submissions(self, expected: DataFrame, start: Day, end: Day) -> DataFrame:
        return submissions.pending_submissions(self.submissions(), expected, start, end)

    @staticmethod
    def scheduled(population: DataFrame, operations: Sequence[str]) -> DataFrame:
        return submissions.scheduled(population, operations)

    # --- quality, hearings, summaries ---

    quality_index = staticmethod(quality.quality_index)
    crowded_events = staticmethod(quality.crowded_events)
    outside_interval = staticmethod(quality.outside_interval)
    within_business_days = staticmethod(quality.share_within_business_days)
    valid_ruling = staticmethod(quality.valid_ruling)
    valid_hearing = staticmethod(quality.valid_hearing)
    valid_dismissal = staticmethod(quality.valid_dismissal)
    category_labels = staticmethod(summary.category_labels)
    period_label = staticmethod(period_label)

    def hearings(self, path: str) -> DataFrame:
        """Typed hearings of a listing."""
        return typed_hearings(readers.read_hearings(self.spark, path))

    def hearing_parties(self, path: str) -> DataFrame:
        """One row per party of a listing's hearings."""
        return exploded_parties(readers.read_hearings(self.spark, path), "justiables", "nro")

    def officials(self) -> DataFrame:
        return staff.officials(
            self._stored("posts", schemas.POSTS), self._stored("persons", schemas.PERSONNEL))

    def official_ids(self) -> DataFrame:
        return staff.official_ids(
            self._stored("posts", schemas.POSTS), self._stored("persons", schemas.PERSONNEL))

    def agents(self, ids: DataFrame) -> DataFrame:
        return staff.agents(self._stored("persons", schemas.PERSONNEL), ids)
