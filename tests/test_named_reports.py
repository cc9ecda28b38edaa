"""Every report by name over one stored folder."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casetally import schemas
from casetally.reports import Reports
from casetally.sources.readers import write_operation
from court_fixtures import ALL_COURTS, AUG, CASES, COURTS, JUL, cases, courts, population

RANGE = ("2018-07-01", "2018-09-01")


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("courts"))
    two = cases(spark)
    one = two.withColumn("fvenc", F.col("fvenc1")).withColumn("recirc", F.lit(True))
    for code in ("CADR1C", "CADRA23", "CADR3C", "CADR3L"):
        write_operation(two.withColumn("operation", F.lit(code)), f"{root}/operations")
    higher = one.withColumnRenamed("fdesp", "fdesp1")
    for code in ("CADR2L",):
        write_operation(higher.withColumn("operation", F.lit(code)), f"{root}/operations")
    for code in ("CADR1L", "CADRCAD", "CADRCADS"):
        write_operation(one.withColumn("operation", F.lit(code)), f"{root}/operations")
    mediations = spark.createDataFrame(
        [("cen1", "Norte", JUL, AUG, "Acuerdo", 9)], schemas.MEDIATIONS)
    write_operation(mediations.withColumn("operation", F.lit("CRMED")), f"{root}/operations")
    moved = spark.createDataFrame(
        [("jdocco01", "1", "A", "ORDINARIO", "02/02/2018", "03/02/2018", JUL)],
        "iep string, nro string, caratula string, tproc string, finicio string, fmov string, "
        "data_interval_start date")
    for code in ("CETAL_XL", "CINC1C"):
        write_operation(moved.withColumn("operation", F.lit(code)), f"{root}/operations")
    courts(spark).write.parquet(f"{root}/courts")
    spark.createDataFrame([("CADR1C", "Resoluciones")], schemas.OPERATIONS).write.parquet(
        f"{root}/operation_names")
    spark.createDataFrame(
        [(1, "jdocco01", "CADR1C", "cco", JUL, AUG, True, "2018-08-02 10:00:00", "x")],
        schemas.SUBMISSIONS).write.parquet(f"{root}/submissions")
    spark.createDataFrame(
        [("PARANÁ", "JUZGADO DE PAZ", dt.date(2018, 7, 5), "violencia_familiar", 3)],
        schemas.MOVEMENTS).write.parquet(f"{root}/movements")
    spark.createDataFrame([("p1", "1")], schemas.POSTS).write.parquet(f"{root}/posts")
    spark.createDataFrame([("1", "JUEZ", "X", "Y")], schemas.PERSONNEL).write.parquet(f"{root}/persons")
    return root


RULED = [
    "rulings_civil", "rulings_labour", "rulings_labour_appeal", "rulings_family", "rulings_peace",
    "rulings_peace_23", "rulings_administrative", "rulings_administrative_supreme", "types_civil",
    "types_enforcement", "types_labour", "types_civil_third", "types_labour_third", "cases_civil",
    "cases_labour", "cases_administrative",
]


def test_higher_labour_courts_keep_their_dispatch_date(spark, root):
    reports, scope = Reports(spark, root), population(spark, *ALL_COURTS)
    options = {"operation": "CADR2L"}
    plain = reports.rulings_civil(scope, *RANGE).filter("is_total").agg(F.sum("causas_adespacho")).first()[0]
    for df in (reports.rulings_labour(scope, *RANGE, higher_court=True, **options),
               reports.rulings_labour_appeal(scope, *RANGE, **options)):
        assert df.filter("is_total").agg(F.sum("causas_adespacho")).first()[0] == plain > 0
    listed = reports.cases_labour(scope, *RANGE, higher_court=True, **options)
    assert "fvenc" not in listed.columns
    assert listed.filter("NOT is_total AND fecha_despacho IS NOT NULL").count() > 0


def test_quality_reports_by_name(spark, root):
    reports = Reports(spark, root)
    rows = reports.court_rows("jdocco01", "CADR1C", *RANGE)
    index = reports.quality_index(rows, {"resolucion": reports.valid_ruling(rows)}, ["iep"])
    assert [r.iep for r in index.collect()] == ["jdocco01"]


@pytest.mark.parametrize("name", RULED)
def test_case_reports(spark, root, name):
    df = getattr(Reports(spark, root), name)(population(spark, *ALL_COURTS), *RANGE)
    rows = df.collect()
    assert any(r.organismo_descripcion == "Juzgado Civil 1" for r in rows)
    assert any(r.is_total for r in rows)


def test_civil_report_by_name_equals_the_report_on_rows(spark, root):
    from casetally.plans.rulings import rulings_report

    people = population(spark, *ALL_COURTS)
    stored = Reports(spark, root).rulings_civil(people, *RANGE).collect()
    direct = rulings_report(cases(spark), people, courts(spark), *RANGE).collect()
    assert sorted(map(str, stored)) == sorted(map(str, direct))


@pytest.mark.parametrize("operation", ["CADR1C", "CADR1L", "CADRA23", "CADRCAD", "CADRCADS"])
def test_indicators_by_operation(spark, root, operation):
    df = Reports(spark, root).indicators(operation, population(spark, "jdocco01"), *RANGE, monthly=False)
    assert df.first().organismo == "jdocco01"


def test_reports_come_in_order(spark, root):
    reports, people = Reports(spark, root), population(spark, "jdocco01", "jdocco02")
    rows = reports.rulings_civil(people, *RANGE).collect()
    assert [r.mes for r in rows] == ["julio", "agosto", "Total"]
    rows = reports.cases_civil(people, *RANGE).collect()
    assert [r.is_total for r in rows] == [False] * (len(rows) - 1) + [True]
    assert [r.mes_orden for r in rows[:-1]] == sorted(r.mes_orden for r in rows[:-1])
    unordered = reports.cases_civil(people, *RANGE, ordered=False)
    assert sorted(map(str, unordered.collect())) == sorted(map(str, rows))
    started = spark.createDataFrame([("N", "a", "G", "t", 3), ("N", "b", "G", "t", 9)],
                                    schemas.STARTED_COUNTS)
    moved = reports.reallocated(started, ["a"], ["b"], ["G"]).collect()
    assert [(r.organismo, r.cantidad) for r in moved] == [("b", 9), ("b", 3)]


def test_unknown_operation(spark, root):
    with pytest.raises(ValueError):
        Reports(spark, root).indicators("NONE", population(spark, "jdocco01"), *RANGE)


def test_other_reports(spark, root):
    reports = Reports(spark, root)
    civil = reports.population(["civil"], [1], district="Norte")
    assert {r.organismo for r in civil.collect()} == {"jdocco01", "jdocco02"}
    assert reports.court_rows("jdocco01", "CADR1C", *RANGE).count() == sum(
        r[0] == "jdocco01" for r in CASES)
    people = population(spark, "cen1")
    assert reports.mediation(people, *RANGE, {"Acuerdo": "acuerdo"}).count() == 2
    assert reports.indicators("CRMED", people, *RANGE).first().mediana_durac_inic_fin == 9.0
    assert reports.violence_movements(population(spark, "jdopaz01"), *RANGE).first().total == 3
    assert reports.started(civil, "CINC1C", "2018-01-01", "2018-09-01").count() == 1
    assert reports.submission_tracking(civil, *RANGE, per_cell=100).count() == 2
    assert reports.has_submission(civil, *RANGE, "CADR1C").first().presentada
    expected = spark.createDataFrame([("jdocco01", "CADR1C")], "iep string, operation string")
    assert reports.pending_submissions(expected, *RANGE).count() == 1
    assert reports.officials().first().apellido == "X"
    assert sorted(r.idagente for r in reports.official_ids().collect()) == ["0", "1"]
    assert reports.agents(reports.official_ids()).count() == 1
    codes = reports.current_codes(cases(spark)).select("iep").distinct()
    assert "jdofam0101con" not in {r.iep for r in codes.collect()}
    assert reports.classified(cases(spark), "civil").count() == 11
    assert len(COURTS) == 4
