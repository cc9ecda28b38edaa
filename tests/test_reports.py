from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casetally import schemas
from casetally.plans import corrections, mediation, movements, quality, staff, submissions, summary
from casetally.plans.reallocation import reallocate
from casetally.plans.started import started_cases
from court_fixtures import AUG, DEC, JAN, JUL, SEP, courts, population, rows_by


# --- started cases ---------------------------------------------------------------------------

def started(spark, rows):
    return spark.createDataFrame(rows, schemas.STARTED_CASES)


def test_started_cases(spark):
    older = started(spark, [
        ("j1", "1", "A", "ORDINARIO", "01/02/2018", "05/02/2018"),
        ("j2", "1", "A", "ORDINARIO", "01/02/2018", "09/03/2018"),  # moved: the latest court counts
        ("j1", "2", "B", "ORDINARIO", "01/02/2018", "05/02/2018"),
        ("j2", "2", "B", "ORDINARIO", "01/02/2018", "05/02/2018"),  # a tie: both stay
        ("j1", "3", "C", "OFICIO", "01/02/2018", "05/02/2018"),
        ("j1", "4", "D", "ORDINARIO", "01/07/2018", "05/07/2018"),  # past the cut-over
        ("j1", "5", "E", "ORDINARIO", None, "05/02/2018"),
        ("j1", "6", "F", "ORDINARIO", "31/02/2018", "05/02/2018"),  # an impossible date
        ("j9", "7", "G", "ORDINARIO", "01/02/2018", "05/02/2018"),  # out of scope
        ("j1", "8", "H", None, "01/02/2018", "05/02/2018"),
    ])
    newer = started(spark, [
        ("j1", "2", "B", "ORDINARIO", "01/02/2018", None),  # same case in both sources
        ("j1", "4", "D", "ORDINARIO", "01/07/2018", None),
        ("j1", "4", "D", "ORDINARIO", "01/07/2018", None),
        ("j1", "9", "I", "EXHORTO", "01/07/2018", None),
        ("j1", "10", "J", "ORDINARIO", "01/09/2018", None),  # past the end
    ])
    df = started_cases(older, newer, population(spark, "j1", "j2"), "2018-01-01", "2018-09-01")
    assert sorted((r.iep, r.nro) for r in df.collect()) == [
        ("j1", "2"), ("j1", "4"), ("j2", "1"), ("j2", "2"),
    ]
    assert df.columns == ["iep", "nro", "caratula", "tproc", "finicio"]


# --- submissions -----------------------------------------------------------------------------

def log(spark, rows):
    return spark.createDataFrame(rows, schemas.SUBMISSIONS)


LOG = [
    (11, "jdocco01", "CADR1C", "cco", AUG, SEP, True, "2018-09-03 10:00:00", "file"),
    (7, "jdocco01", "CADR1C", "cco", JUL, AUG, True, "2018-08-02 09:30:00", "file"),
    (8, "jdocco01", "CADR1C", "cco", JUL, AUG, False, "2018-08-01 09:30:00", "file"),
    (9, "jdocco01", "XXX", "cco", JUL, AUG, True, "2018-08-05 09:30:00", "file"),
    (10, "jdonone", "CADR1C", "cco", JUL, AUG, True, "2018-08-06 09:30:00", "file"),
    (12, "jdopaz01", "CADR1C", "paz", JUL, AUG, True, "2018-08-06 09:30:00", "file"),
    (13, "jdocco01", "CADR1C", "cco", SEP, dt.date(2018, 10, 1), True, "2018-10-06 09:30:00", "file"),
]
SCOPE = ("jdocco01", "jdocco02", "jdonone")


def operations(spark):
    return spark.createDataFrame([("CADR1C", "Resoluciones")], schemas.OPERATIONS)


def test_submission_tracking(spark):
    df = submissions.submission_tracking(
        log(spark, LOG), population(spark, *SCOPE), courts(spark), operations(spark),
        "2018-07-01", "2018-09-01", per_cell=50,
    )
    got = {(r.iep, r.operacion_descripcion, r.is_total): r for r in df.collect()}
    assert got["jdocco01", "Resoluciones", False].periodos_informados == "7 (7/2018-08-02), 8 (11/2018-09-03)"
    assert got["jdocco01", "Resoluciones", False].presentaciones == 2
    assert got["jdocco01", None, False].periodos_informados == "7 (9/2018-08-05)"
    assert got["jdonone", "Resoluciones", False].organismo_descripcion is None
    totals = {r.organismo_descripcion: r.presentaciones for r in df.collect() if r.is_total}
    assert totals == {"Juzgado Civil 1": 3, None: 1}


def test_a_submission_without_time_is_listed(spark):
    rows = [(*LOG[0][:7], None, "file"), LOG[0]]
    got = submissions.submission_tracking(
        log(spark, rows), population(spark, *SCOPE), courts(spark), operations(spark),
        "2018-07-01", "2018-09-01", per_cell=50,
    ).filter("NOT is_total").collect()
    assert sum(r.presentaciones for r in got) == 2
    assert any(f"({LOG[0][0]}/?)" in r.periodos_informados for r in got)


def test_a_court_that_never_submitted_is_pending(spark):
    due = submissions.scheduled(population(spark, "jdocco01", "jdonever"), ["CADR1C"])
    got = submissions.pending_submissions(log(spark, LOG), due, "2018-07-01", "2018-09-01").collect()
    assert {r.mes_inicio.month for r in got if r.iep == "jdonever"} == {7, 8}


@pytest.mark.parametrize("operation, codes, found", [
    ("CADR1C", SCOPE, True), ("CADR", SCOPE, True), ("CADR9", SCOPE, False),
    ("CADR1C", ("jdocco02",), False),
])
def test_has_submission(spark, operation, codes, found):
    df = submissions.has_submission(
        log(spark, LOG), population(spark, *codes), "2018-07-01", "2018-09-01", operation
    )
    assert [tuple(r) for r in df.collect()] == [(found,)]


def test_pending_submissions(spark):
    expected = spark.createDataFrame(
        [("jdocco01", "CADR1C"), ("jdocco02", "CADR1C"), ("jdocco01", "XXX")],
        "iep string, operation string")
    df = submissions.pending_submissions(log(spark, LOG), expected, "2018-07-01", "2018-09-01")
    assert sorted(tuple(r) for r in df.collect()) == [
        ("jdocco01", "XXX", AUG), ("jdocco02", "CADR1C", JUL), ("jdocco02", "CADR1C", AUG),
    ]


def test_current_submissions_drop_the_file(spark):
    df = submissions.current_submissions(log(spark, LOG))
    assert "input" not in df.columns and df.count() == 6


# --- reallocation ----------------------------------------------------------------------------

STARTED = [
    ("Norte", "a", "G1", "t1", 5), ("Norte", "a", "G1", "t2", 6), ("Norte", "a", "G2", "t1", 4),
    ("Norte", "a", "G1", "subtotal", 11), ("Norte", "b", "G1", "t1", 2), ("Sur", "c", "G1", "t1", 7),
    ("Norte", "a", None, "t9", 3),
]


def reallocated(spark, *args, **kw):
    df = reallocate(spark.createDataFrame(STARTED, schemas.STARTED_COUNTS), *args, **kw)
    return {(r.circunscripcion, r.organismo, r.grupo_proceso, r.tipo_proceso): (r.cantidad, r.residuo)
            for r in df.collect()}


def test_one_receiver_takes_all(spark):
    got = reallocated(spark, ["a", "c"], ["b"], ["G1"])
    assert got == {
        ("Norte", "a", "G2", "t1"): (4, None), ("Norte", "a", None, "t9"): (3, None),
        ("Norte", "b", "G1", "t1"): (2, None),
        ("Norte", "b", "G1", "-"): (11, 0), ("Sur", "b", "G1", "-"): (7, 0),
    }


def test_several_receivers_take_rounded_shares(spark):
    got = reallocated(spark, ["a", "c"], ["x", "y"], ["G1"])
    assert got["Norte", "x", "G1", "-"] == (6, -1)  # 5.5 rounds to even
    assert got["Sur", "y", "G1", "-"] == (4, -1)  # 3.5 rounds to even
    total = sum(c for c, _ in got.values())
    lost = {(d, g): r for (d, _, g, t), (_, r) in got.items() if t == "-"}
    assert total + sum(lost.values()) == sum(r[4] for r in STARTED if r[3] != "subtotal")


def test_inverse_moves_the_other_groups_and_missing_ones(spark):
    got = reallocated(spark, ["a"], ["z"], ["G1"], inverse=True)
    assert got["Norte", "z", "G2", "-"] == (4, 0) and got["Norte", "z", None, "-"] == (3, 0)
    assert ("Norte", "a", "G1", "t1") in got and ("Norte", "a", "G2", "t1") not in got


# --- correction, raw rows, staff -------------------------------------------------------------

def error_rows(spark, *rows):
    return spark.createDataFrame(
        rows, "iep string, tipo_procesos string, iniciados long, data_interval_start date, "
              "data_interval_end date")


def test_known_error_is_dropped_only_when_the_table_covers_it(spark):
    bad = (corrections.ERROR_COURT, "RESIDUAL x", 9, dt.date(2017, 1, 1), dt.date(2017, 2, 1))
    other = ("j1", "RESIDUAL", 1, DEC, JAN)
    fine = (corrections.ERROR_COURT, "ORDINARIO", 1, JUL, AUG)
    early = ("j1", "RESIDUAL", 1, JUL, AUG)
    covered = corrections.without_known_error(error_rows(spark, bad, other, fine))
    assert sorted(r.iniciados for r in covered.collect()) == [1, 1]
    assert corrections.without_known_error(error_rows(spark, bad, early, fine)).count() == 3
    renamed = error_rows(spark, bad, other, fine).withColumnRenamed("iniciados", "n")
    assert corrections.without_known_error(renamed).count() == 3
    assert corrections.without_known_error(error_rows(spark, bad).filter("false")).count() == 0


def test_raw_rows_of_a_court(spark):
    rows = corrections.court_rows(log(spark, LOG), "jdocco01", "2018-07-01", "2018-08-01")
    assert sorted(r.id_submission for r in rows.collect()) == [7, 8, 9]


def test_officials_and_external_agent(spark):
    posts = spark.createDataFrame([("p1", "1"), ("p2", "2"), ("p3", "1"), ("p4", "9")],
                                  "puesto string, idagente string")
    persons = spark.createDataFrame(
        [("1", "JUEZ DE PAZ", "X", "Y"), ("2", "ESCRIBIENTE", "Z", "W")], schemas.PERSONNEL)
    assert sorted(r.puesto for r in staff.officials(posts, persons).collect()) == ["p1", "p3"]
    assert sorted(r.idagente for r in staff.official_ids(posts, persons).collect()) == ["0", "1", "1"]
    assert [r.idagente for r in staff.agents(persons, posts).collect()] == ["1", "2"]


# --- mediation and movements -----------------------------------------------------------------

def mediations(spark):
    rows = [("N", "cen1", JUL, AUG, "Acuerdo", 10), ("N", "cen1", JUL, AUG, "Acuerdo", 20),
            ("N", "cen1", AUG, SEP, "Sin acuerdo", 7), ("S", "cen2", JUL, AUG, "Otra", 5),
            ("S", "cen9", JUL, AUG, "Acuerdo", 5)]
    return spark.createDataFrame(
        rows, "tipo_circ string, iep string, data_interval_start date, data_interval_end date, "
              "tres_disc string, duracion int")


OUTCOMES = {"Acuerdo": "acuerdo", "Sin acuerdo": "sin_acuerdo"}


def test_mediation_by_month(spark):
    df = mediation.mediation_report(
        mediations(spark), population(spark, "cen1", "cen2"), "2018-07-01", "2018-09-01", OUTCOMES)
    got = {(r.circunscripcion, r.mes): (r.acuerdo, r.sin_acuerdo, r.otros, r.total) for r in df.collect()}
    assert got == {
        ("N", "julio"): (2, 0, 0, 2), ("N", "agosto"): (0, 1, 0, 1), ("N", "Total"): (2, 1, 0, 3),
        ("S", "julio"): (0, 0, 1, 1), ("S", "Total"): (0, 0, 1, 1),
    }


def test_mediation_cells_are_the_outcomes_that_occur(spark):
    df = mediation.mediation_report(mediations(spark), None, "2018-08-01", "2018-09-01")
    rows = rows_by(df, "circunscripcion")
    assert rows["N"].resultados == rows["Total"].resultados == {"Sin acuerdo": 1}
    assert rows["Total"].total == 1 and rows["Total"].otros == 0
    df = mediation.mediation_report(mediations(spark), None, "2018-07-01", "2018-09-01")
    cells = df.withColumn("resultados", F.map_entries("resultados"))  # in the cell's order
    got = {(r.circunscripcion, r.mes): ([tuple(e) for e in r.resultados], r.total) for r in cells.collect()}
    assert got == {
        ("N", "julio"): ([("Acuerdo", 2)], 2), ("N", "agosto"): ([("Sin acuerdo", 1)], 1),
        ("N", "Total"): ([("Acuerdo", 2), ("Sin acuerdo", 1)], 3),
        ("S", "julio"): ([("Acuerdo", 1), ("Otra", 1)], 2), ("S", "Total"): ([("Acuerdo", 1), ("Otra", 1)], 2),
    }


def test_mediation_with_more_outcomes_than_a_pivot_allows(spark):
    rows = spark.range(40_000).selectExpr(
        "'N' AS tipo_circ", "'cen1' AS iep", "DATE '2018-07-01' AS data_interval_start",
        "DATE '2018-08-01' AS data_interval_end",
        "CASE WHEN id >= 20 THEN lpad(CAST(id % 20000 AS STRING), 5, '0') END AS tres_disc", "1 AS duracion")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("open-pivot", "")
    df = mediation.mediation_report(rows, None, "2018-07-01", "2018-09-01", monthly=False)
    assert not tracker.getJobIdsForGroup("open-pivot")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = rows_by(df.withColumn("codigos", F.map_keys("resultados")), "circunscripcion")
    for r in (got["N"], got["Total"]):
        assert len(r.resultados) == 20_000 and r.codigos == sorted(r.resultados)
        assert (sum(r.resultados.values()), r.otros, r.total) == (39_980, 20, 40_000)
        assert r.resultados["00005"] == 1 and r.resultados["00025"] == 2


def test_mediation_single_month_and_range(spark):
    month = mediation.mediation_report(mediations(spark), None, "2018-07-01", "2018-08-01", OUTCOMES)
    assert rows_by(month, "circunscripcion")["Total"].total == 4
    whole = mediation.mediation_report(
        mediations(spark), None, "2018-07-01", "2018-09-01", OUTCOMES, monthly=False)
    assert rows_by(whole, "circunscripcion")["Total"].acuerdo == 3


def test_median_duration(spark):
    got = rows_by(mediation.mediation_indicators(mediations(spark), monthly=False), "tipo_circ", "tres_disc")
    assert got["N", "Acuerdo"].mediana_durac_inic_fin == 15.0
    assert got["N", "Acuerdo"].resultado == 2


MOVES = [
    ("PARANÁ", "JUZGADO DE FAMILIA 1", dt.date(2018, 7, 1), "violencia_familiar", 2),
    ("PARANÁ", "JUZGADO DE FAMILIA 1", dt.date(2018, 7, 31), "violencia_c-mujer", 1),
    ("PARANÁ", "JUZGADO DE FAMILIA 1", dt.date(2018, 8, 1), "violencia_c-mujer", 50),
    ("PARANÁ", "DEFENSORÍA DE FAMILIA", dt.date(2018, 7, 2), "violencia_familiar", 5),
    ("COLÓN", "juzgado de paz", dt.date(2018, 7, 2), "violencia_familiar", 4),
]


@pytest.mark.parametrize("code, want", [
    ("jdofam01", [("Paraná", "Juzgado De Familia 1", 2, 1, 3)]),
    ("jdopaz01", [("Colón", "Juzgado De Paz", 4, 0, 4)]),
])
def test_violence_movements(spark, code, want):
    df = movements.violence_movements(
        spark.createDataFrame(MOVES, schemas.MOVEMENTS), population(spark, code),
        "2018-07-01", "2018-08-01")
    assert [tuple(r) for r in df.collect()] == want


def test_movements_between_includes_both_days(spark):
    df = movements.movements_between(
        spark.createDataFrame(MOVES, schemas.MOVEMENTS), "2018-07-01", "2018-08-01")
    assert sum(r.cantidad for r in df.collect()) == 62


# --- summary and quality ---------------------------------------------------------------------

def test_budget_labels(spark):
    df = summary.category_labels(
        schemas.budget_table(spark), "concepto", ["anio"], "monto",
        summary.BUDGET_GROUPS, summary.BUDGET_DIGITS)
    assert [tuple(r) for r in df.collect()] == [("$10.7 millones", "$6.1 millones")]
    rows = summary.amounts_in_millions(schemas.budget_table(spark), ["concepto", "anio"], "monto")
    assert rows.count() == 6  # the amount of 0 is left out


def test_quality_index(spark):
    df = spark.createDataFrame([("a", "1", None), ("a", "x", "2"), ("b", None, "")],
                               "g string, n string, m string")
    rules = {"n_ok": quality.conforms(F.col("n")), "m_ok": quality.conforms(F.col("m"), optional=True)}
    got = rows_by(quality.quality_index(df, rules, ["g"]), "g")
    assert (got["a"].n_ok, got["a"].m_ok, got["a"].indice_calidad) == (0.5, 1.0, 0.75)
    assert (got["b"].n_ok, got["b"].m_ok, got["b"].filas) == (0.0, 1.0, 1)


def test_crowded_events_and_outside_interval(spark):
    df = spark.createDataFrame([("1", "S")] * 3 + [("2", "S")] * 2, "nro string, ta string")
    assert [tuple(r) for r in quality.crowded_events(df, ["nro", "ta"]).collect()] == [("1", "S", 3)]
    dated = spark.createDataFrame(
        [(1, "30/06/2018", JUL, AUG), (2, "01/07/2018", JUL, AUG), (3, "01/08/2018", JUL, AUG),
         (4, None, JUL, AUG)],
        "i int, d string, data_interval_start date, data_interval_end date")
    assert [r.i for r in quality.outside_interval(dated, "d").collect()] == [1, 3]


def test_share_within_business_days(spark):
    rows = [("c", "02/07/2018", "13/07/2018"), ("c", "02/07/2018", "16/07/2018"), ("c", None, "16/07/2018")]
    df = spark.createDataFrame(rows, "iep string, fdesp string, fres string")
    got = quality.share_within_business_days(df, ["iep"], 10).first()
    assert (got.resoluciones, got.en_termino, got.proporcion) == (2, 1, 0.5)
