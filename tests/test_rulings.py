from __future__ import annotations

import datetime as dt

import pytest

from casetally.operators.columns import printed
from casetally.plans import rulings
from casetally.plans.by_type import (
    CIVIL_THIRD_TYPES, CIVIL_TYPES, ENFORCEMENT_TYPES, rulings_by_type,
)
from casetally.plans.case_listing import case_listing
from casetally.plans.rulings import pending_by_month, ruling_counts, rulings_report
from court_fixtures import (
    ALL_COURTS, AUG, DEC, JAN, JUL, SEP, cases, courts, population, rows_by, ruling,
)

RANGE = ("2018-07-01", "2018-09-01")


def report(spark, settings=rulings.CIVIL, **options):
    return rulings_report(
        cases(spark), population(spark, *ALL_COURTS), courts(spark), *RANGE, settings, **options
    )


def test_indicators_by_month(spark):
    got = rows_by(report(spark), "organismo", "mes")
    july = got["jdocco01", "julio"]
    assert (july.causas_resueltas, july.a_termino, july.luego_1er_venc, july.luego_2do_venc) == (4, 1, 2, 1)
    assert (july.sentencias, july.autos, july.sin_clasif) == (2, 1, 1)
    assert july.causas_adespacho == 6  # the impossible date is in no month
    assert july.resol_vencidas == "75 %"
    assert july.mes_orden == 7 and not july.is_total
    assert got["jdocco01", "agosto"].causas_adespacho == 1
    total = got["jdocco01", "Total"]
    assert (total.causas_resueltas, total.causas_adespacho, total.is_total) == (5, 7, True)
    assert total.mes_orden == 13 and total.organismo_descripcion == "Juzgado Civil 1"


def test_courts_without_rulings_are_hidden_but_stay_in_totals(spark):
    got = rows_by(report(spark, monthly=False), "organismo")
    assert "jdocco02" not in got
    grand = got[None]
    assert grand.circunscripcion == "Total" and grand.is_total
    assert grand.causas_adespacho == 11  # with the court that is hidden
    assert grand.causas_resueltas == 8


def test_court_missing_from_directory_keeps_its_own_total(spark):
    got = rows_by(report(spark), "organismo", "mes")
    row = got["jdofam0101con", "Total"]
    assert row.circunscripcion is None and row.is_total and row.causas_resueltas == 2


def test_no_grand_total_for_peace_courts_over_a_range(spark):
    df = report(spark, rulings.PEACE, monthly=False)
    assert df.filter("is_total").count() == 0


def test_single_month_has_one_grand_total(spark):
    df = rulings_report(
        cases(spark), population(spark, *ALL_COURTS), courts(spark), "2018-07-01", "2018-08-01"
    )
    totals = df.filter("is_total").collect()
    assert len(totals) == 1
    assert totals[0].circunscripcion == "Total" and totals[0].mes == "Total"
    assert totals[0].causas_resueltas == 7


def test_exclusion_drops_null_procedures_and_remap_is_for_rulings_only(spark):
    got = rows_by(report(spark, rulings.FAMILY, monthly=False), "organismo")
    assert "jdofam0101con" not in got
    merged = got["jdofam0100con"]
    assert merged.causas_resueltas == 1  # the violence row and the NULL procedure are out
    assert merged.causas_adespacho is None  # pending cases stay with the old code


def test_merged_courts_add_up_by_month(spark):
    rows = [
        ruling("jdofam0101con", JUL, AUG, "07/07/2018", "08/07/2018", "10/07/2018", "20/07/2018"),
        ruling("jdofam0100con", JUL, AUG, "07/07/2018", "12/07/2018", "10/07/2018", "20/07/2018"),
    ]
    got = ruling_counts(
        cases(spark, rows), population(spark, *ALL_COURTS), *RANGE, rulings.FAMILY
    ).collect()
    assert len(got) == 1
    assert (got[0].organismo, got[0].causas_resueltas, got[0].a_termino, got[0].luego_1er_venc,
            got[0].causas_adespacho) == ("jdofam0100con", 2, 1, 1, 1)


def test_population_limits_the_courts(spark):
    df = rulings_report(
        cases(spark), population(spark, "jdocco01"), courts(spark), *RANGE, monthly=False
    )
    assert {r.organismo for r in df.collect()} == {"jdocco01", None}


@pytest.mark.parametrize("monthly", [True, False])
def test_one_deadline(spark, monthly):
    one = cases(spark).withColumnRenamed("fvenc1", "fvenc").drop("fvenc2")
    df = rulings_report(
        one, population(spark, *ALL_COURTS), courts(spark), *RANGE, rulings.LABOUR, monthly
    )
    assert "luego_2do_venc" not in df.columns
    row = [r for r in df.collect() if r.organismo == "jdocco01" and (not monthly or r.mes == "julio")]
    assert row[0].luego_1er_venc == 3


def test_appeal_counts_ignore_null(spark):
    from pyspark.sql import functions as F

    one = cases(spark).withColumnRenamed("fvenc1", "fvenc").withColumn(
        "recirc", F.when(F.col("as") == "A", True).when(F.col("as") == "s", False)
    )
    got = rows_by(
        ruling_counts(one, population(spark, "jdocco01"), *RANGE, rulings.LABOUR_APPEAL, False),
        "organismo",
    )
    assert got["jdocco01"].luego_1er_venc == 3  # with the row whose flag is unknown


def test_higher_courts_use_their_own_dispatch_column(spark):
    higher = cases(spark).withColumnRenamed("fdesp", "fdesp1")
    got = rows_by(
        ruling_counts(higher, population(spark, "jdocco01"), *RANGE), "organismo", "mes_inicio"
    )
    assert got["jdocco01", JUL].causas_adespacho == 6


def test_december_and_other_years_do_not_mix(spark):
    rows = [
        ruling("jdocco01", DEC, JAN, "05/12/2018", "10/12/2018", "20/12/2018", "30/12/2018"),
        ruling("jdocco01", DEC, JAN, "05/12/2017", "11/12/2018", "20/12/2018", "30/12/2018"),
        ruling("jdocco01", JAN, dt.date(2019, 2, 1), "02/01/2019", "03/01/2019", "20/01/2019", "30/01/2019"),
    ]
    got = rows_by(
        ruling_counts(cases(spark, rows), population(spark, "jdocco01"), "2018-12-01", "2019-02-01"),
        "mes_inicio",
    )
    assert got[DEC].causas_adespacho == 1 and got[DEC].causas_resueltas == 2
    assert got[JAN].causas_adespacho == 1


def test_pending_by_month(spark):
    got = rows_by(
        pending_by_month(cases(spark), population(spark, "jdocco01", "jdocco02"), *RANGE),
        "iep", "mes",
    )
    assert {k: r.causas_adespacho for k, r in got.items()} == {
        ("jdocco01", "julio"): 6, ("jdocco01", "agosto"): 1, ("jdocco02", "julio"): 1,
    }


def test_totals_equal_the_sum_of_their_rows(spark):
    rows = report(spark).collect()
    for court in {r.organismo for r in rows}:
        mine = [r for r in rows if r.organismo == court]
        total = [r for r in mine if r.is_total][0]
        for c in ("causas_resueltas", "a_termino", "luego_1er_venc", "luego_2do_venc"):
            assert total[c] == sum(r[c] for r in mine if not r.is_total)
        assert total.a_termino + total.luego_1er_venc + total.luego_2do_venc == total.causas_resueltas


def test_printed_headers(spark):
    df = printed(report(spark, closing_date=True))
    assert df.columns == [
        "circunscripción", "organismo", "mes", "causas a despacho del mes", "causas resueltas",
        "a termino", "luego 1er Vencim", "luego 2do Vencim", "sentencias", "autos", "sin clasif",
        "resol vencidas", "fecha",
    ]
    dates = {r.mes: r.fecha for r in df.collect() if r.organismo == "Juzgado Civil 1"}
    assert dates == {"julio": dt.date(2018, 7, 31), "agosto": dt.date(2018, 8, 31), "Total": None}


def by_type(spark, settings, rows):
    df = rulings_by_type(
        cases(spark, rows), population(spark, "jdocco01"), courts(spark), *RANGE, settings
    )
    return {r[2]: r.cantidad for r in df.collect()}


def test_rulings_by_type_and_missing_codes(spark):
    def row(tres, as_="S", fres="10/07/2018"):
        return ruling("jdocco01", JUL, AUG, "02/07/2018", fres, "10/07/2018", "20/07/2018", tres, as_)

    rows = [row("1"), row("1", "s"), row(None), row("99"), row("0"), row("2", "A"), row("31"),
            row("3", fres="01/08/2018"), row("3", fres=None)]
    assert by_type(spark, CIVIL_TYPES, rows) == {
        "Conciliación": 2, "Sent.Definitiva": 2, "Sucesorio:Declarat.Herederos": 1, None: 5,
    }
    assert by_type(spark, CIVIL_THIRD_TYPES, rows) == {"RIL Admisible": 2, "sin dato": 2, None: 4}


def test_bankruptcy_class_replaces_the_label(spark):
    def row(tres, as_):
        return ruling("jdocco01", JUL, AUG, "02/07/2018", "10/07/2018", "10/07/2018", "20/07/2018", tres, as_)

    rows = [row("10", "S"), row("1", "s3"), row("2", "S8"), row(None, "S5"), row("77", "s")]
    assert by_type(spark, ENFORCEMENT_TYPES, rows) == {
        "Sentencia": 2, "Sent_Quiebra": 1, "Sent_Verific_más_de_20_verif": 1, None: 4,
    }


def listing(spark, rows, codes=("jdocco01",), **options):
    df = case_listing(
        cases(spark, rows), population(spark, *codes), courts(spark), *RANGE, **{"total": True, **options}
    )
    return [r for r in df.collect() if not r.is_total], [r for r in df.collect() if r.is_total]


def marks(r):
    return (r.med_mej_prov, r.atermino, r.res_luego1venc, r.res_luego2venc, r.inconsistencia2venc)


def test_case_marks(spark):
    def row(fres, due1="10/07/2018", due2="20/07/2018", tres="1", nro="1"):
        return ruling("jdocco01", JUL, AUG, "02/07/2018", fres, due1, due2, tres, nro=nro)

    rows, total = listing(spark, [
        row("10/07/2018", nro="on"), row("11/07/2018", nro="first"), row("21/07/2018", nro="second"),
        row("09/07/2018", tres="0", nro="interim"), row("15/07/2018", "20/07/2018", "12/07/2018", nro="odd"),
        row("10/07/2018", due1=None, nro="nodue"), row("01/08/2018", nro="outside"), row(None, nro="open"),
    ])
    got = {r.nro: marks(r) for r in rows}
    assert got == {
        "on": (None, 1, None, None, None), "first": (None, None, 1, None, None),
        "second": (None, None, None, 1, None), "interim": (1, None, None, None, None),
        "odd": (None, 1, None, 1, 1), "nodue": (None, None, None, None, None),
        "outside": (None, None, None, None, None),
    }
    assert [marks(r) for r in total] == [(1, 2, 1, 2, 1)]
    assert rows[0].circunscripcion == "Norte" and rows[0].mes == "julio"


def test_higher_courts_have_one_deadline(spark):
    rows = [ruling("salcco01", JUL, AUG, "02/07/2018", "25/07/2018", "10/07/2018", "20/07/2018")]
    got, _ = listing(spark, rows, codes=("salcco01",))
    assert marks(got[0]) == (None, None, 1, None, None)


def test_one_deadline_listing_is_never_inconsistent(spark):
    one = cases(spark).withColumnRenamed("fvenc1", "fvenc").drop("fvenc2")
    df = case_listing(one, population(spark, *ALL_COURTS), courts(spark), *RANGE, due=("fvenc",), total=True)
    assert "res_luego2venc" not in df.columns
    rows = df.collect()
    assert all(r.inconsistencia2venc is None for r in rows if not r.is_total)
    assert [r.inconsistencia2venc for r in rows if r.is_total] == [0]


def test_listing_follows_merged_courts(spark):
    rows = [ruling("jdofam0101con", JUL, AUG, "02/07/2018", "05/07/2018", "10/07/2018", "20/07/2018")]
    directory = courts(spark).union(
        spark.createDataFrame([("jdofam0100con", "Familia", "Este", "fam")], courts(spark).schema)
    )
    df = case_listing(cases(spark, rows), population(spark, "jdofam0101con"), directory, *RANGE, total=True)
    assert df.filter("not is_total").first().organismo_descripcion == "Familia"


def test_interval_is_containment(spark):
    from casetally.operators.scope import in_interval

    rows = [ruling("jdocco01", a, b, None, None, None, None)
            for a, b in ((JUL, AUG), (AUG, SEP), (JUL, SEP), (SEP, dt.date(2018, 10, 1)))]
    assert in_interval(cases(spark, rows), *RANGE).count() == 3
