from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casetally.functions import codes, dates, text
from casetally.functions.classify import RULES, classified_counts, classify
from casetally.operators import scope
from casetally.operators.cells import entries_in_cells
from casetally.operators.columns import columns_like, printed, rename_like
from casetally.operators.latest import latest_per_key
from casetally.operators.ordering import calendar_order, in_report_order
from casetally.operators.reshape import widen
from casetally.operators.totals import row_total, with_grand_total, with_total_rows
from court_fixtures import COURTS, courts


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_dates_parse_leniently(spark):
    df = spark.createDataFrame([("31/02/2019",), ("01/03/2019",), ("",), (None,)], "d string")
    got = [r[0] for r in df.select(dates.date_of(df, "d")).collect()]
    assert got == [None, dt.date(2019, 3, 1), None, None]


def test_typed_dates_are_not_parsed(spark):
    df = spark.sql("select date'2019-03-01' as d, timestamp'2019-03-01 10:00:00' as t")
    got = df.select(dates.date_of(df, "d"), dates.date_of(df, "t")).first()
    assert tuple(got) == (dt.date(2019, 3, 1), dt.date(2019, 3, 1))


@pytest.mark.parametrize("start, end, label", [
    ("2018-07-01", "2018-08-01", "julio 2018"),
    ("2018-12-01", "2019-01-01", "diciembre 2018"),
    ("2018-01-01", "2018-07-01", "primer semestre 2018"),
    ("2018-07-01", "2019-01-01", "segundo semestre 2018"),
    ("2018-03-01", "2018-09-01", "marzo - agosto 2018"),
    ("2018-02-01", "2018-05-01", "febrero - abril 2018"),
    ("2018-01-01", "2019-01-01", "anual 2018"),
    ("2017-05-01", "2019-03-01", "mayo 2017 - febrero 2019"),
    ("2017-01-01", "2019-01-01", "enero 2017 - diciembre 2019"),
])
def test_period_labels(spark, start, end, label):
    assert one(spark, dates.period_label(dates.day(start), dates.day(end))) == (label,)


def test_single_month_over_a_year_end():
    assert dates.covers_one_month("2018-12-01", "2019-01-01")
    assert not dates.covers_one_month("2017-07-01", "2018-08-01")


def test_business_days_match_a_day_by_day_count(spark):
    rng = random.Random(7)
    holidays = {dt.date(2018, 7, 9), dt.date(2018, 7, 14), dt.date(2018, 12, 25)}
    pairs = [(dt.date(2018, 1, 1) + dt.timedelta(rng.randrange(400)), rng.randrange(-5, 120))
             for _ in range(300)]
    rows = [(a, a + dt.timedelta(n)) for a, n in pairs]

    def by_hand(a, b):
        return sum((a + dt.timedelta(i)).weekday() < 5 and a + dt.timedelta(i) not in holidays
                   for i in range(1, (b - a).days + 1))

    df = spark.createDataFrame(rows, "a date, b date")
    got = df.select("a", "b", dates.business_days(F.col("a"), F.col("b"), sorted(holidays)).alias("n"))
    for r in got.collect():
        if r.b >= r.a:
            assert r.n == by_hand(r.a, r.b), r


def test_title_case(spark):
    got = one(spark, text.title_case(F.lit("JUZGADO de san-josé (ñandubay) D'ANGELO")))
    assert got == ("Juzgado De San-José (Ñandubay) D'angelo",)


@pytest.mark.parametrize("part, whole, label", [
    (1, 8, "12 %"), (3, 8, "38 %"), (0, 3, "0 %"), (3, 3, "100 %"), (1, 0, None), (None, 3, None),
])
def test_percent_rounds_half_to_even(spark, part, whole, label):
    got = one(spark, text.percent_label(F.lit(part).cast("bigint"), F.lit(whole).cast("bigint")))
    assert got == (label,)


def test_code_lookup(spark):
    table = {"1": "uno", "2": "dos"}
    df = spark.createDataFrame([("1",), ("9",), (None,)], "c string")
    got = [tuple(r) for r in df.select(
        codes.label(F.col("c"), table, "x"), codes.remap(F.col("c"), table),
        codes.overridden(F.lit("base"), F.col("c"), table)).collect()]
    assert got == [("uno", "uno", "uno"), ("x", "9", "base"), ("x", None, "base")]


def test_merged_courts_have_no_chains():
    assert not set(codes.MERGED_COURTS) & set(codes.MERGED_COURTS.values())


@pytest.mark.parametrize("matter, name, group", [
    ("civil", "monitorio desalojo", "MONITORIOS"),
    ("civil", "SUMARISIMO", "SUMARISIMO"),
    ("civil", "UN SUMARIO", None),
    ("civil", "desalojo", "DESALOJO"),
    ("civil", None, "OTROS"),
    ("civil", "VIOLENCIA FAMILIAR", None),
    ("familia", "VIOLENCIA FAMILIAR", "VIOLENCIA FAMILIAR"),
    ("familia", "MEDIDA DE PROTECCION", "MEDIDAS"),
    ("laboral", "PROCESO MONITORIO", None),
    ("laboral", "APELACION DICTAMEN", "APELACION COMISION MEDICA"),
    ("pazproc", "LEY LOPJ", None),
    ("paztram", "FORMULARIO 08", "FORMULARIOS (ANSES,DDJJ,LEY3011,etc)"),
    ("paztram", "OFICIO", "OTROS"),
    ("ecq", "PEDIDO DE QUIEBRA", "CONCURSOS/QUIEBRAS"),
])
def test_procedure_groups(spark, matter, name, group):
    df = spark.createDataFrame([(name,)], "tproc string")
    got = [r.gtproc_forma for r in classify(df, matter).collect()]
    assert got == ([group] if group else [])


def test_unknown_matter_changes_nothing(spark):
    df = spark.createDataFrame([("abc",)], "tproc string")
    assert classify(df, "penal").collect() == df.collect()


def test_counts_per_group_equal_classified_rows(spark):
    names = ["ordinario", "Ordinario x", "MONITORIO", "oficio", None, "cobro de pesos"]
    df = spark.createDataFrame([(f"c{i % 2}", n) for i, n in enumerate(names * 5)],
                               "organismo string, tproc string")
    for matter in RULES:
        want = sorted(
            (r.organismo, r.gtproc_forma, r["count"]) for r in
            classify(df, matter).groupBy("organismo", "gtproc_forma").count().collect())
        got = sorted(tuple(r) for r in classified_counts(df, matter, ("organismo",)).collect())
        assert got == want


def test_patterns_run_once_per_row_and_name(spark):
    df = spark.createDataFrame([("c", "x")], "organismo string, tproc string")
    for plan in (classify(df, "paztram"), classified_counts(df, "paztram", ("organismo",))):
        physical = plan._jdf.queryExecution().sparkPlan().toString()
        assert physical.count("RUBRICA DE LIBROS, ") + physical.count("RUBRICA DE LIBROS)") == 1


def test_total_rows_with_null_district(spark):
    df = spark.createDataFrame(
        [("N", "a", 1, 2), ("N", "b", 3, None), (None, "c", 5, None)],
        "d string, o string, x long, y long")
    got = {(r.d, r.o, r.is_total): (r.x, r.y)
           for r in with_total_rows(df, ["d", "o"], ["x", "y"], group=["d"]).collect()}
    assert got == {
        ("N", "a", False): (1, 2), ("N", "b", False): (3, None), (None, "c", False): (5, None),
        ("N", None, True): (4, 2), (None, None, True): (5, 0),
    }


def test_grand_total_of_an_empty_table(spark):
    df = spark.createDataFrame([], "o string, x long")
    assert [tuple(r) for r in with_grand_total(df, ["x"]).collect()] == [(None, 0, True)]


def test_row_total_ignores_null(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a long, b long")
    assert [r[0] for r in df.select(row_total("a", "b")).collect()] == [1, 5]


def test_widen_keeps_unlisted_values(spark):
    df = spark.createDataFrame([("k", "a"), ("k", "a"), ("k", "z"), ("k", None), ("m", "b")],
                               "k string, v string")
    got = {tuple(r) for r in widen(df, ["k"], "v", {"a": "a", "b": "b"}, rest="otros").collect()}
    assert got == {("k", 2, 0, 2), ("m", 0, 1, 0)}


def test_latest_keeps_ties_and_null_keys(spark):
    rows = [("1", "x", 1), ("1", "x", 3), ("1", "x", 3), ("1", None, 2), ("1", None, 5),
            (None, None, 1), ("2", "y", None)]
    df = spark.createDataFrame(rows, "n string, c string, d int")
    got = sorted(map(str, latest_per_key(df, ["n", "c"], "d").collect()))
    want = [("1", "x", 3), ("1", "x", 3), ("1", None, 5), (None, None, 1)]
    assert got == sorted(str(r) for r in spark.createDataFrame(want, df.schema).collect())


def test_latest_of_a_hot_key(spark):
    """A third of the rows share a key; thresholds so low that Spark splits it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
            F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id") % 5).alias("d"),
            F.sha2(F.col("id").cast("string"), 256).alias("x"),
        )
        latest = latest_per_key(df, ["k"], "d")
        rows = latest.collect()
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 60000 and sum(r.k == -1 for r in rows) == 20000
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("block", [4, 64, 100_000])
def test_cells_hold_whole_lists_in_order(spark, block):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(4), i, f"e{i}" if i % 9 else None)
            for i in rng.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "k string, p int, i long, e string")
    cells = entries_in_cells(df, ["k"], "p", "i", "e", per_cell=16, block=block).collect()
    for key in ("a", "b", None):
        mine = sorted((c for c in cells if c.k == key), key=lambda c: c.part)
        assert [c.part for c in mine] == list(range(1, len(mine) + 1))
        assert all(c.entry_count == 16 for c in mine[:-1])
        want = [e for _, _, e in sorted((p, i, e or "?") for k, p, i, e in rows if k == key)]
        assert ", ".join(c.entries for c in mine) == ", ".join(want)
        assert sum(c.entry_count for c in mine) == len(want)


@pytest.mark.parametrize("block", [4, 16, 100_000])
def test_copies_in_cells_are_all_listed(spark, block):
    """One entry makes up a third of the rows and fills several cells."""
    rows = [("a", 0, 7, "x")] * 40 + [("a", i % 2, 100 + i, f"e{i}") for i in range(80)]
    df = spark.createDataFrame(rows, "k string, p int, i long, e string")
    cells = sorted(entries_in_cells(df, ["k"], "p", "i", "e", per_cell=9, block=block).collect(),
                   key=lambda c: c.part)
    want = [e for _, _, e in sorted((p, i, e) for _, p, i, e in rows)]
    assert ", ".join(c.entries for c in cells) == ", ".join(want)
    assert [c.entry_count for c in cells] == [9] * 13 + [3]


def test_no_entries_make_no_cells(spark):
    df = spark.createDataFrame([], "k string, p int, i long, e string")
    assert entries_in_cells(df, ["k"], "p", "i", "e", 10).collect() == []


def test_select_courts(spark):
    directory = courts(spark)

    def codes_of(*args, **kw):
        return {r.organismo for r in scope.select_courts(directory, *args, **kw).collect()}

    assert codes_of(["Civil"], [1], district="Norte|Sur") == {"jdocco01", "jdocco02"}
    assert codes_of(["civil"], [1, 2], district="Norte|Sur") == {"jdocco01", "jdocco02", "camcco01"}
    assert codes_of(["civil"], [2], district="Sur") == {"camcco01"}
    assert codes_of(["paz"], [1, 3], district="Sur") == {"jdopaz01"}
    assert codes_of(["civil"], [1]) == set()  # none of the default districts
    assert scope._codes_of(["penal", "pej"]) == "pen|pej"
    assert scope._codes_of(["PME"]) == "oma|equ"


def test_enforcement_courts_are_found_by_matter(spark):
    rows = [("jdo1", "a", "Colón", "eje"), ("jdo2", "b", "Colón", "cco")]
    directory = spark.createDataFrame(rows, courts(spark).schema)
    got = scope.select_courts(directory, ["ecq"], [1]).collect()
    assert [r.organismo for r in got] == ["jdo1"]


def test_optional_columns_and_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "mes int, res_luego1venc int, x int")
    assert columns_like(df, "mes") == ["mes"] and columns_like(df, "fecha") == []
    assert rename_like(df, "res_luego1venc", "luego_1er_venc").columns == ["mes", "luego_1er_venc", "x"]


def test_printed_totals_are_labelled(spark):
    df = spark.createDataFrame(
        [("N", "a", 1, False), ("N", None, 1, True)],
        "circunscripcion string, organismo_descripcion string, cantidad int, is_total boolean")
    got = printed(df, ("circunscripcion", "organismo_descripcion"))
    assert got.columns == ["circunscripción", "organismo", "cantidad"]
    assert {tuple(r) for r in got.collect()} == {("N", "a", 1), ("Total", "-", 1)}


def test_calendar_order(spark):
    df = spark.createDataFrame([("abril", 4, False), ("Total", None, True), ("enero", 1, False),
                                ("diciembre", 12, False)], "mes string, m int, t boolean")
    df = df.withColumn("k", calendar_order(F.col("m"), F.col("t")))
    assert [r.mes for r in in_report_order(df, "k").collect()] == ["enero", "abril", "diciembre", "Total"]


def test_fixture_courts_are_invented():
    assert all(len(c) == 4 for c in COURTS)


def test_partitions_grow_with_the_shuffle():
    from casetally.session import partitions_for

    assert partitions_for(1 << 20) == 200
    assert partitions_for(10 << 40) == 40960
