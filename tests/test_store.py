"""Stored operations, counts and histograms, listings in quarantine, versions, calendars."""

from __future__ import annotations

import datetime as dt
import os
import pathlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from casetally import schemas
from casetally.plans import calendar, indicators, mediation, reallocation, rulings
from casetally.plans.versions import in_force, validity
from casetally.sources import readers, store
from casetally.sources import starschema as star
from casetally.sources.hearings import judged, quarantined
from casetally.store_queries import ORACLE, QUERIES
from compare import differences, duckdb_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, name):
    assert set(QUERIES) == set(ORACLE) and name in entry_points.queries() and name in entry_points.oracle_sql()
    con = duckdb_connection(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    physical = df._jdf.queryExecution().sparkPlan().toString()
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Python|InPandas|Arrow", physical)
    assert differences(df, con, ORACLE[name]) == []
    con.close()


# --- replacing months -----------------------------------------------------------------------

SCHEMA = "iep string, data_interval_start date, data_interval_end date, nro long, tres string"
MONTHS = [dt.date(2018, m, 1) for m in (6, 7, 8, 9)]


def stored_cases(spark, path):
    rows = [(c, m, MONTHS[i + 1], 10 * i + k, "1") for i, m in enumerate(MONTHS[:3]) for c in "abc" for k in range(4)]
    rows.append((None, MONTHS[1], MONTHS[2], 99, None))
    readers.write_operation(spark.createDataFrame(rows, SCHEMA).withColumn("operation", F.lit("OP")), path)
    return rows


def all_stored(spark, path):
    df = spark.createDataFrame([], SCHEMA)
    return rows_of(readers.read_operation(spark, path, "OP", df.schema))


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


def test_a_month_is_replaced_once_however_often(spark, tmp_path):
    path = str(tmp_path / "ops")
    rows = stored_cases(spark, path)
    before = files(path)
    new = [("a", MONTHS[1], MONTHS[2], 500, "9"), ("a", MONTHS[1], MONTHS[2], 501, None)]
    courts = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "iep string")  # b has nothing now
    want = Counter([r for r in rows if not (r[1] == MONTHS[1] and r[0] in ("a", "b"))] + new)
    for _ in range(3):
        store.replace_month(spark.createDataFrame(new, SCHEMA), path, "OP", "2018-07-01", courts)
        assert all_stored(spark, path) == want
    after = files(path)
    kept = {p for p in before if "2018-07-01" not in p}
    assert kept and all(after[p] == before[p] for p in kept)  # other months are not touched


def test_a_month_can_be_emptied_and_come_new(spark, tmp_path):
    path = str(tmp_path / "ops")
    rows = stored_cases(spark, path)
    courts = spark.createDataFrame([("a",), ("b",), ("c",)], "iep string")
    none = spark.createDataFrame([], SCHEMA)
    for _ in range(2):
        store.replace_month(none, path, "OP", MONTHS[0], courts)
        assert all_stored(spark, path) == Counter(r for r in rows if r[1] != MONTHS[0])
    new = [("b", MONTHS[3], dt.date(2018, 10, 1), 1, "1")]
    store.replace_month(spark.createDataFrame(new, SCHEMA), path, "OP", MONTHS[3], courts)
    store.replace_month(spark.createDataFrame([r for r in rows if r[1] == MONTHS[0]], SCHEMA), path, "OP", MONTHS[0], courts)
    assert all_stored(spark, path) == Counter(rows + new)


@pytest.mark.parametrize("row", [("a", MONTHS[2], MONTHS[3], 1, "1"), ("z", MONTHS[1], MONTHS[2], 1, "1"),
                                 ("a", None, MONTHS[2], 1, "1"), (None, MONTHS[1], MONTHS[2], 1, "1")])
def test_rows_that_do_not_belong_are_refused(spark, tmp_path, row):
    path = str(tmp_path / "ops")
    rows = stored_cases(spark, path)
    with pytest.raises(Exception, match="not a row of the month"):
        store.replace_month(spark.createDataFrame([row], SCHEMA), path, "OP", MONTHS[1],
                            spark.createDataFrame([("a",)], "iep string"))
    assert all_stored(spark, path) == Counter(rows)


def test_only_the_months_of_the_table_are_read(spark, tmp_path):
    """Months are known when the query runs; the others' files are not even opened."""
    path = str(tmp_path / "ops")
    rows = stored_cases(spark, path)
    for p in pathlib.Path(path).rglob("*.parquet"):
        if "2018-06-01" in str(p) or "2018-08-01" in str(p):
            p.write_bytes(b"no parquet")
    spark.createDataFrame([(MONTHS[1], 5), (MONTHS[1], 7), (MONTHS[0], 0)], "data_interval_start date, n int").write.parquet(
        str(tmp_path / "months"))
    months = spark.read.parquet(str(tmp_path / "months")).filter("n > 2")
    found = store.read_months(spark, path, "OP", spark.createDataFrame([], SCHEMA).schema, months)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    assert rows_of(found) == Counter(r for r in rows if r[1] == MONTHS[1])


# --- stored counts and histograms -------------------------------------------------------------

@needs_tables
@pytest.mark.parametrize("settings, monthly", [
    (rulings.CIVIL, True), (rulings.CIVIL, False), (rulings.LABOUR_APPEAL, True), (rulings.FAMILY, True),
    (rulings.PEACE_23, False), (rulings.ADMINISTRATIVE, True),
])
def test_reports_from_stored_counts(spark, settings, monthly):
    cases = star.court_cases(spark, SF_DIR, procedures=True)
    courts, population = star.court_directory(spark, SF_DIR), star.population(spark, SF_DIR, star.LEFT_OUT)
    kept = rulings.stored_counts(cases, settings)
    for start, end in (("1996-02-01", "1997-08-01"), ("1997-03-01", "1997-04-01")):
        want = rulings.rulings_report(cases, population, courts, start, end, settings, monthly, True)
        got = rulings.rulings_report_from(kept, population, courts, start, end, settings, monthly, True)
        assert got.columns == want.columns and rows_of(got) == rows_of(want)
    with pytest.raises(ValueError):
        rulings.ruling_counts_from(kept, population, "1997-01-01", "1997-02-15")


def test_histograms_add_up(spark):
    r = random.Random(1)
    rows = [("N", "x" if r.random() < 0.5 else None, MONTHS[m], MONTHS[m + 1], r.choice([None, 1, 2, 3, 50, 700]))
            for _ in range(400) for m in (r.randrange(3),)]
    df = spark.createDataFrame(
        rows, "tipo_circ string, tres_disc string, data_interval_start date, data_interval_end date, duracion int")
    days = mediation.duration_days(df)
    for monthly in (True, False):
        assert rows_of(mediation.indicators_of_days(days, monthly)) == rows_of(mediation.mediation_indicators(df, monthly))
    assert days.count() <= 3 * 2 * 6


# --- quarantine -------------------------------------------------------------------------------

def test_every_row_is_typed_or_rejected(spark, tmp_path):
    good = ["7", "A c/ B", "ORD", "2", "01/02/2019", "45", "30", "05/02/2019", "", "", "", "1", "R", "3", "", "1", "0", "A$1$X$Y%"]

    def line(**changed):
        own = dict(zip(schemas.HEARING_COLUMNS, good, strict=True)) | changed
        return "\t".join(own[c] for c in schemas.HEARING_COLUMNS)

    lines = {
        line(): [], line(nro="8", duracb="", finicio="", justiables=""): [], line(nro=""): ["numero:nro"],
        line(nro="99999999999999999999"): ["numero:nro"], line(asis="2.5", fea="30/02/2019"): ["numero:asis", "fecha:fea"],
        line(finicio="2019-02-01"): ["fecha:finicio"], line(justiables="A$1%"): ["partes"],
        line(justiables='"A ""b""$1$X$%C$$$%"'): [], line() + "\tmore": ["campos"], "9\tshort": ["campos"],
        line(duracm="-1", duracb=" "): ["numero:duracm"], line(asis="7777777777"): ["numero:asis"],
    }
    path = tmp_path / "listing"
    path.mkdir()
    (path / "a.txt").write_bytes(("\r\n".join(["\t".join(schemas.HEARING_COLUMNS), *lines]) + "\r\n").encode())
    raw = readers.read_hearings(spark, str(path))
    found = Counter(tuple(r.errores) for r in judged(raw).select("errores").collect())
    assert found == Counter(tuple(e) for e in lines.values())
    typed, rejected = quarantined(raw)
    assert (typed.count(), rejected.count()) == (3, 9) and dict(typed.dtypes)["finicio"] == "date"
    assert Counter(r.error for r in rejected.select("error").collect()) == Counter(e[0] for e in lines.values() if e)
    assert {r[0] for r in rejected.filter("error = 'campos'").select(schemas.CORRUPT).collect()} == {
        k for k, e in lines.items() if e == ["campos"]}


def test_a_listing_comes_back_as_written(spark, tmp_path):
    rows = [tuple(f'{c} "{i}"' if i or c == "nro" else None for c in schemas.HEARING_COLUMNS) for i in range(3)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in schemas.HEARING_COLUMNS))
    readers.hearing_lines(df).write.text(str(tmp_path / "out"))
    back = readers.read_hearings(spark, str(tmp_path / "out"), header=False)
    assert rows_of(back) == Counter((*r, None) for r in rows)


# --- versions ---------------------------------------------------------------------------------

def test_versions_in_force(spark):
    r = random.Random(5)
    log = [(r.choice("abc") if r.random() < 0.9 else None, i, f"2018-0{r.randint(1, 9)}-{r.randint(10, 28)} {r.choice(['08:00:00', '09:30:00'])}"
            if r.random() < 0.95 else r.choice([None, "soon"])) for i in range(300)]
    days = [dt.date(2018, 3, 1), dt.date(2018, 3, 15), dt.date(2018, 3, 16), dt.date(2018, 8, 31), dt.date(2019, 1, 1), None]
    want = Counter()
    for day in days[:-1]:
        best = defaultdict(tuple)
        for key, i, at in log:
            if at and at != "soon" and at[:10] <= str(day):
                best[key] = max(best[key], (at, i))
        want.update((key, day, x[1]) for key, x in best.items())
    df = spark.createDataFrame(log, "iep string, id_submission long, datetime string").withColumn("day", F.lit("own"))
    calendar_of = spark.createDataFrame([(d,) for d in days + days[:2]], "day date")
    assert rows_of(in_force(df, calendar_of, ["iep"])) == want
    spans = validity(df, calendar_of, ["iep"]).collect()
    assert all(s.valid_from <= s.valid_to for s in spans) and len(spans) <= 4 * 5
    assert in_force(df.limit(0), calendar_of, ["iep"]).count() == 0
    assert in_force(df, calendar_of.limit(0), ["iep"]).count() == 0


def test_a_court_with_most_versions_weighs_no_more_than_the_days(spark):
    log = spark.range(50_000).selectExpr(
        "'hot' AS iep", "id AS id_submission",
        "CAST(timestamp_seconds(1514764800 + id * 600) AS STRING) AS datetime")
    days = spark.createDataFrame([(dt.date(2018, m, 1),) for m in range(1, 13)], "day date")
    df = validity(log, days, ["iep"])
    assert len(df.collect()) <= 12
    plan = df._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "HashAggregate" in window and "partial_max" in window  # windows stand on what is reduced
    assert in_force(log, days, ["iep"]).count() == 12


# --- one pass, calendars, shares ---------------------------------------------------------------

@needs_tables
def test_all_indicators_are_those_of_each_operation(spark):
    cases = star.court_cases(spark, SF_DIR, procedures=True)
    codes = [*indicators.RULINGS_BY_OPERATION, "OTHER"]
    no = F.pmod(F.col("nro") + F.col("linea"), F.lit(len(codes)))
    rows = cases.withColumn("operation", F.element_at(F.array(*map(F.lit, codes)), no.cast("int") + 1))
    rows = rows.withColumn("tproc", F.when(F.col("nro") % 7 != 0, F.col("tproc")))
    ended = star.ended_mediations(spark, SF_DIR).select(
        "iep", "tipo_circ", "tres_disc", "data_interval_start", "data_interval_end", "duracion")
    both = rows.unionByName(ended.withColumn("operation", F.lit("CRMED")), allowMissingColumns=True)
    population = star.population(spark, SF_DIR, ("3",))
    found = indicators.all_indicators(both, population, "1996-02-01", "1997-08-01")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[l_", plan)) == 2  # one scan for cases, one for durations
    found.cache()
    for code in codes[:-1]:
        one = indicators.indicators(rows.filter(F.col("operation") == code), code, population, "1996-02-01", "1997-08-01")
        settings = indicators.RULINGS_BY_OPERATION[code]
        names = dict(zip(settings.late_columns, ("luego_1er_venc", "luego_2do_venc")))
        own = found.filter(F.col("operation") == code)
        columns = ["organismo", "data_interval_start", "causas_adespacho", *rulings.ruling_measures(settings)]
        assert rows_of(own.select(*[names.get(c, c) for c in columns])) == rows_of(one.select(*columns))
        assert len(settings.due) == 2 or own.filter("luego_2do_venc IS NOT NULL").count() == 0
    one = indicators.indicators(ended, "CRMED", population, "1996-02-01", "1997-08-01")
    own = found.filter("operation = 'CRMED'")
    assert own.filter("causas_resueltas IS NOT NULL OR organismo IS NOT NULL").count() == 0
    assert rows_of(own.select(*one.columns)) == rows_of(one)
    assert {r.operation for r in found.select("operation").distinct().collect()} == {*codes[:-1], "CRMED"}
    found.unpersist()


def test_working_days_by_district(spark):
    districts = spark.createDataFrame([("N",), ("S",), ("N",)], "circunscripcion string")
    off = spark.createDataFrame([("N", dt.date(2018, 7, 4)), ("N", dt.date(2018, 7, 4)), ("N", dt.date(2018, 7, 7)),
                                 ("X", dt.date(2018, 7, 5)), ("S", None)], "circunscripcion string, fecha date")
    table = calendar.working_calendar(districts, off, "2018-07-01", "2018-07-31")
    counts = {(r.circunscripcion, r.fecha.day): r.habiles for r in table.collect()}
    assert len(counts) == 62 and counts["N", 31] == 21 and counts["S", 31] == 22  # 22 weekdays in that month
    assert counts["N", 6] - counts["N", 2] == 3 and counts["S", 6] - counts["S", 2] == 4
    cases = spark.createDataFrame([("c", "N", "02/07/2018", "06/07/2018"), ("c", "N", "02/07/2018", "09/07/2018"),
                                   ("c", "S", "02/07/2018", "06/07/2018"), ("c", None, "02/07/2018", "06/07/2018"),
                                   ("c", "S", "02/07/2018", None), ("c", "S", "02/07/2018", "02/08/2018")],
                                  "iep string, circunscripcion string, fdesp string, fres string")
    found = calendar.share_within_working_days(cases, table, ["iep"], days=4).collect()
    assert [tuple(r) for r in found] == [("c", 3, 1, 1 / 3)]


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1, "c": 1}, {"a": 5, "b": 3, "c": 0}, {"a": 2, "b": 7, "c": 4}])
def test_apportioned_shares_add_up(spark, weights):
    rows = [("N", "x", f"g{i}", "t", i) for i in range(40)] + [("N", "x", "g1", "subtotal", 99), ("S", "y", "g5", "t", 3)]
    started = spark.createDataFrame(rows, schemas.STARTED_COUNTS)
    moved = reallocation.reallocate(started, ["x"], list(weights), [], inverse=True, weights=weights)
    total = sum(weights.values())
    got = {(r.grupo_proceso, r.organismo): r.cantidad for r in moved.collect() if r.tipo_proceso == "-"}
    for i in range(40):
        floors = {c: i * w // total for c, w in weights.items()}
        order = sorted(weights, key=lambda c: (-(i * weights[c] % total), c))
        for c in order[: i - sum(floors.values())]:
            floors[c] += 1
        assert {c: got[f"g{i}", c] for c in weights} == floors and sum(floors.values()) == i
    assert moved.filter("tipo_proceso = 't'").count() == 1
    with pytest.raises(ValueError):
        reallocation.reallocate(started, ["x"], ["a"], [], weights={"a": 0})
