from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from casetally import schemas
from casetally.plans import quality
from casetally.sources import readers
from casetally.sources.hearings import exploded_parties, typed_hearings
from court_fixtures import AUG, CASES, JUL, SEP, cases


def line(nro="101", finicio="01/02/2019", duracb="30", fea="10/02/2019", ra="A", parties="Ana$1$ACTOR$Calle 1%"):
    return "\t".join([nro, "Ana c/ Beto", "ORDINARIO", "2", finicio, "45", duracb, "05/02/2019", fea,
                      "", "", "1", ra, "3", "", "1", "0", parties])


def listing(tmp_path, *lines):
    path = tmp_path / "listado.txt"
    text = "\r\n".join(["\t".join(schemas.HEARING_COLUMNS), *lines]) + "\r\n"
    path.write_bytes(text.encode())
    return str(path)


def test_hearing_listing(spark, tmp_path):
    path = listing(
        tmp_path,
        line(),
        line(nro="102", duracb="", fea="31/02/2019", ra="",
             parties='"Ana ""la"" Gil$1$ACTOR$%Beto$$DEMANDADO%"'),
        line(nro="x3", parties="Solo$9%"),
        "104\tcorta",
    )
    raw = readers.read_hearings(spark, path)
    rows = {r.nro: r for r in raw.collect()}
    assert set(rows) == {"101", "102", "x3", "104"}
    assert rows["104"]._corrupt_record is not None and rows["101"]._corrupt_record is None
    assert rows["101"].audvid == "0" and rows["101"].justiables == "Ana$1$ACTOR$Calle 1%"

    typed = typed_hearings(readers.read_hearings(spark, path)).collect()
    first, second, third = typed[:3]
    assert (first.nro, first.duracb, first.fea) == (101, 30, dt.date(2019, 2, 10))
    assert (second.duracb, second.fea) == (None, None)
    assert [tuple(p) for p in second.justiables] == [
        ('Ana "la" Gil', "1", "ACTOR", None), ("Beto", None, "DEMANDADO", None)]
    assert third.nro is None and [tuple(p) for p in third.justiables] == [("Solo", "9", None, None)]

    parties = exploded_parties(raw.filter("nro = '102'"), "justiables", "nro").collect()
    assert [(r.orden, r.name) for r in parties] == [(0, 'Ana "la" Gil'), (1, "Beto")]


def test_hearing_quality(spark, tmp_path):
    raw = readers.read_hearings(spark, listing(
        tmp_path, line(), line(nro="x2"), line(ra=""), line(fea=""), line(duracb="")))
    assert [r[0] for r in raw.select(quality.conforms(F.col("nro"))).collect()] == [
        True, False, True, True, True]
    assert [r[0] for r in raw.select(quality.valid_hearing(raw)).collect()] == [
        True, True, False, False, False]


def test_operation_store_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "ops")
    both = cases(spark).withColumn("operation", F.lit("CADR1C")).unionByName(
        cases(spark).limit(1).withColumn("operation", F.lit("CADR1L")))
    readers.write_operation(both, path)
    civil = readers.read_operation(spark, path, "CADR1C", schemas.RULINGS)
    assert civil.columns == cases(spark).columns
    assert sorted(map(str, civil.collect())) == sorted(map(str, cases(spark).collect()))
    july = civil.filter((F.col("data_interval_start") >= JUL) & (F.col("data_interval_start") < AUG))
    plan = july._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(operation" in plan
    assert july.count() == len([r for r in CASES if r[1] == JUL])


def test_rewriting_a_month_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "ops")
    stored = cases(spark).withColumn("operation", F.lit("CADR1C"))
    readers.write_operation(stored, path)
    readers.write_operation(stored.filter(F.col("data_interval_start") == JUL).limit(1), path)
    got = readers.read_operation(spark, path, "CADR1C", schemas.RULINGS)
    assert {(r[0], r[1]) for r in got.groupBy("data_interval_start").count().collect()} == {
        (JUL, 1), (AUG, 1)}


def test_month_predicates():
    assert readers.month_predicates("2018-12-15", "2019-02-01") == [
        "data_interval_start >= DATE '2018-12-15' AND data_interval_start < DATE '2019-01-01'",
        "data_interval_start >= DATE '2019-01-01' AND data_interval_start < DATE '2019-02-01'",
    ]
    assert len(readers.month_predicates(JUL, SEP)) == 2


def test_report_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "organismo string, n int")
    for fmt in ("parquet", "csv"):
        readers.write_report(df, str(tmp_path / fmt), fmt)
    assert readers.read_table(spark, str(tmp_path / "parquet")).collect() == df.collect()
    assert spark.read.csv(str(tmp_path / "csv"), header=True).first().n == "1"


def test_named_table(spark):
    spark.range(2).createOrReplaceTempView("named_table_for_test")
    assert readers.read_table(spark, "named_table_for_test").count() == 2
