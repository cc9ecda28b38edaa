"""Reading and writing the court tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetally.functions.dates import to_day
from casetally.schemas import CORRUPT, HEARING_COLUMNS, HEARINGS_RAW

PAYLOAD = "input"


def write_operation(df: DataFrame, path: str) -> None:
    """Store operation rows partitioned by operation and reporting month.

    ``df`` needs ``operation`` and ``data_interval_start``. Rebalancing lets Spark
    cut a partition that holds much of the data over several tasks and files, and
    merge small ones; a re-run replaces only the partitions it writes.
    """
    keys = ("operation", "data_interval_start")
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path)
    )


def read_operation(
    spark: SparkSession, path: str, operation: str, schema: T.StructType
) -> DataFrame:
    """Rows of one operation; only its folders are read, and no schema is inferred."""
    stored = T.StructType([*schema.fields, T.StructField("operation", T.StringType())])
    return (
        spark.read.schema(stored).parquet(path)
        .filter(F.col("operation") == operation).select(*[F.col(f"`{n}`") for n in schema.names])
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet folder when ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def month_predicates(
    start: str | dt.date, end: str | dt.date, column: str = "data_interval_start"
) -> list[str]:
    """One SQL condition per month, to read a database table month by month."""
    first, last = to_day(start), to_day(end)
    out, at = [], first
    while at < last:
        nxt = min(dt.date(at.year + at.month // 12, at.month % 12 + 1, 1), last)
        out.append(f"{column} >= DATE '{at}' AND {column} < DATE '{nxt}'")
        at = nxt
    return out


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table over JDBC, one task per predicate; filters are pushed down."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def without_payload(log: DataFrame) -> DataFrame:
    """Drop the submitted file kept in the log, so that the scan skips it."""
    return log.drop(PAYLOAD)


def read_hearings(
    spark: SparkSession, path: str, encoding: str = "UTF-8", header: bool = True
) -> DataFrame:
    """The TAB-separated hearing listing, every field as text.

    Dirty rows are kept: a row with another number of fields lands whole in the
    corrupt-record column, whichever columns are asked for. One record is one line, so
    large files are split. A line without any character but white space is no record.
    """
    # A reader that skips columns would not see that a row has too many or too few.
    return spark.read.schema(HEARINGS_RAW).option("columnPruning", "false").csv(
        path, sep="\t", header=header, quote='"', escape='"', mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT, encoding=encoding, multiLine=False,
    )


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store a report, by default as Parquet; CSV gets a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def hearing_lines(df: DataFrame) -> DataFrame:
    """A hearing listing as TAB-separated lines: its columns in order, one column ``value``.

    Fields with a quote are quoted and the quotes doubled, as :func:`read_hearings` reads
    them; NULL is an empty field.
    """
    fields = [
        F.when(F.col(c).contains('"'), F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')))
        .otherwise(F.coalesce(F.col(c), F.lit("")))
        for c in HEARING_COLUMNS
    ]
    return df.select(F.concat_ws("\t", *fields).alias("value"))
