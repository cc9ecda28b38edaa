"""Operation tables in which what was submitted again replaces what was there."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetally.functions.dates import to_day
from casetally.sources.readers import write_operation

KEYS = ("operation", "data_interval_start")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``, which the driver and all executors share.

    Where that is unset only a local master can go on, with a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="casetally-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/casetally-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    own = [f for f in schema.fields if f.name not in KEYS]
    keys = [T.StructField("operation", T.StringType()), T.StructField("data_interval_start", T.DateType())]
    return spark.read.schema(T.StructType([*own, *keys])).parquet(path)


def replace_month(
    new: DataFrame, path: str, operation: str, month: str | dt.date, courts: DataFrame, court: str = "iep"
) -> None:
    """Put ``new`` in the place of all that ``courts`` had stored for the operation's month.

    ``courts`` lists who submitted again (column ``court``), also those without any row
    now. Courts that are not listed keep their rows, and so does every other month: only
    one partition is read and written, by dynamic partition overwrite, which shows the old
    rows until the new ones are complete. Doing it again changes nothing. Rows of another
    month or of courts that are not listed are refused. A store that has no such month
    gets it.
    """
    spark, day = new.sparkSession, to_day(month)
    listed = courts.select(court).distinct()
    fits = F.col("data_interval_start").eqNullSafe(F.lit(day)) & F.col("_listed").isNotNull()
    message = F.concat(F.lit("not a row of the month and courts to be replaced: "), F.coalesce(F.col(court), F.lit("NULL")))
    checked = (
        new.join(listed.withColumn("_listed", F.lit(True)), court, "left")
        .withColumn(court, F.when(fits, F.col(court)).otherwise(F.raise_error(message))).drop("_listed")
    )
    old = _stored(spark, path, new.schema).filter(
        (F.col("operation") == operation) & (F.col("data_interval_start") == F.lit(day))
    )
    kept = old.join(listed, court, "left_anti")
    rows = kept.unionByName(checked.withColumn("operation", F.lit(operation)))
    if rows.isEmpty():  # an overwrite by partitions replaces none without rows
        own = [c for c in rows.columns if c not in KEYS]
        folder = f"{path}/operation={operation}/data_interval_start={day}"
        empty = spark.createDataFrame([], T.StructType([rows.schema[c] for c in own]))
        empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
    else:
        write_operation(rows, path)


def read_months(
    spark: SparkSession, path: str, operation: str, schema: T.StructType, months: DataFrame
) -> DataFrame:
    """Rows of one operation in the months that ``months`` lists (``data_interval_start``).

    The months come from a table, often another report. When they are few, Spark reads
    them first and then only the partitions they name (dynamic partition pruning).
    """
    wanted = months.select("data_interval_start").distinct()
    rows = _stored(spark, path, schema).filter(F.col("operation") == operation)
    return rows.join(wanted, "data_interval_start", "left_semi").select(*schema.names)
