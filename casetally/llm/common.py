"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as the query contracts name it, for Java and RE2 patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors can reach.

    It lies in ``spark.checkpoint.dir``. Where that is unset only a local master can
    go on, with a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="casetally-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/casetally-{uuid.uuid4().hex}"


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` as a written table: lineage ends here and lost executors cost no rerun."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(_nullable(df.schema)).parquet(path)


def part_files(folder: str) -> tuple:
    """The file system and the paths, by name, of the files that Spark wrote to ``folder``.

    For workers that read a table whole; a folder that was never written has none.
    """
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return store, sorted(f.path for f in found if f.base_name.startswith("part-"))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def fold_of(doc_id: str, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(folds))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two non-null longs that name a row by id and text; equal rows share them."""
    return [
        F.xxhash64(F.col(doc_id).cast("long"), F.col(doc_id).isNull()).alias("_k1"),
        F.xxhash64(F.col(text), F.col(text).isNull()).alias("_k2"),
    ]


def thinned(
    docs: DataFrame, keys: dict[str, Column], out: DataFrame, once: DataFrame, salts: int = 64
) -> DataFrame:
    """Rows of ``docs``, all columns as they were, without those whose key is in ``out`` and
    with one row of each key in ``once``. ``keys`` are never NULL; both tables have them by
    their names, and no key is in both.

    All other rows pass as they are: whether the join shuffles them is left to Spark, by the
    size of the stored keys. Rows of a key in ``once`` are dealt to ``salts`` parts by their
    partition before they are joined and reduced, so that no task gets all of a hot key.
    """
    names = list(keys)
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        *[key.alias(name) for name, key in keys.items()],
    )
    passed = whole.join(out.select(*names).unionByName(once.select(*names)), names, "left_anti")
    dealt = whole.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = once.select(*names, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    first = F.first("_doc").alias("_doc")
    reduced = (
        dealt.join(salted, [*names, "_salt"], "left_semi")
        .groupBy(*names, "_salt").agg(first).groupBy(*names).agg(first)
    )
    return passed.select("_doc.*").unionAll(reduced.select("_doc.*"))


def rows_for(count: int, per_part: int) -> int:
    """Parts of at most about ``per_part`` rows each."""
    return max(1, -(-count // per_part))


def worker_cache(owner: str) -> dict:
    """A dictionary that outlives the task, in its Python worker.

    It belongs to one operator at a time: another one's tables are let go.
    """
    name = "_casetally_worker_cache"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if held.get("owner") != owner:
        held["owner"], held["tables"] = owner, {}
    return held["tables"]
