"""Contiguous shards of near equal bytes, by global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casetally.llm.common import stored, text_or_empty

RUN = 4096  # most interchangeable rows that one task numbers at a time


def byte_shards(
    docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Documents stand in the order of id (NULL first), checksum and size. Rows that agree in
    all of these are interchangeable: they are counted in partial sums and numbered, in
    runs of at most ``RUN`` a task, so that a range may end between two of them. The narrow
    rows are range-partitioned and written once, so that partition bounds cannot move
    between passes. Totals per partition give each partition's offset, a running sum inside the
    partition gives each row's place on the global byte line, and the line is cut at
    ``shards`` equal targets; a document goes where its middle lies. No task sees more
    than one partition, and what is broadcast is one row per partition.

    ``size`` is the UTF-8 length plus one, so empty and NULL texts (equal here) weigh 1.
    A document longer than
    a target can leave shards empty. An empty table gives no rows.
    """
    content = text_or_empty(text)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    first = F.expr(f"sequence(0L, _times - 1, {RUN}L)")
    runs = rows.groupBy(*order).agg(F.count("*").alias("_times")).select(
        *order, "_times", F.explode(first).alias("_first")
    )
    last = F.least(F.col("_first") + RUN, F.col("_times")) - 1
    numbered = runs.repartition(*order, "_first").select(
        *order, F.explode(F.sequence("_first", last)).alias("_copy")
    )
    placed = stored(
        numbered.repartitionByRange(*order, "_copy").withColumn("_part", F.spark_partition_id())
    )
    # One row per partition: the single task here reads as many rows as there are partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order, "_copy")
    to_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = (
        placed.select(
            "*", F.sum("size").over(to_here).alias("_end"), F.row_number().over(inside).alias("_no")
        )
        .join(F.broadcast(offsets), "_part")
        .select(
            *order, "_total", (F.col("_rows_before") + F.col("_no") - 1).alias("_row"),
            (2 * (F.col("_bytes_before") + F.col("_end")) - F.col("size")).alias("_middle2"),
        )
        .withColumn("shard", F.expr(f"cast((_middle2 * {int(shards)}L) div (2 * _total) as int)"))
    )
    line = stored(line.select(*order, "_row", "shard"))
    firsts = line.groupBy("shard").agg(F.min("_row").alias("_first"))
    return line.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
