"""Ordered lists printed in one cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def entries_in_cells(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    row_id: str,
    entry: str,
    per_cell: int,
    into: str = "entries",
    count: str = "entry_count",
    block: int = 1 << 16,
    separator: str = ", ",
    missing: str = "?",
) -> DataFrame:
    """Entries of each key, ordered by ``period`` then ``row_id``, joined as text.

    A key has one row with ``part`` 1 as long as it has no more than ``per_cell``
    entries; a longer list goes on in further parts, so nothing is cut and no cell
    grows with the data. A NULL entry is printed as ``missing`` and counts like others.

    There is one way for lists of any length, and it sorts no key as a whole. Copies of
    an entry are counted map-side and travel as one run. ``row_id`` is an integer key of
    the table, so a period's runs fall into blocks of no more than ``block`` ids, which
    are numbered by themselves. A block's offset in its key's list is the prefix sum of
    the blocks before it: a window over one narrow row for each block. A run that is
    longer than a cell is cut where cells end. Places are matched on structs of the keys,
    which compare NULL as equal.
    """
    runs = (
        df.withColumn("_shown", F.coalesce(F.col(entry), F.lit(missing)))
        .groupBy(*keys, period, row_id, "_shown").agg(F.count("*").alias("_times"))
        .withColumn("_block", F.floor(F.col(row_id) / F.lit(block)))
        .select(
            F.struct(*keys, period, "_block").alias("_spot"), F.col(row_id).alias("_id"),
            F.col("_shown").alias("_entry"), "_times",
        )
    )
    in_block = Window.partitionBy("_spot").orderBy("_id", "_entry")
    in_block = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = runs.withColumn("_in_block", F.sum("_times").over(in_block) - F.col("_times"))

    in_key = (
        Window.partitionBy(F.struct(*[F.col("_spot")[k].alias(k) for k in keys]))
        .orderBy(F.col("_spot")[period], F.col("_spot._block"))
    )
    earlier = in_key.rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.groupBy("_spot").agg(F.sum("_times").alias("_n")).select(
        "_spot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_at")
    )

    cell = F.lit(per_cell)
    first = F.col("_at") + F.col("_in_block")
    placed = counted.join(starts, "_spot").select(
        *[F.col("_spot")[k].alias(k) for k in keys], "_entry",
        first.alias("_first"), (first + F.col("_times")).alias("_end"),
    )
    cells = F.sequence(F.floor(F.col("_first") / cell), F.floor((F.col("_end") - 1) / cell))
    pieces = placed.select("*", F.explode(cells).alias("_cell")).select(
        *keys, (F.col("_cell") + 1).alias("part"), "_first", "_entry",
        (F.least("_end", (F.col("_cell") + 1) * cell) - F.greatest("_first", F.col("_cell") * cell))
        .cast("int").alias("_times"),
    )
    texts = F.transform(
        "_pieces", lambda p: F.array_join(F.array_repeat(p["_entry"], p["_times"]), separator)
    )
    return (
        pieces.groupBy(*keys, "part")
        .agg(
            F.sum("_times").alias(count),
            F.sort_array(F.collect_list(F.struct("_first", "_entry", "_times"))).alias("_pieces"),
        )
        .select(*keys, "part", count, F.array_join(texts, separator).alias(into))
    )
