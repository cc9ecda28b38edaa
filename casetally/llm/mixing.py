"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetally.llm.common import WORD, row_key, rows_for, stored, text_or_empty


def words_in(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def mix_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, source_size``.

    Weights are dealt to the sources by code point, NULL last, and repeat. A target stops
    at ``most`` times its source's size and the excess is shared anew by weight: sources
    are ranked by size per weight, and the stopped ones are the first of that ranking for
    which the common level lies above their own. One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("_level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    )
    ranked = (
        sizes.withColumn("_weight", weight)
        .withColumn("_level", F.lit(float(most)) * F.col("source_size") / F.col("_weight"))
        .withColumn("_budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("_stopped", F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("_open", F.sum("_weight").over(after))
        .withColumn("_common", (F.col("_budget") - F.col("_stopped")) / F.col("_open"))
        .withColumn("_no", F.row_number().over(by_level))
    )
    # The first source that is not stopped sets the level of all sources after it.
    level = F.min(F.when(F.col("_common") <= F.col("_level"), F.struct("_no", "_common"))).over(everything)
    free = ranked.withColumn("_at", level["_common"])
    return free.select(
        "source", "source_size",
        F.least(
            F.lit(float(most)) * F.col("source_size"),
            F.coalesce(F.col("_at") * F.col("_weight"), F.lit(float(most)) * F.col("source_size")),
        ).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    per_bucket: int = 10_000,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``
    and the row's key (``_k1, _k2``).

    Each source's documents are shuffled by the MD5 of their id and queue up ``most`` times
    in a row. The virtual finish time of a copy is the source's words up to its end,
    divided by the source's target. All copies are ranged by finish time and taken, whole,
    until the total budget is spent; sources then stand at their targets within a document.

    Running sums never put a source into one task: documents fall into ranges of the
    shuffle order and copies into ranges of the finish time, totals of ranges are summed
    first, and only rows of one range meet. Documents of one id, or without one, follow each
    other by the hash of their text, so that ranges end among them as well. Of the ranges of finish time only the one that
    the budget ends in is ordered. Texts are not shuffled.

    NULL and empty texts have size 0 and are never taken, nor is anything of a source of
    size 0 (target 0). Rows equal in id, source and text queue as one unit, are taken
    together, and so get equal results. An empty table gives no rows.
    """
    rows = stored(docs.select(
        *row_key(doc_id, text), F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).alias("source"), words_in(text).alias("size"),
    ))
    units = stored(
        rows.groupBy("_k1", "_k2", "doc_id", "source", "size").agg(F.count("*").alias("_times"))
        .withColumn("_order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    )
    mass = F.col("size") * F.col("_times")
    sizes = units.groupBy("source").agg(F.sum(mass).alias("source_size"), F.count("*").alias("_n"))
    targets = stored(mix_targets(sizes.select("source", "source_size"), weights, share, most))
    ranges = rows_for(units.count(), per_bucket)

    # Written once, so that the ranges cannot move between passes.
    queue = stored(
        units.filter("size > 0").select("*", mass.alias("_mass"))
        .repartitionByRange(ranges, "_order", "_k1", "_k2")
        .withColumn("_range", F.spark_partition_id())
    ).withColumn("_source", F.struct("source"))
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        queue.groupBy("_source", "_range").agg(F.sum("_mass").alias("_m"))
        .select("_source", "_range", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_source", "_range").orderBy("_order", "_k1", "_k2")
    up_to = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = queue.withColumn("_inside", F.sum("_mass").over(up_to)).join(starts, ["_source", "_range"])
    finish = (
        F.col("_before") + F.col("_inside") + F.col("_lap") * F.col("source_size")
    ) / F.col("target")
    level = targets.select(F.struct("source").alias("_source"), "source_size", "target")
    copies = stored(
        summed.join(level, "_source").filter("target > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("_lap"))
        .select("_k1", "_k2", "source", "_mass", finish.alias("_finish"))
        .withColumn("_time", F.floor(F.col("_finish") * ranges))
    )
    # How far the budget reaches: whole ranges first, then single copies of one range.
    # Finish times beyond 1 are past every target, so late ranges hold little.
    budget = (targets.agg(F.sum("target")).first()[0] or 0.0) + 0.5
    to_time = Window.orderBy("_time")
    times = copies.groupBy("_time").agg(F.sum("_mass").alias("_m")).select(
        "_time", F.sum("_m").over(to_time).alias("_to"), F.col("_m")
    )
    cut = times.filter(F.col("_to") > budget).agg(
        F.min(F.struct("_time", (F.col("_to") - F.col("_m")).alias("_before"))).alias("_cut")
    ).first()["_cut"]
    if cut is None:
        taken = copies
    else:
        in_order = Window.orderBy("_finish", F.col("source").asc_nulls_last(), "_k1", "_k2")
        last = (
            copies.filter(F.col("_time") == cut["_time"])
            .withColumn("_at", F.lit(cut["_before"]) + F.sum("_mass").over(in_order))
            .filter(F.col("_at") <= budget).drop("_at")
        )
        taken = copies.filter(F.col("_time") < cut["_time"]).unionByName(last)
    taken = taken.groupBy("_k1", "_k2", F.struct("source").alias("_source")).agg(
        F.count("*").alias("_copies")
    )
    copies_of = F.coalesce(F.col("_copies"), F.lit(0))
    return (
        rows.withColumn("_source", F.struct("source"))
        .join(taken, ["_k1", "_k2", "_source"], "left").join(level, "_source")
        .select(
            "doc_id", "source", "size", "source_size", "target", copies_of.alias("copies"),
            (copies_of * F.col("size")).alias("taken"), "_k1", "_k2",
        )
    )


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, all columns as they were."""
    names = docs.columns
    taken = (
        mix(docs, doc_id=doc_id, text=text, source=source, **settings).filter("copies > 0")
        .select(F.col("_k1").alias("_mix_k1"), F.col("_k2").alias("_mix_k2"),
                F.struct("source").alias("_mix_source"), F.col("copies").alias("_mix_copies")).distinct()
    )
    k1, k2 = row_key(doc_id, text)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_mix_doc"), k1.alias("_mix_k1"), k2.alias("_mix_k2"),
        F.struct(F.col(source).alias("source")).alias("_mix_source"),
    )
    return keyed.join(taken, ["_mix_k1", "_mix_k2", "_mix_source"]).select(
        "_mix_doc", F.explode(F.array_repeat(F.lit(0), F.col("_mix_copies").cast("int"))).alias("_mix_no")
    ).select("_mix_doc.*")
