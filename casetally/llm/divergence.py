"""How the sources of a language differ in their words: exact divergences, ranked by count cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetally.llm.common import stored, text_or_empty
from casetally.llm.words import Words, mixed, slices, split_words

_SALT = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that end a term: all of ASCII but letters.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def _texts_at(w: Words, index: np.ndarray) -> pa.Array:
    data = w.data.tobytes()
    starts, ends = w.starts[index], w.ends[index]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    joined = b"".join([data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return pa.StringArray.from_buffers(len(index), pa.py_buffer(offsets), pa.py_buffer(joined))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run of texts, language, source and term: occurrences and documents."""
    for batch in batches:
        for part in slices(batch, 0):
            w = split_words(part.column(0), NOT_LETTERS, lower=True)
            langs, sources = (part.column(i).dictionary_encode() for i in (1, 2))
            lang, source = (np.asarray(c.indices).astype(np.int64) for c in (langs, sources))
            group = lang * len(sources.dictionary) + source
            document = w.document
            in_text = mixed(w.hashes + document.astype(np.uint64) * _SALT)
            _, first, n = np.unique(in_text, return_index=True, return_counts=True)
            in_group = mixed(w.hashes[first] + group[document[first]].astype(np.uint64) * _SALT)
            _, at, back = np.unique(in_group, return_index=True, return_inverse=True)
            shown, of = first[at], document[first[at]]
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(lang[of])), sources.dictionary.take(pa.array(source[of])),
                    _texts_at(w, shown), pa.array(np.bincount(back, n, len(at)).astype(np.int64)),
                    pa.array(np.bincount(back, minlength=len(at)).astype(np.int64)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """``lang, term, lang_n, sources``: terms in at least ``least_docs`` documents of their
    language, with their occurrences in all and by source (sorted by source)."""
    counted = (
        docs.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    return (
        counted.groupBy("lang", "term").agg(
            F.sum("docs").alias("_docs"), F.sum("n").alias("lang_n"),
            F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources"),
        )
        .filter(F.col("_docs") >= least_docs).drop("_docs")
    )


def _share(count: str | Column, total: str, terms: str) -> Column:
    """``1 + floor(10^9 (count + 5) / (total + 5 terms))``, exact beyond 64 bits."""
    count = F.col(count) if isinstance(count, str) else count
    over = (F.col(total) + 5 * F.col(terms)).cast("decimal(20,0)")
    return 1 + F.call_function("div", F.lit(10**9).cast("decimal(10,0)") * (count + 5).cast("decimal(20,0)"), over)


def _telling_terms(each: DataFrame, cells: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """The ``most`` terms of each group that it has more of than its language."""
    group = ["lang", "source"]
    valued = (
        cells.join(groups, group)
        .withColumn("value", _share("n", "total", "terms") - _share("lang_n", "lang_total", "terms"))
        .filter("value > 0").select(*group, "n", "lang_n", "times", "value")
    )
    falling = Window.partitionBy(*group).orderBy(F.desc("value"))
    # Every value has a term, so no more than the first `most` values can matter.
    values = (
        valued.groupBy(*group, "value").agg(F.sum("times").alias("times"))
        .withColumn("_place", F.row_number().over(falling)).filter(F.col("_place") <= most)
        .withColumn("_before", F.coalesce(F.sum("times").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .filter(F.col("_before") < most).select(*group, "value", "_before")
    )
    chosen = valued.join(values, [*group, "value"]).select(*group, "n", "lang_n", "value", "_before")
    rising = Window.partitionBy(*group, "value").orderBy("term")
    return (
        each.join(chosen, [*group, "n", "lang_n"])
        .withColumn("_in", F.row_number().over(rising)).filter(F.col("_in") <= most)
        .withColumn("rank", (F.col("_before") + F.col("_in")).cast("int")).filter(F.col("rank") <= most)
        .select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )


def _other_sources(kept: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """The summed differences of each two sources of a language.

    Most terms are missing from one source or both. The sum is therefore taken over all
    terms as if both counts were 0, corrected by the cells of either source alone and
    then by the cells of terms that both have.
    """
    def side(name: str) -> DataFrame:
        return groups.select(
            "lang", F.col("source").alias(name), F.col("total").alias(f"{name}_total"),
            F.col("zero").alias(f"{name}_zero"), "terms",
        )

    def apart(x: str, y: str) -> Column:
        return F.abs(F.col(x) - F.col(y))

    pair = ["lang", "a", "b"]
    a, b = side("a"), side("b").drop("terms")
    both_zero = apart("a_zero", "b_zero")
    # With a < b; every pair is a row of the result, in both directions.
    base = a.join(b, "lang").filter("a < b").select(*pair, (F.col("terms") * both_zero).alias("value"))
    alone = (
        cells.groupBy("lang", F.col("source").alias("a"), "n").agg(F.sum("times").alias("times"))
        .join(a, ["lang", "a"]).withColumn("p", _share("n", "a_total", "terms"))
        .join(b, "lang").filter("a <> b")
        .select(
            "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
            (F.col("times") * (apart("p", "b_zero") - both_zero)).alias("value"),
        )
    )
    together = (
        kept.select("lang", "sources", F.posexplode("sources").alias("_at", "_a"))
        .select("lang", "_a", F.explode(F.expr("slice(sources, _at + 2, size(sources))")).alias("_b"))
        .groupBy(
            "lang", F.col("_a.source").alias("a"), F.col("_b.source").alias("b"),
            F.col("_a.n").alias("a_n"), F.col("_b.n").alias("b_n"),
        ).agg(F.count("*").alias("times"))
        .join(a, ["lang", "a"]).join(b, ["lang", "b"])
        .withColumn("p", _share("a_n", "a_total", "terms")).withColumn("q", _share("b_n", "b_total", "terms"))
        .select(*pair, (
            F.col("times") * (apart("p", "q") - apart("p", "b_zero") - apart("a_zero", "q") + both_zero)
        ).alias("value"))
    )
    summed = base.unionByName(alone).unionByName(together).groupBy(*pair).agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        summed.select("lang", "value", ways.alias("_way")).select("lang", "_way.source", "_way.item", "value")
        .withColumn("rank", F.row_number().over(order))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    )


def source_divergence(
    docs: DataFrame, least_docs: int = 30, most_terms: int = 50,
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language differs.

    Part ``pair``: every other source of the language, by the summed differences of the
    shares of all kept terms. Part ``term``: the ``most_terms`` kept terms whose share
    exceeds the language's the most. Ranks fall by value, equal values rise by item in
    UTF-8 order.

    Terms are grouped into cells of equal counts in the source and in the language; a
    value is worked out once a cell, values are ranked by how many terms stand before
    them, and only cells that reach the ranks asked for are expanded into terms. Counting
    is one pass with partial sums per run of texts, so a frequent term or source costs a
    row a task; a tied value, however many terms share it, puts at most ``most_terms`` rows
    a task through the last shuffle.

    NULL text, lang and source count as ''. Repeated rows count each. A language without
    kept terms has pairs of value 0 and no terms; a source that is alone has no pairs; an
    empty table has no rows. Other columns of ``docs`` are not read.
    """
    rows = docs.select(
        text_or_empty(text).alias("text"), text_or_empty(lang).alias("lang"), text_or_empty(source).alias("source")
    )
    kept = stored(kept_terms(rows, least_docs))
    each = kept.select("lang", "term", "lang_n", F.explode("sources").alias("_s")).select(
        "lang", "_s.source", "_s.n", "lang_n", "term"
    )
    cells = stored(each.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("times")))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    of_group = cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("times")).alias("total"))
    groups = (
        rows.select("lang", "source").distinct()
        .join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left")
        .fillna(0, ["terms", "lang_total", "total"])
        .withColumn("zero", F.when(F.col("terms") > 0, _share(F.lit(0), "total", "terms")).otherwise(0))
    )
    groups = stored(groups)
    return _other_sources(kept, cells, groups).unionByName(_telling_terms(each, cells, groups, most_terms))
