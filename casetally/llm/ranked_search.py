"""Ranked lexical search: term at a time with a limited set of accumulators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casetally.llm.common import stored
from casetally.llm.words import NOT_ALPHANUMERIC, Words, slices, split_words

QUERY_BYTES = 4 << 20  # text of the items that are searched for at a time
BLOCK_DOCS = 8192  # most documents of a block of the index
BLOCK_POSTINGS = 1 << 20  # a block ends with the text that brings it to so many postings
RARE_DOCS = 32  # for each row asked for: documents that the first round may look at

_INDEX = (
    "ids binary, without_id binary, lengths binary, terms binary, starts binary, places binary, times binary, "
    "docs long, words long, held array<struct<term:int,docs:int>>"
)


def terms_of(texts: pa.Array) -> Words:
    return split_words(texts, NOT_ALPHANUMERIC, lower=True)


@dataclass
class Queries:
    """The items of one block: of item ``i``, the terms ``bounds[i]:bounds[i + 1]``, rarest
    first, with their weight times how often the item has them."""

    ids: list
    bounds: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    docs: np.ndarray  # documents that hold the term

    def state(self) -> dict:
        return vars(self)


def _index(rows: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Inverted lists over the terms of ``vocabulary`` (sorted hashes), a row for each block."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def block(parts: list[tuple]) -> pa.RecordBatch:
        ids, missing, lengths = (np.concatenate([p[i] for p in parts]) for i in range(3))
        base = np.cumsum([0] + [len(p[0]) for p in parts])
        place = np.concatenate([p[3] + b for p, b in zip(parts, base, strict=False)])
        term, times = (np.concatenate([p[i] for p in parts]) for i in (4, 5))
        order = np.argsort(term, kind="stable")  # places rise within a term
        held, starts = np.unique(term[order], return_index=True)
        starts = np.append(starts, len(order))
        cells = [
            ids.astype(np.int64), missing.astype(np.uint8), lengths.astype(np.int64), held.astype(np.int32),
            starts.astype(np.int64), place[order].astype(np.int32), times[order].astype(np.int64),
        ]
        counts = [{"term": t, "docs": n} for t, n in zip(held.tolist(), np.diff(starts).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([c.tobytes()], pa.binary()) for c in cells]
            + [pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())])]
            + [pa.array([counts], pa.list_(pa.struct({"term": pa.int32(), "docs": pa.int32()})))],
            names=["ids", "without_id", "lengths", "terms", "starts", "places", "times", "docs", "words", "held"],
        )

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        parts: list[tuple] = []
        for batch in batches:
            for run in slices(batch, 1):
                for part in (run.slice(i, BLOCK_DOCS) for i in range(0, run.num_rows, BLOCK_DOCS)):
                    w = terms_of(part.column(1))
                    spot = np.searchsorted(known, w.hashes)
                    spot[spot == len(known)] = 0
                    at = np.flatnonzero(known[spot] == w.hashes) if len(known) else np.empty(0, np.int64)
                    key = w.document[at] * max(1, len(known)) + spot[at]
                    key, times = np.unique(key, return_counts=True)
                    place, term = np.divmod(key, max(1, len(known)))
                    ids = part.column(0)
                    parts.append((
                        np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.diff(w.bounds), place, term, times,
                    ))
                    full = sum(len(p[3]) for p in parts) >= BLOCK_POSTINGS
                    if full or sum(len(p[0]) for p in parts) + BLOCK_DOCS // 2 >= BLOCK_DOCS:
                        yield block(parts)
                        parts = []
        if parts:
            yield block(parts)

    return rows.mapInArrow(lists, _INDEX)


@dataclass
class Block:
    """A block of the index, with what one occurrence list adds per unit of weight."""

    ids: np.ndarray
    missing: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    impacts: np.ndarray
    most: np.ndarray  # the largest impact of each list

    @classmethod
    def of(cls, row: dict, all_docs: int, all_words: int) -> Block:
        def array(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(row[name], kind)

        lengths, starts = array("lengths", np.int64), array("starts", np.int64)
        places, times = array("places", np.int32), array("times", np.int64)
        norm = 100 - 25 + (25 * lengths * all_docs) // max(1, all_words)
        impacts = (1_000_000_000 * times) // (1000 * times + 12 * norm[places])
        most = np.maximum.reduceat(impacts, starts[:-1]) if len(impacts) else impacts
        return cls(array("ids", np.int64), array("without_id", np.uint8), array("terms", np.int32),
                   starts, places, impacts, most)

    def lists_of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``terms`` occur here, and the numbers of their lists."""
        if not len(self.terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        spot = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = np.flatnonzero(self.terms[spot] == terms)
        return here, spot[here]

    def best(
        self, terms: np.ndarray, weights: np.ndarray, k: int, beat: int, creating: int | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the ``k`` best documents that reach ``beat``.

        Lists are taken in the given order. The first ones create accumulators, until no
        document without one can reach the k-th partial score or ``beat`` any more by what
        is left; equal scores still can, as the smaller id wins. The rest only update the
        accumulators there are. ``creating`` ends creation after so many terms: then only
        the documents met so far compete, with exact scores.
        """
        here, lists = self.lists_of(terms)
        left = np.append(np.cumsum((weights[here] * self.most[lists])[::-1])[::-1], 0)
        score = np.zeros(len(self.ids), np.int64)
        stop = len(here) if creating is None else int(np.searchsorted(here, creating))
        kth, done = beat, 0
        while done < stop and left[done] >= max(kth, 1):
            a, b = self.starts[lists[done]], self.starts[lists[done] + 1]
            score[self.places[a:b]] += weights[here[done]] * self.impacts[a:b]
            done += 1
            # The k-th partial score matters only once it can end the creation.
            if done < stop and left[done] < score.max() and np.count_nonzero(score) >= k:
                kth = max(beat, int(np.partition(score, len(score) - k)[len(score) - k]))
        own = np.flatnonzero(score)
        for i in range(done, len(here)):
            if not len(own):
                break
            a, b = self.starts[lists[i]], self.starts[lists[i] + 1]
            spot = np.minimum(np.searchsorted(self.places[a:b], own), b - a - 1)
            match = self.places[a + spot] == own
            score[own[match]] += weights[here[i]] * self.impacts[a + spot[match]]
        own = own[score[own] >= max(beat, 1)]
        if len(own) > k:
            own = own[score[own] >= np.partition(score[own], len(own) - k)[len(own) - k]]
        order = np.lexsort((self.ids[own], self.missing[own], -score[own]))[:k]
        return own[order], score[own[order]]


def _search(index: DataFrame, queries: Queries, all_docs: int, all_words: int, k: int, beat: np.ndarray,
            first_round: bool) -> DataFrame:
    """``_q, item_id, doc_id, score``: of every block, each item's best documents."""
    shared = index.sparkSession.sparkContext.broadcast((queries.state(), beat))
    rare = RARE_DOCS * k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, least = shared.value
        q = Queries(**state)
        bounds = q.bounds.tolist()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in
                       ("ids", "without_id", "lengths", "terms", "starts", "places", "times")}
                block = Block.of(row, all_docs, all_words)
                of, places, scores = [], [], []
                for n, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    # The rarest terms, as long as few documents in all hold one of them.
                    most = int(np.searchsorted(np.cumsum(q.docs[a:b]), rare, side="right")) if first_round else None
                    place, score = block.best(q.terms[a:b], q.weights[a:b], k, int(least[n]), most)
                    of.append(np.full(len(place), n))
                    places.append(place)
                    scores.append(score)
                n, place = np.concatenate(of or [[]]).astype(np.int64), np.concatenate(places or [[]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(n), pa.array(q.ids, pa.int64()).take(pa.array(n)),
                        pa.array(block.ids[place], mask=block.missing[place] == 1),
                        pa.array(np.concatenate(scores or [[]]).astype(np.int64)),
                    ],
                    names=["_q", "item_id", "doc_id", "score"],
                )

    return index.select("ids", "without_id", "lengths", "terms", "starts", "places", "times").mapInArrow(
        run, "_q long, item_id long, doc_id long, score long"
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(rows: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Search for some items, whose texts are bounded, in all documents."""
    asked = items.orderBy("id", "text").collect()
    w = terms_of(pa.array([r["text"] for r in asked], pa.string()))
    vocabulary, term = np.unique(w.hashes, return_inverse=True)
    index = stored(_index(rows, vocabulary))
    totals = index.agg(F.sum("docs"), F.sum("words")).first()
    all_docs, all_words = (int(x or 0) for x in totals)
    held = np.zeros(len(vocabulary), np.int64)
    counted = index.select(F.explode("held").alias("h")).groupBy("h.term").agg(F.sum("h.docs").alias("docs"))
    for r in counted.collect():
        held[r["term"]] = r["docs"]

    bounds, terms, weights = [0], [], []
    for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
        own, times = np.unique(term[a:b], return_counts=True)
        weight = np.floor(1000 * np.log((2 * all_docs + 2) / (2 * held[own] + 1))).astype(np.int64)
        order = np.lexsort((own, held[own]))
        order = order[(held[own[order]] > 0) & (weight[order] > 0)]
        terms.append(own[order])
        weights.append((weight * times)[order])
        bounds.append(bounds[-1] + len(order))
    terms = np.concatenate(terms or [[]]).astype(np.int64)
    queries = Queries([r["id"] for r in asked], np.array(bounds), terms,
                      np.concatenate(weights or [[]]).astype(np.int64), held[terms])

    # First round: exact scores of the few documents that hold an item's rarest terms. The
    # k-th best of them in all blocks is a score that every block has to reach.
    beat = np.zeros(len(asked), np.int64)
    first = _search(index, queries, all_docs, all_words, k, beat, first_round=True)
    for r in _ranked(first, k).filter(F.col("rank") == k).select("_q", "score").collect():
        beat[r["_q"]] = r["score"]
    found = _search(index, queries, all_docs, all_words, k, beat, first_round=False)
    return _ranked(found, k).select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 20, query_bytes: int = QUERY_BYTES,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents that fit each item's text best.

    Terms are runs of ASCII letters and digits and of non-ASCII characters, A to Z as lower
    case. A term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))``; a document's score
    adds, over the item's terms with repeats, the weight times ``10^9 tf div (1000 tf +
    12 m)`` with ``m = 75 + 25 n N div L``. Scores of 0 are left out, equal scores go by
    rising id.

    Documents are indexed where they lie, in blocks of bounded size with inverted lists of
    the terms asked for; no text is shuffled. A block takes an item's lists rarest first,
    stops creating accumulators once what is left cannot reach the k-th partial score, and
    updates the survivors exactly by looking them up in the longer lists. A first round over
    the rarest terms gives each item a score that all blocks must reach, so that most blocks
    create few accumulators and return few rows. Items are searched for in groups of about
    ``query_bytes`` of text, dealt by id and text, whose terms and weights are broadcast: any
    number of items needs no more memory, but a pass over the documents for each group.

    NULL and empty texts have no terms: such documents are not counted and never found, such
    items find nothing. Every row of ``items`` is a query of its own, also a repeated one;
    every row of ``docs`` a document of its own. Among equal scores, documents without id
    come last. Empty tables give no rows. Ids are integers; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).filter("text <> ''")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // query_bytes))
    asked = asked.withColumn("_group", F.pmod(F.xxhash64("id", "text"), F.lit(groups)))
    found = None
    for g in range(groups):
        part = _search_block(rows, asked.filter(F.col("_group") == g).drop("_group"), k)
        found = part if found is None else found.unionByName(part)
    return found
