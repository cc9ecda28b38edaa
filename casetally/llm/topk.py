"""Exact top-k by inner product with the threshold algorithm."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetally.llm.common import rows_for, stored

SCALE = 256
# As a score to reach: none is known.
NO_FLOOR = np.iinfo(np.int64).min


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, vector`` with every component as ``floor(256 * x)``.

    Vectors that are NULL or hold NULL or non-finite components are left out.
    """
    x = F.col(embedding).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.filter(F.col(embedding).isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v * SCALE).cast("long")).alias("vector"),
    )


def _number_type(q: np.ndarray, x: np.ndarray):
    """The fastest type in which all inner products are exact."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64 if most < 2**63 else object


def threshold_search(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int,
    first_depth: int = 64, lists: np.ndarray | None = None, floor: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best rows of ``vectors`` for each query: row numbers and scores, -1 for none.

    Every dimension has its list of rows, sorted by component. A query reads the lists of
    all dimensions at once, from the high end where its own component is positive and
    from the low end where it is negative, down to one depth for all, and scores what it
    meets. What it has not met can score at most the threshold, the sum over dimensions
    of its component times the one at that depth. Once the k-th best score is above the
    threshold the query is done (at equal scores a smaller id might still follow). Depths
    grow fourfold; queries that go on at a depth are scored together. Rows of the query's
    own id take no part. ``ids`` has to be ascending, so that ties go to smaller ids.

    ``lists`` are the row numbers of each dimension sorted by component, if they are at
    hand. ``floor`` is a score per query that ``k`` rows elsewhere reach: a query is also
    done once the threshold is below it, at the head of the lists already if it can be,
    and what it is then given may lack rows below the floor.
    """
    n, dims = vectors.shape
    kind = _number_type(queries, vectors)
    x, q = vectors.astype(kind), queries.astype(kind)
    found = np.full((len(q), k), -1, np.int64)
    scores = np.zeros((len(q), k), object if kind is object else np.float64 if kind != np.int64 else np.int64)
    still = np.arange(len(q))
    if floor is None:
        floor = np.full(len(q), NO_FLOOR)
    elif n:
        head = np.maximum(q, 0) @ x.max(axis=0) + np.minimum(q, 0) @ x.min(axis=0)
        still = np.flatnonzero(head >= floor)
    if not len(still):
        return found, scores
    order = np.argsort(vectors, axis=0, kind="stable") if lists is None else lists
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(n)[:, None], (n, dims)).copy(), axis=0)
    ascending = np.take_along_axis(x, order, axis=0)
    up, down = (queries > 0).astype(np.float32), (queries < 0).astype(np.float32)
    depth = min(n, max(k, first_depth))
    while len(still):
        if depth < n:
            high = (rank >= n - depth).astype(np.float32)
            low = (rank < depth).astype(np.float32)
            met = (up[still] @ high.T + down[still] @ low.T) > 0
            rows = np.flatnonzero(met.any(axis=0))
            met = met[:, rows]
            limit = np.maximum(q[still], 0) @ ascending[n - depth] + np.minimum(q[still], 0) @ ascending[depth - 1]
        else:
            rows, met, limit = np.arange(n), None, None
        s = q[still] @ x[rows].T
        allowed = ids[rows][None, :] != query_ids[still][:, None]
        if met is not None:
            allowed &= met
        if kind is object:
            s = np.where(allowed, s, -(1 << 200))
            lowest = -(1 << 200)
        else:
            s = s.astype(np.float64) if kind != np.int64 else s
            lowest = -np.inf if kind != np.int64 else np.iinfo(np.int64).min
            s = np.where(allowed, s, lowest)
        done = np.zeros(len(still), bool)
        take = min(k, s.shape[1])
        for i in range(len(still)):
            row = s[i]
            if take < len(row) and kind is not object:
                bar = np.partition(row, len(row) - take)[len(row) - take]
                near = np.flatnonzero(row >= bar) if bar > lowest else np.flatnonzero(row > lowest)
            else:
                near = np.flatnonzero(row > lowest)
            best = near[np.argsort(-row[near], kind="stable")[:k]]
            reached = limit is None or limit[i] < floor[still[i]]
            if reached or (len(best) == k and row[best[-1]] > limit[i]):
                done[i] = True
                found[still[i], : len(best)] = rows[best]
                scores[still[i], : len(best)] = row[best]
        still = still[~done]
        depth = min(n, depth * 4)
    return found, scores


def _narrow(x: np.ndarray) -> bytes:
    """The numbers in the narrowest of three widths that holds them all."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    fits = (t for t in (np.int16, np.int32) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return x.astype(next(fits, np.int64)).tobytes()


def _wide(data: bytes, rows: int, columns: int) -> np.ndarray:
    width = len(data) // max(1, rows * columns)
    return np.frombuffer(data, f"i{width or 8}").astype(np.int64).reshape(rows, columns)


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int = 5, query_block: int = 2048, block: int = 8192,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` from quantised queries and vectors.

    Exact: every query meets every vector of its own dimension, in blocks. Vectors are
    dealt evenly into blocks of about ``block`` rows and queries into blocks of
    ``query_block``; a pair of blocks is one task's unit, searched with the threshold
    algorithm, and its best ``k`` go on to a merge per query. A block's size is bounded
    whatever the data, and vectors travel once per block of queries.

    A block's lists are sorted once and written with it. Each block of queries is searched
    in one block of vectors first, which gives its queries a score that ``k`` vectors
    reach; in all other blocks a query stops once the threshold is below that score, and
    passes a block whose lists begin below it.

    Ties go to the smaller id, NULL last. A query row with a NULL id is left out; should a
    query id repeat, each row has its own ranking. Vectors of other dimensions are not
    compared. An empty table gives no rows.
    """
    numbered = F.monotonically_increasing_id()
    dims = F.size("vector").alias("dims")
    asked = stored(queries.filter("vec_id IS NOT NULL").select(dims, numbered.alias("no"), "vec_id", "vector"))
    q_blocks, v_blocks = rows_for(asked.count(), query_block), rows_for(vectors.count(), block)

    def block_of(number: Column, blocks: int, name: str) -> Column:
        return F.pmod(number, F.lit(blocks)).cast("int").alias(name)

    def matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
        flat = column.combine_chunks()
        flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
        return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)

    def with_lists(rows: pa.Table) -> pa.Table:
        """A block as one row: its vectors by id, NULL ids last, and its sorted lists."""
        null = np.asarray(rows["vec_id"].is_null())
        ids = rows["vec_id"].fill_null(0).to_numpy()
        by_id = np.lexsort((ids, null))
        x = matrix(rows["vector"], rows.num_rows)[by_id]
        return pa.table({
            "dims": pa.array([x.shape[1]], pa.int32()), "v_block": rows["v_block"].slice(0, 1),
            "n": pa.array([len(ids)], pa.int32()), "nulls": pa.array([int(null.sum())], pa.int32()),
            "ids": pa.array([ids[by_id].tobytes()], pa.binary()), "vectors": pa.array([_narrow(x)], pa.binary()),
            "lists": pa.array([_narrow(np.argsort(x, axis=0, kind="stable"))], pa.binary()),
        })

    lists = stored(
        vectors.select(dims, block_of(numbered, v_blocks, "v_block"), "vec_id", "vector")
        .groupBy("dims", "v_block").applyInArrow(
            with_lists, "dims int, v_block int, n int, nulls int, ids binary, vectors binary, lists binary"
        )
    )

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        names = {"query_no": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}
        if not a.num_rows or not b.num_rows:
            return pa.table({n: pa.array([], t) for n, t in names.items()})
        n, known = b["n"][0].as_py(), b["n"][0].as_py() - b["nulls"][0].as_py()
        ids = np.frombuffer(b["ids"][0].as_py(), np.int64)
        x, sorted_lists = (_wide(b[c][0].as_py(), n, b["dims"][0].as_py()) for c in ("vectors", "lists"))
        # Places stand for ids, the first for those of one id; no query equals a NULL.
        places = np.concatenate([np.searchsorted(ids[:known], ids[:known]), n + np.arange(n - known)])
        query_ids = a["vec_id"].to_numpy()
        own = np.searchsorted(ids[:known], query_ids)
        there = np.isin(query_ids, ids[:known])
        found, scores = threshold_search(
            matrix(a["vector"], a.num_rows), np.where(there, own, -1), x, places, k,
            lists=sorted_lists, floor=a["floor"].fill_null(NO_FLOOR).to_numpy(),
        )
        hit = found >= 0
        row, at = np.nonzero(hit)[0], found[hit]
        clip = [max(-(2**63), min(2**63 - 1, int(s))) for s in scores[hit]]
        return pa.table({
            "query_no": pa.array(a["no"].to_numpy()[row]), "query_id": pa.array(query_ids[row]),
            "vec_id": pa.array(ids[at], pa.int64(), mask=at >= known), "score": pa.array(clip, pa.int64()),
        })

    def searched(asked: DataFrame, first: bool) -> DataFrame:
        """The best of each unit: of a query block and the vector block it begins with, or
        of all other pairs of blocks."""
        begins = F.col("v_block") == F.pmod(F.col("q_block"), F.lit(v_blocks))
        chosen = begins if first else ~begins
        left = asked.withColumn("q_block", block_of(F.col("no"), q_blocks, "q_block")).withColumn(
            "v_block", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1)))
        )
        right = lists.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        key = ["dims", "q_block", "v_block"]
        return left.filter(chosen).groupBy(*key).cogroup(right.filter(chosen).groupBy(*key)).applyInArrow(
            search, "query_no long, query_id long, vec_id long, score long"
        )

    begun = stored(searched(asked.withColumn("floor", F.lit(None).cast("long")), first=True))
    floors = begun.groupBy(F.col("query_no").alias("no")).agg(
        F.when(F.count("*") >= k, F.min("score")).alias("floor")
    )
    best = begun.unionByName(searched(asked.join(floors, "no", "left"), first=False))
    order = Window.partitionBy("query_no").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
