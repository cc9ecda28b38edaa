"""Passages of a benchmark in documents, by Wu-Manber search over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.llm.common import part_files, shared_folder, worker_cache
from casetally.llm.words import NOT_ALPHANUMERIC, Words, mixed, slices, split_words

_SALT = np.uint64(0x9E3779B97F4A7C15)
LANE = 256  # positions that one lane of a search walks through
BLOCK_BYTES = 4 << 20  # text of the benchmark that a worker holds tables of at a time
EXPANDED = 1 << 20  # pairs of document and item that are made at a time


def words_of(texts: pa.Array) -> Words:
    return split_words(texts, NOT_ALPHANUMERIC, lower=True)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. counts[0] - 1, 0, 1, .. counts[1] - 1, and so on."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def same_words(a: Words, at_a: np.ndarray, b: Words, at_b: np.ndarray, length: int) -> np.ndarray:
    """Which runs of ``length`` words are equal, byte by byte."""
    same = np.ones(len(at_a), bool)
    for k in range(length):
        left = np.flatnonzero(same)
        i, j = at_a[left] + k, at_b[left] + k
        size = a.ends[i] - a.starts[i]
        fits = size == b.ends[j] - b.starts[j]
        same[left[~fits]] = False
        left, i, j, size = left[fits], i[fits], j[fits], size[fits]
        if not len(left):
            break
        step = ranges(size)
        equal = a.data[np.repeat(a.starts[i], size) + step] == b.data[np.repeat(b.starts[j], size) + step]
        same[left] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
    return same


class Windows:
    """Wu-Manber tables of the windows of one length: runs of words of the benchmark.

    Letters are words, blocks are two words. ``shift`` says, by a block's hash, how far the
    block's last place in any window lies from the window's end: so many positions cannot
    end a window. Where it is 0, the windows whose last block has that hash, and whose
    first block fits as well, are compared with the text word by word.
    """

    def __init__(self, words: Words, starts: np.ndarray, items: np.ndarray, length: int) -> None:
        self.words, self.length, self.block = words, length, min(2, length)
        whole = np.full(len(starts), _SALT, np.uint64)
        for k in range(length):
            whole = mixed(whole * _SALT + words.hashes[starts + k])
        _, first, back = np.unique(whole, return_index=True, return_inverse=True)
        # Equal windows are held once; what only shares the hash stays by itself.
        alike = same_words(words, starts, words, starts[first][back], length)
        own = np.flatnonzero(~alike)
        back[own] = len(first) + np.arange(len(own))
        self.starts = np.concatenate([starts[first], starts[own]])
        pairs = np.unique(np.stack([back, items], axis=1), axis=0)
        order, self.item = pairs[:, 0], pairs[:, 1]
        self.items_from = np.searchsorted(order, np.arange(len(self.starts) + 1))

        reach = length - self.block
        bits = max(12, int(np.ceil(np.log2(32 * (len(self.starts) + reach + 1)))))
        self.slots = np.uint64(64 - min(bits, 26))
        self.shift = np.full(1 << min(bits, 26), reach + 1, np.uint8)
        for k in range(reach + 1):  # later places are nearer to the end
            ends = self.starts + self.block - 1 + k
            self.shift[self.block_at(words, ends) >> self.slots] = reach - k
        key = self.bucket(words, self.starts + length - 1)
        self.order = np.argsort(key, kind="stable")
        self.buckets = key[self.order]

    def block_at(self, w: Words, ends: np.ndarray) -> np.ndarray:
        h = w.hashes[ends]
        return mixed(h if self.block == 1 else w.hashes[ends - 1] * _SALT + h)

    def bucket(self, w: Words, ends: np.ndarray) -> np.ndarray:
        """The hash of a window's last block, with that of its first."""
        last = self.block_at(w, ends)
        return mixed(last + _SALT * self.block_at(w, ends - self.length + self.block))

    def possible_ends(self, w: Words) -> np.ndarray:
        """Positions at which no table rules out that a window ends.

        Texts are cut into lanes of end positions, which all move on by their own shifts.
        """
        count = np.maximum(np.diff(w.bounds) - self.length + 1, 0)
        lanes = -(-count // LANE)
        at = np.repeat(w.bounds[:-1] + self.length - 1, lanes) + ranges(lanes) * LANE
        upto = np.minimum(at + LANE, np.repeat(w.bounds[1:], lanes))
        found = []
        while len(at):
            step = self.shift[self.block_at(w, at) >> self.slots]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            on = at < upto
            at, upto = at[on], upto[on]
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def found(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """End position and window of every occurrence."""
        ends = self.possible_ends(w)
        key = self.bucket(w, ends)
        low = np.searchsorted(self.buckets, key)
        count = np.searchsorted(self.buckets, key, side="right") - low
        ends = np.repeat(ends, count)
        window = self.order[np.repeat(low, count) + ranges(count)]
        same = same_words(w, ends - self.length + 1, self.words, self.starts[window], self.length)
        return ends[same], window[same]


@dataclass
class Passages:
    """Tables of some items, one for each length of window, and the items' names."""

    names: list[str]
    tables: list[Windows]

    @classmethod
    def of(cls, names: list[str], texts: pa.Array, size: int) -> Passages:
        w = words_of(texts)
        count = np.diff(w.bounds)
        named = sorted(set(names))
        number = {n: i for i, n in enumerate(named)}
        item = np.array([number[n] for n in names], np.int64)
        tables = []
        for length in range(1, size + 1):
            whole = np.flatnonzero(count >= size if length == size else count == length)
            if len(whole):
                many = count[whole] - length + 1
                starts = np.repeat(w.bounds[whole], many) + ranges(many)
                tables.append(Windows(w, starts, np.repeat(item[whole], many), length))
        return cls(named, tables)

    def search(self, w: Words) -> tuple[np.ndarray, list[set[str]]]:
        """How often each word begins being inside an occurrence, less how often it ends
        (one entry more than words), and the items found in each text."""
        edges = np.zeros(len(w.hashes) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(len(w))]
        for table in self.tables:
            ends, window = table.found(w)
            np.add.at(edges, ends - table.length + 1, 1)
            np.add.at(edges, ends + 1, -1)
            document = np.searchsorted(w.bounds, ends, side="right") - 1
            pairs = np.unique(document * len(table.starts) + window)
            document, window = np.divmod(pairs, len(table.starts))
            many = table.items_from[window + 1] - table.items_from[window]
            run = (np.cumsum(many) - many) // EXPANDED
            for a, b in zip(*_runs(run), strict=True):
                n = many[a:b]
                item = table.item[np.repeat(table.items_from[window[a:b]], n) + ranges(n)]
                for pair in np.unique(np.repeat(document[a:b], n) * len(self.names) + item).tolist():
                    d, i = divmod(pair, len(self.names))
                    items[d].add(self.names[i])
        return edges, items


def _runs(x: np.ndarray) -> tuple[list[int], list[int]]:
    """Bounds of runs of equal values."""
    if not len(x):
        return [], []
    cuts = (np.flatnonzero(np.diff(x)) + 1).tolist()
    return [0, *cuts], [*cuts, len(x)]


def _passages(folder: str, size: int) -> Passages:
    """The tables of a written block of items; a worker keeps the last block it used."""
    cache = worker_cache("passages")
    if cache.get("passages", (None,))[0] != (folder, size):
        from pyarrow import parquet

        cache.pop("passages", None)
        store, paths = part_files(folder)
        tables = []
        for path in paths:
            with store.open_input_file(path) as data:
                tables.append(parquet.read_table(data, columns=["name", "text"]))
        items = pa.concat_tables(tables).combine_chunks() if tables else pa.table({"name": [], "text": []})
        texts = items["text"].cast(pa.string()).combine_chunks()
        texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks or [pa.array([], pa.string())])
        cache["passages"] = (folder, size), Passages.of(items["name"].to_pylist(), texts, size)
    return cache["passages"][1]


def _spans(inside: np.ndarray) -> list[dict]:
    border = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    return [{"start": a, "end": b} for a, b in border.reshape(-1, 2).tolist()]


def benchmark_passages(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document ``doc_id, n_words, spans, items``: where it repeats the benchmark.

    Words are runs of ASCII letters and digits and of non-ASCII characters; A to Z count as
    lower case. An occurrence is a window of ``size`` consecutive words of an item, or all
    words of a shorter item. ``spans`` are the merged ranges of words inside occurrences,
    ``items`` the distinct ids of the items with one, as sorted text.

    One pass over the documents, nothing of which is shuffled. The benchmark is written to
    the shared folder in blocks of about ``block_bytes`` of text, dealt by item id; a task
    goes over its batch of texts once for each block and holds one block's tables, so the
    benchmark may be of any size.

    NULL and empty texts have no words: such documents have no spans, such items no
    windows. An item without id is named ''. Rows of one item id count as one item,
    repeated documents each for themselves. Empty tables give no rows or no spans. Other
    columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("text")
    ).filter("text <> ''")
    held = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-held // block_bytes)
    folder = shared_folder(spark)
    block = F.pmod(F.xxhash64("name"), F.lit(max(1, blocks))).alias("block")
    items.select("*", block).repartition(max(1, blocks), "block").write.partitionBy("block").parquet(folder)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(slices(batch, 1))
            edges: list = [0] * len(parts)
            items: list = [[set() for _ in range(p.num_rows)] for p in parts]
            for k in range(blocks):
                passages = _passages(f"{folder}/block={k}", size)
                for i, part in enumerate(parts):
                    more, found = passages.search(words_of(part.column(1)))
                    edges[i] = edges[i] + more
                    for own, new in zip(items[i], found, strict=True):
                        own |= new
            for i, part in enumerate(parts):
                w = words_of(part.column(1))
                inside = np.cumsum(edges[i])[:-1] > 0 if blocks else np.zeros(len(w.hashes), bool)
                bounds = w.bounds.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.diff(w.bounds)),
                        pa.array([_spans(inside[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
                                 pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()}))),
                        pa.array([sorted(x) for x in items[i]], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "n_words", "spans", "items"],
                )

    schema = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(search, schema)


def hit_words(spans: str = "spans") -> Column:
    """Words inside occurrences."""
    return F.aggregate(F.transform(spans, lambda s: s["end"] - s["start"]), F.lit(0).cast("long"), lambda a, b: a + b)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, **names: str) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, from
    :func:`benchmark_passages`."""
    return benchmark_passages(docs, benchmark, size, **names).select(
        "doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
