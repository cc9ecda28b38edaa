"""Exact duplicates through counting quotient filters, confirmed on bytes."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.llm.common import SPACE, rows_for, stored, text_or_empty, thinned

RUNS_SCHEMA = "range long, filter binary"
MOST_HELD = 8_000_000  # fingerprints of one partition that are held before filters are written


class QuotientFilter:
    """A packed counting quotient filter: exact counts of ``bits``-bit fingerprints.

    A fingerprint is split into quotient (``q`` high bits) and remainder. ``occupied`` has a
    bit per quotient that occurs, ``ends`` a bit per slot that is the last of its quotient's
    run. Slots hold the remainders, ascending within a run, at their exact width. A bit per
    slot in ``repeated`` tells counts above one, and only these have a counter, of as many
    seven-bit groups as it needs. No bit of a fingerprint is dropped, so merging is lossless.
    """

    def __init__(
        self, bits: int, q: int, n: int, occupied: np.ndarray, ends: np.ndarray,
        remainders: np.ndarray, repeated: np.ndarray, counters: np.ndarray,
    ):
        self.bits, self.q, self.n, self.occupied, self.ends = bits, q, n, occupied, ends
        self.remainders, self.repeated, self.counters = remainders, repeated, counters

    @classmethod
    def of(cls, fingerprints: np.ndarray, bits: int = 64) -> QuotientFilter:
        """From unsigned fingerprints in any order, each as often as it is there."""
        return cls._packed(*np.unique(fingerprints, return_counts=True), bits)

    @classmethod
    def _packed(cls, values: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From distinct ascending fingerprints."""
        n = len(values)
        q = min(bits - 1, max(1, n.bit_length() - 1))
        width = bits - q
        quotient = values >> np.uint64(width)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient.astype(np.int64)] = True
        ends = np.ones(n, bool)
        ends[:-1] = quotient[1:] != quotient[:-1]
        repeated = counts > 1
        return cls(
            bits, q, n, np.packbits(occupied), np.packbits(ends),
            _pack(values & np.uint64((1 << width) - 1), width), np.packbits(repeated),
            _counters(counts[repeated].astype(np.uint64) - np.uint64(2)),
        )

    def fingerprints(self) -> np.ndarray:
        """All distinct fingerprints, ascending: the k-th run belongs to the k-th used quotient."""
        used = np.flatnonzero(np.unpackbits(self.occupied, count=1 << self.q)).astype(np.uint64)
        ends = np.unpackbits(self.ends, count=self.n).astype(np.int64)
        width = self.bits - self.q
        return (used[np.cumsum(ends) - ends] << np.uint64(width)) | _unpack(self.remainders, width, self.n)

    @property
    def counts(self) -> np.ndarray:
        counts = np.ones(self.n, np.int64)
        counts[np.unpackbits(self.repeated, count=self.n).astype(bool)] = _counted(self.counters) + 2
        return counts

    def merged(self, other: QuotientFilter) -> QuotientFilter:
        """Runs of both in step: a remainder of both gets the sum, others keep their place.

        Both are in order already, so the smaller's entries are looked up in the larger's
        and inserted; nothing is sorted. The wider quotient follows from the new number.
        """
        large, small = (self, other) if self.n >= other.n else (other, self)
        values, counts = large.fingerprints(), large.counts
        more, times = small.fingerprints(), small.counts
        spot = np.searchsorted(values, more)
        known = np.zeros(len(more), bool)
        inside = spot < len(values)
        known[inside] = values[spot[inside]] == more[inside]
        counts[spot[known]] += times[known]
        new = ~known
        return self._packed(
            np.insert(values, spot[new], more[new]), np.insert(counts, spot[new], times[new]), self.bits
        )

    def to_bytes(self) -> bytes:
        head = np.array([self.bits, self.q, self.n], "<u4")
        return b"".join(a.tobytes() for a in (
            head, self.occupied, self.ends, self.repeated, self.remainders, self.counters
        ))

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        bits, q, n = (int(x) for x in np.frombuffer(data, "<u4", 3))
        body, slots = np.frombuffer(data, np.uint8, offset=12), -(-n // 8)
        sizes = (-(-(1 << q) // 8), slots, slots, _packed_size(bits - q, n))
        occupied, ends, repeated, remainders, counters = np.split(body, np.cumsum(sizes))
        return cls(bits, q, n, occupied, ends, remainders, repeated, counters)


def _packed_size(width: int, n: int) -> int:
    return n * (width // 8) + -(-n * (width % 8) // 8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits a value: the whole bytes, then the odd bits of all values."""
    whole, odd = divmod(width, 8)
    octets = values.astype("<u8").view(np.uint8).reshape(len(values), 8)
    if not odd:
        return octets[:, :whole].ravel()
    rest = np.unpackbits(octets[:, whole : whole + 1], axis=1, bitorder="little")[:, :odd]
    return np.concatenate([octets[:, :whole].ravel(), np.packbits(rest)])


def _unpack(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    whole, odd = divmod(width, 8)
    octets = np.zeros((n, 8), np.uint8)
    octets[:, :whole] = packed[: n * whole].reshape(n, whole)
    if odd:
        rest = np.unpackbits(packed[n * whole :], count=n * odd).reshape(n, odd)
        octets[:, whole] = np.packbits(rest, axis=1, bitorder="little")[:, 0]
    return octets.reshape(-1).view("<u8").astype(np.uint64)


def _counters(values: np.ndarray) -> np.ndarray:
    """Seven bits a byte, low ones first; the high bit says that another byte follows."""
    size = np.ones(len(values), np.int64)
    for k in range(1, 10):
        size += values >> np.uint64(7 * k) > 0
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        own = size > k
        group = (values[own] >> np.uint64(7 * k)).astype(np.uint8) & np.uint8(127)
        out[first[own] + k] = group | ((size[own] > k + 1).astype(np.uint8) << np.uint8(7))
    return out


def _counted(octets: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(octets < 128)
    first = np.concatenate([[0], last[:-1] + 1]).astype(np.int64)[: len(last)]
    at = np.arange(len(octets)) - np.repeat(first, last - first + 1)
    groups = (octets & 127).astype(np.int64) << (7 * at)
    return np.add.reduceat(groups, first) if len(first) else np.zeros(0, np.int64)


def repeated_fingerprints(prints: DataFrame, column: str, per_range: int = 500_000) -> DataFrame:
    """Fingerprints that occur more than once: ``column, times``.

    Every partition builds one filter per range of fingerprints from its own rows, which
    already adds up its copies. Filters of a range then meet and merge, those of like size
    first. Ranges are cut by the leading bits of the hash so that one holds about
    ``per_range`` fingerprints, and filters hold what lies above their range's start.
    """
    ranges = rows_for(prints.count(), per_range)
    heads = -(-(1 << 32) // ranges)  # of the leading 32 bits, at most so many are in a range
    bits = 32 + (heads - 1).bit_length()

    def start(of_range: np.ndarray) -> np.ndarray:
        return (-(-(of_range << 32) // ranges)).astype(np.uint64) << np.uint64(32)

    def filters_of(values: np.ndarray) -> pd.DataFrame:
        spot = ((values >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        order = np.argsort(spot, kind="stable")
        values, spot = values[order], spot[order]
        cuts = np.flatnonzero(np.diff(spot)) + 1
        own = spot[np.concatenate([[0], cuts])].astype(np.int64)
        parts = [
            QuotientFilter.of(v - low, bits).to_bytes()
            for v, low in zip(np.split(values, cuts), start(own), strict=True)
        ]
        return pd.DataFrame({"range": own, "filter": parts})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch[column].to_numpy(np.int64).view(np.uint64))
            n += len(batch)
            if n >= MOST_HELD:
                yield filters_of(np.concatenate(held))
                held, n = [], 0
        if n:
            yield filters_of(np.concatenate(held))

    def merge(batch: pd.DataFrame) -> pd.DataFrame:
        total = QuotientFilter.of(np.empty(0, np.uint64), bits)
        waiting: list[QuotientFilter] = []
        for data in batch["filter"]:
            waiting.append(QuotientFilter.from_bytes(data))
            while len(waiting) > 1 and waiting[-2].n <= 2 * waiting[-1].n:
                waiting[-2:] = [waiting[-2].merged(waiting[-1])]
        for f in reversed(waiting):
            total = total.merged(f)
        counts = total.counts
        found = total.fingerprints()[counts > 1] + start(batch["range"].to_numpy()[:1])
        return pd.DataFrame({column: found.view(np.int64), "times": counts[counts > 1]})

    filters = prints.select(column).mapInPandas(build, RUNS_SCHEMA)
    return filters.groupBy("range").applyInPandas(merge, f"{column} long, times long")


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE, "")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256`` and ``_chars``.

    Texts are equal when they are the same bytes without white space; NULL counts as
    empty, so empty, NULL and blank texts form one group. Of a group the row with the
    most code points stays, then the smallest id; a NULL id comes last. Rows that agree
    in all of this, repeated rows, have the same values and are all marked ``kept``:
    they cannot be told apart by them (:func:`without_copies` leaves one).

    Fingerprints seen once need no look at their text again. Only texts of repeated
    fingerprints are shuffled and grouped by their bytes, copies being added up before
    the shuffle; a group's members then get its decision by a join of narrow rows.
    """
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.char_length(text_or_empty(text)).alias("_chars"),
        normalised(text).alias("_norm"),
    ).withColumn("_print", F.xxhash64("_norm"))
    rows = stored(texts.select("doc_id", "_chars", "_print", F.sha2("_norm", 256).alias("text_sha256")))
    repeated = stored(repeated_fingerprints(rows, "_print"))

    # Length and id in one ordered number, so that the aggregate stays a hash aggregate.
    # 0 stands for a NULL id, below 2^64 - (id + 2^63) of every other.
    place = F.coalesce(
        F.lit(Decimal(2**63)) - F.col("doc_id").cast("decimal(20,0)"),
        F.lit(0).cast("decimal(21,0)"),
    ).cast("decimal(38,0)")
    step = F.lit(Decimal(2**65))
    best = (F.col("_chars").cast("decimal(11,0)") * step).cast("decimal(38,0)") + place
    groups = stored(
        texts.join(repeated.select("_print"), "_print", "left_semi")
        .groupBy("_print", "_norm")
        .agg(F.max(best.cast("decimal(38,0)")).alias("_best"), F.count("*").alias("group_size"))
        .select(
            F.sha2("_norm", 256).alias("text_sha256"), "group_size",
            F.floor(F.col("_best") / step).alias("_most"), (F.col("_best") % step).alias("_place"),
        )
        .select(
            "text_sha256", "group_size", F.col("_most").cast("int").alias("_most"),
            F.when(F.col("_place") > 0, (F.lit(Decimal(2**63)) - F.col("_place")).cast("long"))
            .alias("keep_id"),
        )
    )
    joined = rows.join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    stays = (F.col("_chars") == F.col("_most")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | stays).alias("kept"), "text_sha256", "_chars",
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` with one row per group of equal texts, all columns as they were.

    Rows that agree in id, length and normalised text are reduced to one of them. What has
    no copy passes without being grouped or numbered.
    """
    keys = F.xxhash64("doc_id", F.col("doc_id").isNull(), "_chars").alias("_dup_row")
    copies = stored(
        exact_duplicates(docs, doc_id, text).filter("group_size > 1")
        .groupBy(keys, F.col("text_sha256").alias("_dup_text"))
        .agg(F.bool_or("kept").alias("_dup_kept"), F.count("*").alias("_dup_times"))
    )
    chars = F.char_length(text_or_empty(text))
    keyed = {
        "_dup_row": F.xxhash64(F.col(doc_id).cast("long"), F.col(doc_id).isNull(), chars),
        "_dup_text": F.sha2(normalised(text), 256),
    }
    return thinned(
        docs, keyed, out=copies.filter("NOT _dup_kept"), once=copies.filter("_dup_kept AND _dup_times > 1")
    )
