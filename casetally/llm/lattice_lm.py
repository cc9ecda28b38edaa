"""Subword lattice likelihood: the marginal over all segmentations of a text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.llm.common import fold_of, stored, text_or_empty
from casetally.llm.words import Words, mixed, slices, split_words

MARK = "▁"  # stands before the first piece of a word
_BASE = np.uint64(0x100000001B3)
_ROW = 50_000
LONG = 64  # bytes, beyond which a word's lattice is held in stretches
STRETCH = 4096
NEVER = -1e300


@dataclass
class Lattice:
    """Pieces by kind and hash. ``first`` begin a word (their mark left out), ``inner`` go
    anywhere behind. ``scores`` are natural logarithms by piece number; the last three
    numbers are the bare mark, the end of a text and a filler that never fits."""

    first: tuple[np.ndarray, np.ndarray]  # sorted hashes, piece numbers
    inner: tuple[np.ndarray, np.ndarray]
    longest: int
    scores: np.ndarray

    @classmethod
    def of(cls, pieces: dict[str, float]) -> Lattice:
        """From a vocabulary with scores; single bytes are pieces as well.

        The scores only rank pieces in vocabularies made by merges, so a piece of rank r
        starts with a weight of 1 / (r + 10).
        """
        ranked = sorted(pieces.items(), key=lambda p: (-p[1], p[0]))
        found: dict[tuple[bool, bytes], int] = {}
        weights: list[float] = []
        for rank, (piece, _) in enumerate(ranked):
            begins = piece.startswith(MARK)
            body = piece[1:] if begins else piece
            if body and MARK not in body and (begins, body.encode()) not in found:
                found[begins, body.encode()] = len(weights)
                weights.append(1 / (rank + 10))
        for b in range(256):
            if (False, bytes([b])) not in found:
                found[False, bytes([b])] = len(weights)
                weights.append(1 / (len(ranked) + 10))
        weights += [1 / 20, 1 / 100]

        def table(begins: bool) -> tuple[np.ndarray, np.ndarray]:
            own = [(hash_of(b), i) for (k, b), i in found.items() if k == begins]
            own.sort()
            return (np.array([h for h, _ in own], np.uint64), np.array([i for _, i in own], np.int64))

        longest = max(len(b) for _, b in found)
        p = np.array(weights)
        return cls(table(True), table(False), longest, np.append(np.log(p / p.sum()), NEVER))

    @property
    def bare(self) -> int:
        return len(self.scores) - 3

    @property
    def end(self) -> int:
        return len(self.scores) - 2

    @property
    def never(self) -> int:
        return len(self.scores) - 1

    def state(self) -> tuple:
        return self.first, self.inner, self.longest, self.scores

    def find(self, table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
        keys, numbers = table
        spot = np.searchsorted(keys, hashes)
        spot[spot == len(keys)] = 0
        return np.where(keys[spot] == hashes, numbers[spot], self.never)

    def edges(self, letters: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """``start, end, piece numbers`` of equally long words; a start of -1 has the mark."""
        m, n = letters.shape
        prefix = np.zeros((n + 1, m), np.uint64)
        for j in range(n):
            prefix[j + 1] = prefix[j] * _BASE + (letters[:, j].astype(np.uint64) + np.uint64(1))
        out = []
        for end in range(1, n + 1):
            if end <= self.longest:
                out.append((-1, end, self.find(self.first, prefix[end])))
            for start in range(max(0, end - self.longest), end):
                power = np.uint64(pow(int(_BASE), end - start, 1 << 64))
                ids = self.find(self.inner, prefix[end] - prefix[start] * power)
                if start == end - 1 or (ids != self.never).any():
                    out.append((start, end, ids))
        return out

    def forward(self, n: int, m: int, edges: list) -> np.ndarray:
        """Row e: the logarithm of all ways to write the mark and the first e bytes."""
        alpha = np.full((n + 1, m), NEVER)
        alpha[0] = self.scores[self.bare]
        for start, end, ids in edges:
            way = self.scores[ids] + (alpha[start] if start >= 0 else 0.0)
            alpha[end] = np.logaddexp(alpha[end], way)
        return alpha

    def expected(self, n: int, m: int, edges: list, alpha: np.ndarray, times: np.ndarray, into: np.ndarray) -> None:
        """Add how often each piece is expected in the words, each counted ``times``."""
        beta = np.full((n + 1, m), NEVER)
        beta[n] = 0.0
        for start, end, ids in reversed(edges):
            score = self.scores[ids]
            if start >= 0:
                beta[start] = np.logaddexp(beta[start], score + beta[end])
        for start, end, ids in edges:
            way = self.scores[ids] + beta[end] - alpha[n] + (alpha[start] if start >= 0 else 0.0)
            into += np.bincount(ids, np.exp(np.minimum(way, 0.0)) * times, len(into))
        into[self.bare] += (np.exp(np.minimum(alpha[0] + beta[0] - alpha[n], 0.0)) * times).sum()

    def words(self, w: Words, index: np.ndarray, times: np.ndarray | None = None, into: np.ndarray | None = None) -> np.ndarray:
        """Logarithms of the probabilities of words ``index`` of ``w``, whatever their length."""
        length = (w.ends - w.starts)[index]
        out = np.empty(len(index))
        order = np.argsort(length, kind="stable")
        at = 0
        while at < len(order):
            n = int(length[order[at]])
            if n > LONG:
                for i in order[at:]:
                    out[i] = self.long_word(
                        w.data[w.starts[index[i]] : w.ends[index[i]]], into, 1 if times is None else times[i]
                    )
                break
            stop = min(int(np.searchsorted(length[order], n, side="right")), at + _ROW)
            own = order[at:stop]
            letters = w.data[w.starts[index[own]][:, None] + np.arange(n)]
            edges = self.edges(letters)
            alpha = self.forward(n, len(own), edges)
            out[own] = alpha[n]
            if into is not None:
                self.expected(n, len(own), edges, alpha, times[own], into)
            at = stop
        return out

    def long_word(self, letters: np.ndarray, into: np.ndarray | None, times: float) -> float:
        """The same recursions for one long word, in stretches that bound its memory.

        Only the forward and backward values are held for the whole word; the edges of a
        stretch of ends are found at once, and found again on the way back.
        """
        n = len(letters)
        alpha = np.full(n + 1, NEVER)
        alpha[0] = self.scores[self.bare]
        for low in range(0, n, STRETCH):
            inner, marked = self.stretch(letters, low)
            for end, ids, first in zip(range(low + 1, n + 1), inner, marked, strict=False):
                size = min(end, len(ids))
                ways = alpha[end - size : end][::-1] + self.scores[ids[:size]]
                ways = np.append(ways, self.scores[first])
                top = ways.max()
                alpha[end] = top + math.log(np.exp(ways - top).sum())
        if into is None:
            return alpha[n]
        beta = np.full(n + 1, NEVER)
        beta[n] = 0.0
        for low in reversed(range(0, n, STRETCH)):
            inner, marked = self.stretch(letters, low)
            share = np.zeros(inner.shape)
            ends = np.arange(low + 1, low + 1 + len(inner))
            for k in range(len(inner) - 1, -1, -1):
                end, ids = low + 1 + k, inner[k]
                size = min(end, len(ids))
                rest = self.scores[ids[:size]] + beta[end]
                before = beta[end - size : end][::-1]
                before[:] = np.logaddexp(before, rest)
                share[k, :size] = rest + alpha[end - size : end][::-1] - alpha[n]
            share = np.where(inner == self.never, 0.0, np.exp(np.minimum(share, 0.0)))
            into += np.bincount(inner.ravel(), share.ravel() * times, len(into))
            whole = np.exp(np.minimum(self.scores[marked] + beta[ends] - alpha[n], 0.0))
            into += np.bincount(marked, whole * times, len(into))
        into[self.bare] += math.exp(min(alpha[0] + beta[0] - alpha[n], 0.0)) * times
        return alpha[n]

    def stretch(self, letters: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
        """For the ends ``low + 1`` to ``low + STRETCH``: the inner pieces that reach them,
        by length from 1 on, and the piece that begins the word and reaches them."""
        high = min(len(letters), low + STRETCH)
        base = max(0, low - self.longest)
        part = letters[base:high].astype(np.uint64) + np.uint64(1)
        ends = np.arange(low + 1, high + 1)
        rolled = np.zeros(len(ends), np.uint64)
        power = np.uint64(1)
        most = min(self.longest, high)
        inner = np.full((len(ends), most), self.never)
        marked = np.full(len(ends), self.never)
        for size in range(1, most + 1):
            start = ends - size
            fits = start >= base
            rolled[fits] += part[start[fits] - base] * power
            with np.errstate(over="ignore"):
                power = power * _BASE
            inner[:, size - 1] = np.where(fits, self.find(self.inner, rolled), self.never)
            whole = np.flatnonzero(start == 0)
            marked[whole] = self.find(self.first, rolled[whole])
        return inner, marked


def hash_of(data: bytes) -> int:
    h = 0
    for b in data:
        h = (h * int(_BASE) + b + 1) % (1 << 64)
    return h


def vocabulary_of(path: str) -> dict[str, float]:
    """Pieces and scores of a sentence-piece model, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


def lattice_scores(
    docs: DataFrame, path: str, folds: int = 10, frequent: int = 1 << 18, smoothing: float = 0.1,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per document ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Texts are words (ASCII letters in lower case) and an end. ``score`` is the log10 of the
    probability that pieces of the vocabulary, drawn independently, write the text: each
    word the mark and its bytes, in any segmentation, summed by the forward recursion; the
    end is a piece of its own. Piece probabilities are expected counts over the training
    documents (fold other than 0) under the weights that the vocabulary's ranks give, plus
    ``smoothing`` each. ``base_score`` is the smoothed unigram model of whole words.

    One pass counts words and expected pieces, by 64-bit hash and in partial sums. Words
    that make up at least 1/``frequent`` of all tokens, of which there can be no more than
    ``frequent``, are known to every task; the second pass sends only the other words of a
    document to their counts, so no word is a hot key. NULL and empty texts hold just the
    end; a NULL id counts as the empty text in its fold. An empty table gives no rows.
    """
    spark = docs.sparkSession
    start = spark.sparkContext.broadcast(Lattice.of(vocabulary_of(path)).state())
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"),
        (fold_of(doc_id, folds) == 0).alias("held_out"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*start.value)
        pieces = np.zeros(len(lattice.scores))
        texts = 0
        for batch in batches:
            for part in slices(batch, 0, 12 << 20):
                w = split_words(part.column(0), lower=True)
                texts += len(w)
                _, first, n = np.unique(w.hashes, return_index=True, return_counts=True)
                lattice.words(w, first, n.astype(np.float64), pieces)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(len(first), np.int32)), pa.array(w.hashes[first].view(np.int64)),
                    pa.array(n.astype(np.int64)), pa.array(np.zeros(len(first))),
                ], names=["kind", "key", "n", "x"])
        pieces[lattice.end] += texts
        yield pa.RecordBatch.from_arrays([
            pa.array(np.ones(len(pieces), np.int32)), pa.array(np.arange(len(pieces))),
            pa.array(np.where(np.arange(len(pieces)) == lattice.end, texts, 0)), pa.array(pieces),
        ], names=["kind", "key", "n", "x"])

    counted = stored(
        rows.filter("NOT held_out").select("text")
        .mapInArrow(count, "kind int, key long, n long, x double")
        .groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    )
    counts = counted.filter("kind = 0").select(F.col("key").alias("word"), F.col("n").alias("c"))
    words = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    learned = Lattice(*start.value)
    expected = np.zeros(len(learned.scores))
    ends = 0
    for key, n, x in counted.filter("kind = 1").select("key", "n", "x").collect():
        expected[key], ends = x, ends + n
    expected[:-1] += smoothing
    learned.scores = np.append(np.log(expected[:-1] / expected[:-1].sum()), NEVER)
    total, distinct = words[1] + ends, words[0] + (1 if ends else 0)
    least = max(1, -(-total // frequent))
    often = counts.filter(F.col("c") >= least).collect()
    known = np.array([r[0] for r in often], np.int64).view(np.uint64)
    by_hash = np.argsort(known)
    shared = spark.sparkContext.broadcast((
        learned.state(), known[by_hash], np.array([r[1] for r in often], np.int64)[by_hash], ends,
    ))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, keys, c, ends = shared.value
        lattice = Lattice(*state)
        cache, older = {}, {}  # word probabilities by hash, of late and of the time before
        for batch in batches:
            for part in slices(batch, 2, 4 << 20):
                w = split_words(part.column(2), lower=True)
                unique, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
                p = np.array([cache.get(h, math.nan) for h in unique.tolist()])
                miss = np.flatnonzero(np.isnan(p))
                if older and len(miss):
                    p[miss] = [older.get(h, math.nan) for h in unique[miss].tolist()]
                    miss = np.flatnonzero(np.isnan(p))
                p[miss] = lattice.words(w, first[miss])
                if len(cache) > 300_000:
                    cache, older = {}, cache
                cache.update(zip(unique.tolist(), p.tolist(), strict=True))
                n, document = np.diff(w.bounds), w.document
                own = np.bincount(document, p[inverse], len(w))

                spot = np.searchsorted(keys, unique)
                spot[spot == len(keys)] = 0
                often = keys[spot] == unique if len(keys) else np.zeros(len(unique), bool)
                logs = np.where(often, np.log10((c[spot] if len(keys) else spot) + 0.1), 0.0)
                common = often[inverse]
                n_common = np.concatenate([[0], np.cumsum(common)])
                rare = np.flatnonzero(~common)
                uid = np.asarray(part.column(0)).astype(np.int64)
                k = len(w)
                base = np.bincount(document, logs[inverse], k) + math.log10(ends + 0.1)
                # A row for each text, under a key of its own, and one for each rare word.
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(mixed(uid.view(np.uint64) + np.uint64(k)).view(np.int64)),
                    pa.array(np.zeros(k, np.int32)), part.column(1), part.column(3),
                    pa.array(n + 1), pa.array(n_common[w.bounds[1:]] - n_common[w.bounds[:-1]] + (ends > 0)),
                    pa.array(base), pa.array((own + lattice.scores[lattice.end]) / math.log(10)),
                ], names=names)
                if len(rare):
                    pair = document[rare].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.hashes[rare]
                    _, at, tf = np.unique(pair, return_index=True, return_counts=True)
                    at, m = rare[at], len(at)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(uid[document[at]]), pa.array(w.hashes[at].view(np.int64)),
                        pa.array(tf.astype(np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()),
                        pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()),
                        pa.nulls(m, pa.float64()),
                    ], names=names)

    schema = ("uid long, word long, tf int, doc_id long, held_out boolean, n_tokens long, n_common long, "
              "log_common double, score double")
    names = [x.split()[0] for x in schema.split(", ")]
    sent = rows.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "text", "held_out"
    ).mapInArrow(score, schema)
    tf, c = F.col("tf"), F.coalesce(F.col("c"), F.lit(0))
    rest = counts.filter(F.col("c") < least)
    return (
        sent.join(rest, "word", "left").groupBy("uid").agg(
            F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            (F.sum("n_common") + F.sum(F.when(c > 0, tf).otherwise(0))).alias("n_known"),
            (F.sum("log_common") + F.sum(tf * F.log10(c + F.lit(0.1)))).alias("_logs"),
            F.max("score").alias("score"),
        ).select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"),
            (F.col("_logs") - F.col("n_tokens") * math.log10(total + 0.1 * (distinct + 1))).alias("base_score"),
            "score",
        )
    )
