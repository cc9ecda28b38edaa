"""Byte-level BPE by dynamic programming over byte prefixes."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetally.llm.common import text_or_empty, worker_cache

MOST_VOCABULARY_BYTES = 64 << 20

# Unicode white space. Words with at most one blank before them, or runs of white space cut
# where the common split pattern of byte-level vocabularies cuts them: no piece of that
# pattern crosses the end of such a chunk.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_CHUNKS = rf" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"


class ByteBpe:
    """Encoder and decoder for a vocabulary of byte strings by rank.

    For each prefix of a piece the last token of its encoding is stored. That token is
    unique: a token may end a prefix only if, joined to the last token of the prefix
    before it, the two would come out of the merges unchanged, and exactly one does.
    Following last tokens back from the end gives the encoding.
    """

    def __init__(
        self, ranks: dict[bytes, int], pattern: str, chunks: str | None = None, cached: int = 400_000,
    ):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pieces = regex.compile(pattern)
        # A quicker pattern whose matches hold whole pieces, so that chunks can be looked up.
        self.chunks = re.compile(chunks) if chunks else self.pieces
        self.longest = max(map(len, ranks))
        self.cached = cached
        self._pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        # Encodings of short chunks: those of late, and those of the time before.
        self._seen: dict[str, list[int]] = {}
        self._older: dict[str, list[int]] = {}

    @classmethod
    def from_file(cls, data: bytes, pattern: str, chunks: str | None = None) -> ByteBpe:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        return cls(ranks, pattern, chunks)

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of ``token`` joins.

        None for a single byte, and ``(-1, -1)`` for a token that no merges lead to.
        """
        found = self._halves.get(token, 0)
        if found == 0:
            data = self.tokens[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                rank, i = min(
                    (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)
                )
                if rank == 1 << 60:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if len(parts) == 1:
                found = None
            elif len(parts) == 2:
                found = (self.ranks[parts[0]], self.ranks[parts[1]])
            else:
                found = (-1, -1)
            self._halves[token] = found
        return found

    def stands_alone(self, token: int) -> bool:
        return self.halves(token) != (-1, -1)

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right``, put together, as they are.

        Next to the border stand ever larger parts of both tokens, in the order of their
        ranks. The border is lost if two parts that stand there together form a token
        whose turn comes before either part is taken up by its own side; of equal ranks
        the one further left comes first.
        """
        pair = left << 32 | right
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= 2 * self.cached:
                self._pairs.clear()
            known = self._pairs[pair] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        a, b = [left], [right]  # parts at the border, the whole token first
        while halves := self.halves(a[-1]):
            a.append(halves[1])
        while halves := self.halves(b[-1]):
            b.append(halves[0])
        tokens, ranks, never = self.tokens, self.ranks, 1 << 60
        i, j = len(a) - 1, len(b) - 1
        while True:
            next_a = a[i - 1] if i else never
            next_b = b[j - 1] if j else never
            joined = ranks.get(tokens[a[i]] + tokens[b[j]], never)
            if joined < never and joined < next_a and joined <= next_b:
                return False
            if next_a == never and next_b == never:
                return True
            if next_a <= next_b:
                i -= 1
            else:
                j -= 1

    def extend(self, data: bytes, last: list[int]) -> None:
        """Fill ``last`` up to ``len(data)``; ``last[i]`` belongs to the prefix of i + 1 bytes."""
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = self.ranks.get(data[start:end])
                if token is not None and self.stands_alone(token) and (
                    start == 0 or self.may_follow(last[start - 1], token)
                ):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary cannot encode every byte string")

    def last_of(self, data: bytes, end: int, last: list[int | None]) -> int:
        """The same for one prefix of a short piece, filling only the rows it rests on."""
        rank, pairs = self.ranks.get, self._pairs.get
        for start in range(end):
            token = rank(data[start:end])
            if token is not None:
                if start:
                    before = last[start - 1]
                    if before is None:
                        before = self.last_of(data, start, last)
                    fits = pairs(before << 32 | token)
                    if fits is None:
                        fits = self.stands_alone(token) and self.may_follow(before, token)
                else:
                    fits = self.stands_alone(token)
                if fits:
                    last[end - 1] = token
                    return token
        raise ValueError("the vocabulary cannot encode every byte string")

    def walk_back(self, last: list[int]) -> list[int]:
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.tokens[last[at - 1]])
        return out[::-1]

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) <= 64:
            last: list = [None] * len(data)
            self.last_of(data, len(data), last)
        else:
            last = []
            self.extend(data, last)
        return self.walk_back(last)

    def encode_chunk(self, chunk: str) -> list[int]:
        found = self._older.get(chunk)
        if found is None:
            found = []
            for piece in self.pieces.findall(chunk):
                # Most chunks are one piece, or a word and its punctuation.
                if piece is chunk or piece == chunk or len(piece) > 64:
                    found += self.encode_piece(piece)
                else:
                    found += self._seen.get(piece) or self.keep(piece, self.encode_piece(piece))
        return self.keep(chunk, found) if len(chunk) <= 64 else found

    def keep(self, chunk: str, ids: list[int]) -> list[int]:
        if len(self._seen) >= self.cached:
            self._older, self._seen = self._seen, {}
        self._seen[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        seen, add = self._seen.get, self.encode_chunk
        for chunk in self.chunks.findall(text):
            out += seen(chunk) or add(chunk)
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixEncoding:
    """One piece's prefix table, kept for exact appends and re-encoding near edits.

    The table of a prefix does not depend on what follows, so an append only adds rows
    and an edit keeps all rows before it. After the edit the old rows hold again from
    the point where as many rows as the longest token has bytes have come out unchanged.
    """

    def __init__(self, bpe: ByteBpe, data: bytes = b""):
        self.bpe, self.data, self.last, self.filled = bpe, b"", [], 0
        self.append(data)

    def append(self, data: bytes) -> PrefixEncoding:
        self.data += data
        self.bpe.extend(self.data, self.last)
        self.filled += len(data)
        return self

    def edit(self, start: int, end: int, data: bytes) -> PrefixEncoding:
        """Replace bytes ``start:end`` by ``data``."""
        old, shift = self.last, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last, same = old[:start], 0
        edited = start + len(data)
        while len(self.last) < len(self.data):
            at = len(self.last)
            if at >= edited and same >= self.bpe.longest:
                self.last += old[at - shift :]
                break
            self.bpe.extend(self.data[: at + 1], self.last)
            self.filled += 1
            same = same + 1 if at >= edited and self.last[at] == old[at - shift] else 0
        return self

    @property
    def ids(self) -> list[int]:
        return self.bpe.walk_back(self.last)


def _vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MOST_VOCABULARY_BYTES + 1)
    if len(data) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary is allowed to be")
    return data


def encoded(
    docs: DataFrame, path: str, pattern: str, chunks: str | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, ids, decoded`` of every whole text.

    ``ids`` are the token ids, each match of ``pattern`` encoded by itself and no special
    tokens; ``decoded`` the bytes that these ids stand for. A NULL or empty text has no
    ids and no bytes. The vocabulary, of a checked size, travels with the tasks.
    ``chunks`` may name a quicker pattern whose matches hold whole matches of ``pattern``.
    """
    spark: SparkSession = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, key = worker_cache("bpe"), ("bpe", path, pattern, chunks)
        if key not in kept:
            kept[key] = ByteBpe.from_file(vocabulary.value, pattern, chunks)
        bpe = kept[key]
        for batch in batches:
            texts, at = batch.column(1), 0
            while at < len(texts):  # pieces of a batch, so that ids of few texts are held at once
                flat: list[int] = []
                offsets, decoded = [0], []
                for t in texts.slice(at, 64).to_pylist():
                    ids = bpe.encode(t) if t else []
                    flat += ids
                    offsets.append(len(flat))
                    decoded.append(bpe.decode(ids))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(decoded)),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(np.array(flat, np.int32))
                    ),
                    pa.array(decoded, pa.binary()),
                ], names=["doc_id", "ids", "decoded"])
                at += 64

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def token_digests(
    docs: DataFrame, path: str, pattern: str, chunks: str | None = None, **columns: str
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text."""
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded(docs, path, pattern, chunks, **columns).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
