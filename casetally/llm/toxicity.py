"""Toxicity by class-conditional Kneser-Ney models with shared backoff."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casetally.llm.common import fold_of, part_files, shared_folder, stored, text_or_empty, worker_cache
from casetally.llm.words import NOT_ALPHANUMERIC, Words, mixed, slices, split_words

_BEGIN = np.uint64(0x2545F4914F6CDD1D)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
DISCOUNT = 0.75
RANGES = 64  # of hashes, in which a model's tables are written
RUN_BYTES = 1 << 20  # of text whose words are looked up at a time
_SIGN = np.uint64(1 << 63)
TELLING = 2.0  # difference of logarithms from which a word counts as telling
INPUTS = 5  # numbers of a text that its score is made of


def pair_of(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """The hash of a context and a word, from theirs; :data:`_PAIR_SQL` is the same."""
    return head ^ ((tail << np.uint64(29)) | (tail >> np.uint64(35)))


_PAIR_SQL = "head ^ (shiftleft(tail, 29) | shiftrightunsigned(tail, 35))"


def bigrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word's context (the word before, or the text's beginning) and pair."""
    h = words.hashes
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[words.bounds[:-1][np.diff(words.bounds) > 0]] = _BEGIN
    return before, pair_of(before, h)


def once_a_text(w: Words, keys: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
    """Positions at which a key stands for the first time in its text.

    Texts that repeat a line a thousand times then weigh as much as others.
    """
    at = np.arange(len(keys)) if among is None else among
    spot = np.searchsorted(w.bounds, at, side="right").astype(np.uint64)
    return np.sort(at[np.unique(mixed(keys[at] + spot * _PAIR), return_index=True)[1]])


@dataclass
class Counted:
    """Counts by hash, for both classes, of a table that Spark wrote in ranges of the key.

    What is not listed counts 0. The driver holds none; a process reads the table when it
    first looks something up (:func:`_held`).
    """

    folder: str
    columns: list[str]  # the key, then its counts

    def read(self) -> Compact:
        """All ranges in order. They are sorted, so nothing is sorted or copied here: beside
        the result no more than one range is in memory."""
        from pyarrow import parquet

        ranges = []
        for k in range(-(RANGES // 2), RANGES // 2):
            store, paths = part_files(f"{self.folder}/range={k}")
            ranges += [(store, path) for path in paths]
        rows = []
        for store, path in ranges:
            with store.open_input_file(path) as data:
                rows.append(parquet.read_metadata(data).num_rows)
        table = Compact.empty(sum(rows), len(self.columns) - 1)
        at = 0
        for (store, path), n in zip(ranges, rows, strict=True):
            with store.open_input_file(path) as data:
                part = parquet.read_table(data, columns=self.columns)
            table.fill(at, part[0].to_numpy(), [c.to_numpy() for c in part.columns[1:]])
            at += n
        return table

    def at(self, keys: np.ndarray) -> np.ndarray:
        return _held(self)(keys)


@dataclass
class Compact:
    """A sorted table of hashes in 4 bytes a key and one a count.

    A key's first bits name its bucket (about eight keys), the next 32 its place there; so a
    key that is not listed is taken for one that is about twice in 10^9 times. Counts from
    255 on are kept apart.
    """

    bits: int
    starts: np.ndarray
    rest: np.ndarray
    small: list[np.ndarray]
    large: list[list[tuple[np.ndarray, np.ndarray]]]

    @classmethod
    def empty(cls, keys: int, counts: int) -> Compact:
        bits = min(28, max(1, keys // 8).bit_length())
        return cls(bits, np.zeros((1 << bits) + 1, np.uint32), np.empty(keys, np.uint32),
                   [np.empty(keys, np.uint8) for _ in range(counts)], [[] for _ in range(counts)])

    def _split(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = keys.view(np.uint64) ^ _SIGN  # in Spark's order, which is signed
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        return bucket, (keys >> np.uint64(32 - self.bits)).astype(np.uint32)

    def fill(self, at: int, keys: np.ndarray, counts: list[np.ndarray]) -> None:
        """The next keys, which are sorted, from place ``at`` on."""
        if not len(keys):
            return
        bucket, rest = self._split(np.ascontiguousarray(keys))
        first, last = int(bucket[0]), int(bucket[-1])
        upto = at + np.searchsorted(bucket, np.arange(first, last + 1), side="right")
        self.starts[first + 1 : last + 2] = upto
        self.starts[last + 2 :] = at + len(keys)
        self.rest[at : at + len(keys)] = rest
        for small, large, n in zip(self.small, self.large, counts, strict=True):
            small[at : at + len(keys)] = np.minimum(n, 255)
            over = np.flatnonzero(n >= 255)
            large.append((over + at, n[over].astype(np.float64)))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.rest):
            return np.zeros((len(keys), len(self.small)))
        bucket, rest = self._split(keys)
        at, end = self.starts[bucket].astype(np.int64), self.starts[bucket + 1].astype(np.int64)
        step = 1 << int(np.diff(self.starts).max()).bit_length()
        while step > 1:  # to the first place of the bucket that is not before the key
            step >>= 1
            on = at + step
            at = np.where((on <= end) & (self.rest[np.minimum(on, len(self.rest)) - 1] < rest), on, at)
        spot = np.minimum(at, len(self.rest) - 1)
        listed = (at < end) & (self.rest[spot] == rest)
        out = np.zeros((len(keys), len(self.small)))
        for i, small in enumerate(self.small):
            n = np.where(listed, small[spot], 0)
            out[:, i] = n
            over = np.flatnonzero(n == 255)
            if len(over):
                places = np.concatenate([p for p, _ in self.large[i]])
                values = np.concatenate([v for _, v in self.large[i]])
                out[over, i] = values[np.searchsorted(places, spot[over])]
        return out


def _held(counted: Counted) -> Compact:
    """A process holds the tables of one model, whatever it does with it."""
    cache = worker_cache("kneser-ney")
    model = counted.folder.rsplit("/", 1)[0]
    if cache.get("model") != model:
        cache.clear()
        cache["model"] = model
    if counted.folder not in cache:
        cache[counted.folder] = counted.read()
    return cache[counted.folder]


@dataclass
class Model:
    """``pairs``: counts of pairs; ``heads``: total and kinds of followers of a context;
    ``tails``: kinds of contexts of a word; each for class 0 and 1. ``word_kinds`` are the
    totals of tails. ``weights`` turn the :meth:`inputs` of a text into a score."""

    pairs: Counted
    heads: Counted
    tails: Counted
    word_kinds: np.ndarray
    words: np.ndarray
    weights: np.ndarray
    scale: np.ndarray

    def state(self) -> dict:
        """Plain values, which any worker can read; without the counts, which it reads itself."""
        counted = {k: vars(getattr(self, k)) for k in ("pairs", "heads", "tails")}
        return {**vars(self), **counted}

    @classmethod
    def from_state(cls, state: dict) -> Model:
        counted = {k: Counted(**state[k]) for k in ("pairs", "heads", "tails")}
        return cls(**{**state, **counted})

    def inputs(self, w: Words) -> np.ndarray:
        """Per text what the score is made of: the :meth:`features` and the :meth:`strongest`."""
        tail = self.tails.at(w.hashes)
        return np.column_stack([self.features(w, tail), self.strongest(w, tail)])

    def strongest(self, w: Words, tail: np.ndarray) -> np.ndarray:
        """Per text the evidence of its strongest word, 0 at least: the difference of the
        logarithms of its kinds of contexts, to which each class adds its share of one.

        An unseen word says nothing, and one that class 1 has in hundreds of contexts more
        than one it has by chance. A ratio of probabilities tells those two hardly apart, so
        a long text's chance words outweigh it in sums.
        """
        total = np.maximum(self.word_kinds, 1.0)
        evidence = np.log1p(tail / (total / total.sum()))
        most = np.zeros(len(w))
        np.maximum.at(most, w.document, evidence[:, 1] - evidence[:, 0])
        return most

    def features(self, w: Words, tail: np.ndarray | None = None) -> np.ndarray:
        """Per text: the difference of log-likelihoods a word, what telling words add to it
        (each once), a word and in all, and the word count's logarithm."""
        before, pair = bigrams(w)
        tail = self.tails.at(w.hashes) if tail is None else tail
        c, head = self.pairs.at(pair), self.heads.at(before)
        # Shared backoff: kinds of contexts of a word in both classes, add-one smoothed.
        shared = (tail.sum(1, keepdims=True) + 1.0) / (self.word_kinds.sum() + self.words.sum() + 1.0)
        total = np.maximum(self.word_kinds, 1.0)
        free = np.maximum(DISCOUNT * self.words, 1.0) / total
        lower = np.maximum(tail - DISCOUNT, 0.0) / total + np.minimum(free, 1.0) * shared
        n, kinds = np.maximum(head[:, :2], 1.0), head[:, 2:]
        back = np.where(head[:, :2] > 0, DISCOUNT * kinds / n, 1.0)
        p = np.where(head[:, :2] > 0, np.maximum(c - DISCOUNT, 0.0) / n, 0.0) + back * lower
        ratio = np.log(p[:, 1]) - np.log(p[:, 0])
        telling = np.zeros(len(ratio))
        once = once_a_text(w, w.hashes, np.flatnonzero(ratio > TELLING))
        telling[once] = ratio[once] - TELLING
        sums = np.bincount(w.document, ratio, len(w))
        strongs = np.bincount(w.document, telling, len(w))
        length = np.diff(w.bounds)
        per = np.maximum(length, 1)
        return np.stack([sums / per, strongs / per, np.log1p(strongs), np.log1p(length)], axis=1)

    def scores(self, w: Words) -> np.ndarray:
        x = (self.inputs(w) - self.scale[0]) / self.scale[1]
        z = self.weights[0] + x @ self.weights[1:]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights with intercept, by Newton steps. Both classes weigh the same in all, so the
    rarer one is not given up for the other: 0.5 is where they would be equally likely."""
    a = np.hstack([np.ones((len(x), 1)), x])
    each = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (each * (p - y)) / len(y) + ridge * w
        hessian = (a * (each * p * (1 - p))[:, None]).T @ a / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _words_of(texts: pa.Array) -> Words:
    return split_words(texts, NOT_ALPHANUMERIC, lower=True)


def _range_of(key: str) -> Column:
    """The number of a hash's range, rising with the hash as Spark orders it."""
    return F.shiftright(key, 64 - (RANGES - 1).bit_length())


def _chosen(labels: DataFrame, sample: int, calibration: int, folds: int) -> DataFrame:
    """``doc_id, label, learns`` of about ``sample`` labelled ids a class and ``calibration``
    others, taken by a hash of the id, so that reruns agree."""
    role = F.when(F.col("_fold") == 1, F.lit(-1)).otherwise(F.col("label"))
    rows = labels.withColumn("_fold", fold_of("doc_id", folds)).filter("_fold != 0").withColumn("_role", role)
    most = {-1: calibration, 0: sample, 1: sample}
    share = {r["_role"]: min(1.0, most[r["_role"]] / r["n"]) for r in rows.groupBy("_role").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < sum(
        (F.when(F.col("_role") == k, F.lit(int(v * (1 << 30)))).otherwise(0) for k, v in share.items()), F.lit(0)
    )
    return rows.filter(draw).select("doc_id", "label", (F.col("_role") >= 0).alias("learns"))


def fit(
    docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = 40_000,
    calibration: int = 10_000, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
) -> Model:
    """Learn from labelled rows of the folds 1 to ``folds`` - 1; fold 0 is held out.

    Both fits use documented bounds: counts come from about ``sample`` labelled ids of
    each class, of all folds but 0 and 1, and the score's weights from about
    ``calibration`` ids of fold 1, whose texts the counts have not seen. All pairs, heads
    and tails of the sample are kept, also what was seen once: as tables in the shared
    folder, which workers read (:class:`Counted`). The chosen ids go to the documents, so no text
    is shuffled: at most about ``2 sample + calibration`` rows are broadcast. Labels other than 0 and 1,
    NULL texts and ids, and ids with several labels are left out of fitting. Both classes
    weigh the same in the score, however rare one is among the labels. Without rows
    of both classes every text scores by the share of class 1, near 0 without labels.
    """
    spark = docs.sparkSession
    marked = (
        labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_other")).filter("label = _other")
    )
    chosen = stored(_chosen(marked, sample, calibration, folds))
    rows = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    )
    learn = rows.filter("learns")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                w = _words_of(part.column(0))
                label_of = np.asarray(part.column(1)).astype(np.int8)[w.document]
                before, pair = bigrams(w)
                once = once_a_text(w, pair)
                labelled = mixed(pair[once] + label_of[once].astype(np.uint64) * _PAIR)
                _, first, n = np.unique(labelled, return_index=True, return_counts=True)
                at = once[first]
                place = (pair[at].view(np.int64) >> (64 - (RANGES - 1).bit_length())).astype(np.int8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), pa.array(before[at].view(np.int64)), pa.array(w.hashes[at].view(np.int64)),
                     pa.array(label_of[at]), pa.array(n.astype(np.int32))],
                    names=["range", "head", "tail", "label", "n"],
                )

    # Tables are dealt by ranges of the hash, so that files are sorted one after the other.
    # The sample is bounded, and so is each range of its hashes; partitions are many more
    # than ranges, so that few of them get two.
    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(4 * RANGES, "range")

    def ranged(df: DataFrame, key: str) -> DataFrame:
        return dealt(df.withColumn("range", _range_of(key)))

    pairs = (
        dealt(learn.select("text", "label").mapInArrow(count, "range byte, head long, tail long, label byte, n int"))
        .groupBy("range", "head", "tail").agg(
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("c0"),
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("c1"),
        ).withColumns({"range": F.col("range").cast("int"), "pair": F.expr(_PAIR_SQL)})
    )
    kinds = [F.sum((F.col(c) > 0).cast("long")).alias(f"k{c[1]}") for c in ("c0", "c1")]

    folder = shared_folder(spark)

    def counted(df: DataFrame, key: str, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        df.sortWithinPartitions("range", key).write.partitionBy("range").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    pairs = counted(pairs, "pair", "pairs")
    tails = counted(ranged(pairs.groupBy("tail").agg(*kinds), "tail"), "tail", "tails")
    counted(
        ranged(pairs.groupBy("head").agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"), *kinds), "head"), "head", "heads"
    )
    totals = tails.agg(
        F.sum("k0"), F.sum("k1"), F.sum((F.col("k0") > 0).cast("long")), F.sum((F.col("k1") > 0).cast("long"))
    ).first()
    numbers = np.array([float(x or 0) for x in totals])

    model = Model(
        pairs=Counted(f"{folder}/pairs", ["pair", "c0", "c1"]),
        heads=Counted(f"{folder}/heads", ["head", "n0", "n1", "k0", "k1"]),
        tails=Counted(f"{folder}/tails", ["tail", "k0", "k1"]), word_kinds=numbers[:2], words=numbers[2:],
        weights=np.zeros(1 + INPUTS), scale=np.array([np.zeros(INPUTS), np.ones(INPUTS)]),
    )
    check = rows.filter("NOT learns")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.from_state(state.value)
        for batch in batches:
            for part in slices(batch, 0, RUN_BYTES):
                x = model.inputs(_words_of(part.column(0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[:, i]) for i in range(INPUTS)] + [part.column(1)], names=["a", "b", "c", "d", "e", "label"]
                )

    state = spark.sparkContext.broadcast(model.state())
    seen = check.select("text", "label").mapInArrow(
        measure, "a double, b double, c double, d double, e double, label int"
    ).collect()
    x = np.array([r[:INPUTS] for r in seen], np.float64).reshape(len(seen), INPUTS)
    y = np.array([r[INPUTS] for r in seen], np.float64)
    if len(seen) and 0 < y.sum() < len(y):
        model.scale = np.stack([x.mean(0), np.maximum(x.std(0), 1e-9)])
        model.weights = _fit_logistic((x - model.scale[0]) / model.scale[1], y)
    else:
        share = float(y.mean()) if len(y) else 0.0
        model.weights = np.array([np.log((share + 1e-3) / (1 - share + 1e-3)), *np.zeros(INPUTS)])
    return model


def score_of(model: Model, spark: SparkSession, text: str = "text") -> Column:
    """A text's score, from 0 to 1, by arrays over whole texts.

    NULL counts as the empty text, which scores by its features alone like any other.
    """
    shared = spark.sparkContext.broadcast(model.state())

    def run(texts: pa.Array) -> pa.Array:
        own = Model.from_state(shared.value)
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        found = [own.scores(_words_of(part.column(0))) for part in slices(batch, 0, RUN_BYTES)]
        return pa.array(np.concatenate(found) if found else np.empty(0))

    return F.arrow_udf(run, "double")(text_or_empty(text))


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below ``limit``, all columns as they were."""
    return docs.filter(score_of(model, docs.sparkSession, text) < limit)


def toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 5, doc_id: str = "doc_id", text: str = "text", **bounds: int,
) -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``; see :func:`fit`.

    Labels and other columns than the text have no influence on a score. Every row gets
    one, repeated rows the same. An empty table gives no rows.
    """
    model = fit(docs, labels, folds=folds, doc_id=doc_id, text=text, **bounds)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), score_of(model, docs.sparkSession, text).alias("score")
    )
    return rows.select(
        "doc_id", (fold_of("doc_id", folds) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
