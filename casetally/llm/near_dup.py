"""Near duplicates on word shingles: a MinHash LSH forest with exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casetally.llm.common import row_key, stored, thinned
from casetally.llm.words import mixed, shingles, slices, split_words

WORDS = 5
SIGNATURE_SEED = 20_11
EPSILON = 1e-9


class Forest:
    """Shape of the forest: ``trees`` prefix tries over labels of ``longest`` hash values.

    Two texts of similarity s share the first k values of a tree's label with probability
    s**k. ``depths`` are the prefix lengths that may be tried, from the longest down to the
    first at which a pair at the threshold meets in some tree with at least the target
    recall. How far a text goes down depends on its own size (:meth:`steps`).
    """

    def __init__(self, threshold: float = 0.8, recall: float = 0.995, trees: int = 20, longest: int = 8):
        self.threshold, self.target, self.trees, self.longest = threshold, recall, trees, longest
        self.depths = [longest]
        while self.recall(threshold, self.depths[-1]) < recall:
            if self.depths[-1] == 1:
                raise ValueError("so few trees cannot reach the recall")
            self.depths.append(self.depths[-1] - 1)
        r = np.random.default_rng(SIGNATURE_SEED)
        values = trees * longest
        self.flip = r.integers(0, 1 << 32, values, dtype=np.uint32)
        self.times = r.integers(0, 1 << 31, values, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self._steps: dict[int, int] = {}
        # A share of equal values so far below the threshold is out of reach by chance.
        self.least_share = threshold - 5 * (threshold * (1 - threshold) / values) ** 0.5

    def recall(self, similarity: float, depth: int) -> float:
        """The chance that a pair of this similarity shares a prefix of this depth."""
        return 1 - (1 - similarity**depth) ** self.trees

    def least_similarity(self, size: int) -> float:
        """The least similarity, from the threshold up, of a set of ``size`` to a different
        one; 1 if it can reach the threshold with none. Beyond 60 the threshold is near enough."""
        if size > 60:
            return self.threshold
        least, t = 1.0, self.threshold - EPSILON
        for other in range(1, int(size / self.threshold + EPSILON) + 1):
            for both in range(1, min(size, other) + 1):
                s = both / (size + other - both)
                if t <= s < least:
                    least = s
        return least

    def steps(self, size: int) -> int:
        """How many of ``depths`` a set of ``size`` shingles has to try to be found by each
        different set at the threshold or above with the target recall; 0 if there is none."""
        if size not in self._steps:
            least = self.least_similarity(size)
            steps = 0 if least >= 1 else next(
                (i + 1 for i, d in enumerate(self.depths) if self.recall(least, d) >= self.target), len(self.depths)
            )
            self._steps[size] = steps
        return self._steps[size]

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """The least value of every hash function over the shingles."""
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.flip), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(low), 2048):
            part = (low[at : at + 2048, None] ^ self.flip) * self.times
            np.minimum(least, part.min(axis=0), out=least)
        return least

    def keys(self, signatures: np.ndarray, depth: int) -> np.ndarray:
        """64-bit names of each tree's prefix of ``depth`` values, one column a tree."""
        label = signatures.reshape(len(signatures), self.trees, self.longest).astype(np.uint64)
        key = np.broadcast_to(np.arange(self.trees, dtype=np.uint64) + np.uint64(depth << 8), label.shape[:2])
        for i in range(depth):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + label[:, :, i])
        return key


def set_name(hashes: np.ndarray) -> int:
    """A name of a set of hashes that does not depend on their order."""
    m = mixed(hashes)
    both = np.array([m.sum(dtype=np.uint64), np.bitwise_xor.reduce(m)], np.uint64)
    return int(mixed(mixed(both[:1]) + both[1:]).view(np.int64)[0])


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles, as sorted hashes; none for a text without words."""
    found, bounds = shingles(split_words(texts), words)
    return [np.unique(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def signatures(docs: DataFrame, forest: Forest, doc_id: str, text: str) -> DataFrame:
    """Per row ``_k1, _k2, doc_id, node`` and the node's steps, keys and short signature.

    ``node`` names the set of shingles; it is NULL for a text without words. ``steps`` is how
    many depths the node has to try. ``keys`` holds a list of names of prefixes a depth.
    """
    schema = "_k1 long, _k2 long, doc_id long, node long, steps int, keys array<array<long>>, short binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                sets = shingle_sets(part.column(3))
                none = np.array([len(s) == 0 for s in sets])
                nodes = np.array([set_name(s) if len(s) else 0 for s in sets], np.int64)
                sigs = np.stack([forest.signature(s) for s in sets])
                keys = np.stack([forest.keys(sigs, d).view(np.int64) for d in forest.depths], axis=1)
                inner = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, forest.trees, dtype=np.int32)), pa.array(keys.reshape(-1))
                )
                outer = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, len(inner) + 1, len(forest.depths), dtype=np.int32)), inner
                )
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), pa.array(nodes, mask=none),
                    pa.array([forest.steps(len(s)) for s in sets], pa.int32()), outer,
                    pa.array([s.astype(np.uint8).tobytes() for s in sigs], pa.binary()),
                ], names=["_k1", "_k2", "doc_id", "node", "steps", "keys", "short"])

    rows = docs.select(*row_key(doc_id, text), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(sign, schema)


def _likely(pairs: DataFrame, nodes: DataFrame, forest: Forest) -> DataFrame:
    """Pairs whose short signatures agree as far as the threshold can make them."""
    short = nodes.select("node", "short")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (
                    np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    for i in (2, 3)
                )
                likely = (x == y).mean(axis=1) >= forest.least_share
                yield batch.select([0, 1]).filter(pa.array(likely))

    with_both = pairs.join(short.select(F.col("node").alias("a"), F.col("short").alias("x")), "a").join(
        short.select(F.col("node").alias("b"), F.col("short").alias("y")), "b"
    )
    return with_both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    spot = np.searchsorted(large, small)
    spot[spot == len(large)] = 0
    both = int((large[spot] == small).sum())
    return both / (len(x) + len(y) - both)


def _similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b, similarity`` of pairs of nodes, on their whole sets of shingles.

    The text of the second node travels with the pair to the text of the first.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                first = part.column(2).dictionary_encode()  # a node's pairs stand together
                codes = first.indices.to_numpy(zero_copy_only=False)
                x, y = shingle_sets(first.dictionary), shingle_sets(part.column(3))
                found = np.array([similarity(x[c], y[i]) for i, c in enumerate(codes)], np.float64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found)], names=["a", "b", "similarity"]
                )

    second = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    both = second.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, similarity double")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for all ends of links, one label per connected component.

    Every round each node goes to the least of itself and its neighbours, and links are
    drawn anew between where their ends went, until none are left. Links shrink fast, and
    a node with many neighbours is only ever reduced to a minimum or joined by its name.
    """
    edges = stored(links.select("a", "b").filter("a != b").distinct())
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(
            both.groupBy("a").agg(F.min("b").alias("_b")).select(F.col("a").alias("node"), F.least("a", "_b").alias("up"))
        )
        if labels is None:
            labels = up.withColumnRenamed("up", "label")
        else:
            labels = labels.join(up.withColumnRenamed("node", "label"), "label", "left").select(
                "node", F.coalesce("up", "label").alias("label")
            )
        edges = stored(
            edges.join(up.select(F.col("node").alias("a"), F.col("up").alias("_a")), "a")
            .join(up.select(F.col("node").alias("b"), F.col("up").alias("_b")), "b")
            .filter("_a != _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
        )
        if edges.isEmpty():
            return stored(labels)


def _label(df: DataFrame, labels: DataFrame, node: str, into: str) -> DataFrame:
    named = labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
    return df.join(named, node, "left").withColumn(into, F.coalesce("_label", node)).drop("_label")


def _shared(rows: list[np.ndarray], columns: list[np.ndarray], step: int = 8192) -> np.ndarray:
    """Sizes of the intersections of every set in ``rows`` with every one in ``columns``."""
    every = rows + columns
    values = np.concatenate(every)
    universe, codes, times = np.unique(values, return_inverse=True, return_counts=True)
    keep = times[codes] > 1  # what stands in one set only is in no intersection
    names = np.cumsum(times > 1) - 1
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])[keep]
    codes = names[codes[keep]]
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    width = int(codes[-1]) + 1 if len(codes) else 0
    both = np.zeros((len(rows), len(columns)), np.float32)
    for low in range(0, width, step):
        a, b = np.searchsorted(codes, [low, low + step])
        has = np.zeros((len(every), min(step, width - low)), np.float32)
        has[owner[a:b], codes[a:b] - low] = 1
        both += has[: len(rows)] @ has[len(rows) :].T
    return both


def _sides(rows: DataFrame, group: str, asks: str, block: int, block_bytes: int = 8 << 20) -> DataFrame:
    """Rows dealt out so that in every group all asking rows meet all rows, in blocks.

    ``bytes`` is the size of a row's text. Adds ``batch, m, u``, which name a task's unit, and
    ``side``, true for a row that asks there. Small groups share a batch; a group of more than
    ``block`` rows or ``block_bytes`` of text has units of its own, one for each block of
    asking rows and block of rows, so that no unit grows with the data or with the length of
    texts beyond a single one. Groups without asking rows are left out.
    """
    size, asking_size = F.sum("bytes"), F.sum(F.when(F.col(asks), F.col("bytes")))

    def blocks(count, held):
        return F.greatest(F.ceil(count / F.lit(block)), F.ceil(held / F.lit(block_bytes))).cast("int")

    parts = stored(
        rows.groupBy(group).agg(
            blocks(F.count("*"), size).alias("_m"),
            blocks(F.sum(F.col(asks).cast("long")), asking_size).alias("_u"), size.alias("_held"),
        ).filter("_u > 0")
    )
    few = parts.agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("_m") == 1, F.col("_held"))).alias("held")
    ).first()
    batches = max(1, few["n"] // 200, (few["held"] or 0) // (2 * block_bytes))
    parts = parts.drop("_held")
    small = F.pmod(F.xxhash64(group), F.lit(batches))
    dealt = stored(
        rows.join(parts, group).withColumn("batch", F.when(F.col("_m") > 1, F.col(group)).otherwise(small))
    )
    number, zero = F.xxhash64("node", group), F.lit(0).cast("long")
    all_rows = dealt.withColumn("m", F.pmod(number, "_m").cast("long")).withColumn(
        "u", F.explode(F.sequence(zero, F.col("_u").cast("long") - 1))
    ).withColumn("side", F.lit(False))
    asking = dealt.filter(asks).withColumn("u", F.pmod(number, "_u").cast("long")).withColumn(
        "m", F.explode(F.sequence(zero, F.col("_m").cast("long") - 1))
    ).withColumn("side", F.lit(True))
    return all_rows.unionByName(asking).drop("_m", "_u")


def _unit_sets(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    sets = []
    for piece in table.select(["text"]).combine_chunks().to_batches():
        for part in slices(piece, 0):
            sets += shingle_sets(part.column(0))
    return sets, np.array([len(x) for x in sets])


def _in_groups(group: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(group, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(group[order])) + 1)


def cross_links(held: DataFrame, texts: DataFrame, threshold: float, block: int = 256) -> DataFrame:
    """Links between components that share a bucket: ``a, b``.

    ``held`` has ``key, node, label, minor``. In each bucket minor nodes meet all nodes,
    in blocks, on their whole sets of shingles. A unit emits only links that join what it
    has not joined yet, fewer than it has nodes, and no pairs.
    """

    def join(table: pa.Table) -> pa.Table:
        key, node, label, side = (table[c].to_numpy() for c in ("key", "node", "label", "side"))
        sets, size = _unit_sets(table)
        a, b = [], []
        for own in _in_groups(key):
            u, m = own[side[own]], own[~side[own]]
            if not len(u) or not len(m):
                continue
            both = _shared([sets[i] for i in u], [sets[i] for i in m])
            near = both >= (threshold - EPSILON) * (size[u][:, None] + size[m][None, :] - both)
            parent = {}

            def root(x):
                while parent.setdefault(x, x) != x:
                    x = parent[x]
                return x

            for i, j in zip(*np.nonzero(near & (label[u][:, None] != label[m][None, :])), strict=True):
                x, y = root(label[u[i]]), root(label[m[j]])
                if x != y:
                    parent[x] = y
                    a.append(node[u[i]])
                    b.append(node[m[j]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (
        _sides(held.join(texts.select("node", "bytes"), "node"), "key", "minor", block)
        .join(texts.select("node", "text"), "node")
        .groupBy("batch", "m", "u").applyInArrow(join, "a long, b long")
    )


def count_links(
    labels: DataFrame, texts: DataFrame, weights: DataFrame, threshold: float, block: int = 256
) -> DataFrame:
    """``node, links``: what the nodes of its component that each node is linked to weigh.

    ``weights`` has ``node, weight``; a node's own weight does not count. One minus the similarity is a metric. With distances d to the component's label node
    known, two nodes are linked for certain when their distances add up to the limit, and
    for certain not when they differ by more. The certain links are counted from the
    number of nodes at each distance. Only the rest is compared: it needs a node further
    than half the limit from the label node, and such nodes meet the others in blocks, in
    which links are counted without being listed.
    """
    limit = 1 - threshold
    pairs = labels.filter("node != label").select(F.col("label").alias("a"), F.col("node").alias("b"))
    near = _similarities(pairs, texts).select(
        F.col("a").alias("label"), F.col("b").alias("node"), (1 - F.col("similarity")).alias("d")
    )
    apart = stored(
        near.unionByName(
            labels.select("label").distinct().select("label", F.col("label").alias("node"), F.lit(0.0).alias("d"))
        ).join(weights, "node").join(texts.select("node", "bytes"), "node")
    )
    sure = F.lit(limit - EPSILON)
    at = apart.groupBy("label", "d").agg(F.sum("weight").alias("n"))
    marks = at.select("label", F.col("d").alias("v"), "n", F.lit(0).alias("asks"), "d").unionByName(
        at.select("label", (sure - F.col("d")).alias("v"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("asks"), "d")
    )
    up_to = Window.partitionBy("label").orderBy("v", "asks").rowsBetween(Window.unboundedPreceding, 0)
    certain = marks.withColumn("sure", F.sum("n").over(up_to)).filter("asks = 1").select(
        "label", "d", "sure", (2 * F.col("d") <= sure).cast("long").alias("own")
    )

    far = F.col("d") > limit / 2 - EPSILON

    def count(table: pa.Table) -> pa.Table:
        node, label, d, far_, side, weight = (
            table[c].to_numpy() for c in ("node", "label", "d", "far", "side", "weight")
        )
        sets, size = _unit_sets(table)
        links = np.zeros(len(node), np.int64)
        for own in _in_groups(label):
            u, m = own[side[own]], own[~side[own]]
            if len(u) and len(m):
                both = _shared([sets[i] for i in u], [sets[i] for i in m])
                near_ = both >= (threshold - EPSILON) * (size[u][:, None] + size[m][None, :] - both)
                open_pair = (d[u][:, None] + d[m][None, :] > limit - EPSILON) & (node[u][:, None] != node[m][None, :])
                hit = near_ & open_pair
                links[u] += hit @ weight[m]
                links[m] += np.where(far_[m], 0, weight[u] @ hit)
        some = links > 0
        return pa.table({"node": node[some], "links": links[some]})

    compared = (
        _sides(apart.withColumn("far", far), "label", "far", block).join(texts.select("node", "text"), "node")
        .groupBy("batch", "m", "u").applyInArrow(count, "node long, links long")
        .groupBy("node").agg(F.sum("links").alias("more"))
    )
    return apart.join(certain, ["label", "d"]).join(compared, "node", "left").select(
        "node",
        (F.col("sure") - F.col("own") * F.col("weight") + F.coalesce("more", F.lit(0))).alias("links"),
    )


def _trie(nodes: DataFrame, last: int) -> DataFrame:
    """``node, steps, key0, ..`` per node and tree, sorted by prefix from the shortest on.

    The key of depth i names the tree and the prefix there; longer prefixes have smaller i.
    Nodes without steps, and entries that share their shortest prefix with no other node, are
    left out. An entry shares longer prefixes only with entries beside it.
    """
    names = [f"key{i}" for i in range(last + 1)]
    entries = nodes.filter("steps > 0").select(
        "node", "steps", F.explode(F.arrays_zip(*[F.col("keys")[i].alias(n) for i, n in enumerate(names)])).alias("_e")
    ).select("node", "steps", "_e.*")
    shared = entries.groupBy(names[-1]).agg(F.min("node").alias("_a"), F.max("node").alias("_b"))
    open_ = entries.join(shared.filter("_a != _b").select(names[-1]), names[-1])
    return open_.sortWithinPartitions(*reversed(names), "node")


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, recall: float = 0.995, trees: int = 20, longest: int = 8,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, links, copies`` and its row key.

    Texts are sets of five words in a row (all words, if fewer); two are linked when the
    sets' Jaccard similarity is at least ``threshold``. Classes are what links connect;
    ``class_id`` is the smallest id in the class. ``links`` counts the other distinct texts
    that a text is linked to, also those with its own set, and ``copies`` the documents that
    share its own set. A text without words (NULL, empty, blank) is a class by itself, under
    its own id.

    1. Documents with equal sets become one node, so copies cost nothing further.
    2. Every tree's labels are held as a sorted trie: an entry a node and tree with the names
       of its prefixes, only where some other node shares the shortest of them. A node goes
       down as far as its own size asks for: the fewer shingles it has, the further above
       the threshold the next similarity lies that it can have, and the longer the prefixes
       that find it with the target recall. Sets that can be like no other are left out.
    3. From the longest prefixes to the shortest, every node is compared with the least node
       of its bucket, unless they are in one component already. At the first depth it is
       first compared only with the least node that it meets in most trees. So a bucket costs
       as many comparisons as it has nodes, however many are alike, and a shorter prefix
       costs only those that join components which the longer ones left apart.
    4. In buckets of the shortest prefixes that still hold several components, nodes outside
       the bucket's largest one are compared with all nodes, in blocks within tasks
       (:func:`cross_links`). So no pair that shares a bucket is left that is neither compared
       nor in one component: no candidates are capped, and none are emitted.
    5. The comparisons of step 3 drop pairs whose signatures differ by five standard
       deviations more than the threshold allows; all others are decided on the whole sets
       of shingles.
    """
    forest = Forest(threshold, recall, trees, longest)
    signed = stored(signatures(docs, forest, doc_id, text))
    nodes = stored(
        signed.filter("node IS NOT NULL").groupBy("node")
        .agg(F.min("_k2").alias("_k2"), F.first("steps").alias("steps"), F.first("keys").alias("keys"),
             F.first("short").alias("short"))
    )
    last = len(forest.depths) - 1
    trie = stored(_trie(nodes, last))
    wanted = nodes.join(trie.select("node").distinct(), "node", "left_semi").select("node", "_k2")
    texts = stored(
        docs.select(row_key(doc_id, text)[1], F.col(text).alias("text")).join(wanted, "_k2")
        .groupBy("node").agg(F.first("text").alias("text"))
        .withColumn("bytes", F.octet_length("text").cast("long"))
    )

    links = docs.sparkSession.createDataFrame([], "a long, b long")
    labels = docs.sparkSession.createDataFrame([], "node long, label long")

    def compared(pairs: DataFrame) -> None:
        nonlocal links, labels
        apart = _label(_label(pairs, labels, "a", "_a"), labels, "b", "_b").filter("_a != _b").select("a", "b")
        near = _similarities(_likely(apart, nodes, forest), texts)
        found = stored(near.filter(F.col("similarity") >= threshold - EPSILON).select("a", "b"))
        if not found.isEmpty():
            links = stored(links.unionByName(found))
            labels = components(links)

    for depth in range(last + 1):
        least = trie.groupBy(f"key{depth}").agg(F.min("node").alias("least"))
        met = stored(
            trie.filter(F.col("steps") > depth).join(least, f"key{depth}").filter("node != least")
            .groupBy(F.col("least").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("_trees"))
        )
        if depth == 0:
            compared(met.groupBy("b").agg(F.max(F.struct("_trees", "a")).alias("_m")).select("_m.a", "b"))
        compared(met.select("a", "b"))

    held = _label(trie.select(F.col(f"key{last}").alias("key"), "node"), labels, "node", "label")
    mixed_keys = held.groupBy("key", "label").agg(F.count("*").alias("_n")).groupBy("key").agg(
        F.max(F.struct("_n", "label"))["label"].alias("_major"), F.count("*").alias("_labels")
    ).filter("_labels > 1").drop("_labels")
    open_ = stored(held.join(mixed_keys, "key").withColumn("minor", F.col("label") != F.col("_major")).drop("_major"))
    found = stored(cross_links(open_, texts, threshold))
    if not found.isEmpty():
        labels = components(links.unionByName(found))

    labels = stored(labels)
    weights = stored(
        signed.filter("node IS NOT NULL").groupBy("node", "_k2").agg(F.count("*").alias("_n"))
        .groupBy("node").agg(F.count("*").alias("weight"))
    )
    linked = stored(count_links(labels, texts, weights, threshold))
    rows = _label(signed.select("_k1", "_k2", "doc_id", "node"), labels, "node", "label")
    worded = rows.filter("node IS NOT NULL")
    same_set = worded.groupBy("node", "label").agg(F.count("*").alias("copies"), F.min("doc_id").alias("_least"))
    per_class = same_set.groupBy("label").agg(
        F.min("_least").alias("class_id"), F.sum("copies").alias("class_size")
    )
    per_node = (
        same_set.drop("_least").join(per_class, "label").join(linked, "node", "left").join(weights, "node")
        .select(
            "node", "label", "class_id", "class_size", "copies",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
        )
    )
    named = worded.drop("label").join(per_node, "node").select(
        "doc_id", "class_id", "class_size", "links", "copies", "label", "_k1", "_k2"
    )
    blank = rows.filter("node IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(0).cast("long").alias("links"), F.lit(1).cast("long").alias("copies"),
        F.lit(None).cast("long").alias("label"), "_k1", "_k2",
    )
    return named.unionByName(blank)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Rows of ``docs``, all columns as they were, with one row of each class.

    The row of the smallest id stays (NULL only where there is no other); of repeated rows
    one. Texts without words are all kept.
    """
    found = near_duplicates(docs, doc_id=doc_id, text=text, **settings).filter("label IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "_k1", "_k2")).alias("_f")
    own = stored(
        found.groupBy("label", "_k1", "_k2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("_times"))
    )
    judged = stored(
        own.join(own.groupBy("label").agg(first), "label").select(
            F.col("_k1").alias("_near_k1"), F.col("_k2").alias("_near_k2"), "_times",
            ((F.col("_k1") == F.col("_f._k1")) & (F.col("_k2") == F.col("_f._k2"))).alias("_stays"),
        )
    )
    k1, k2 = row_key(doc_id, text)
    return thinned(
        docs, {"_near_k1": k1, "_near_k2": k2},
        out=judged.filter("NOT _stays"), once=judged.filter("_stays AND _times > 1"),
    )
