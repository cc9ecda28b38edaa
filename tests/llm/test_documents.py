"""Operators on documents: brute force on edge cases, empty tables, clashing columns."""

from __future__ import annotations

import base64
import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import edge_rows

from casetally.llm import bpe, lattice_lm, mixing, secret_scan, sharding
from casetally.llm.bpe import WORD_CHUNKS, ByteBpe, PrefixEncoding, token_digests
from casetally.llm.common import stored
from casetally.llm.exact_dedup import (
    QuotientFilter,
    exact_duplicates,
    repeated_fingerprints,
    without_copies,
)
from casetally.llm.lattice_lm import Lattice, hash_of, lattice_scores, vocabulary_of
from casetally.llm.mixing import mix, mixed_rows
from casetally.llm.near_dup import Forest, _sides, near_duplicates, one_of_each
from casetally.llm.secret_scan import span_digests
from casetally.llm.sharding import byte_shards
from casetally.llm.toxicity import _BEGIN, Compact, _fit_logistic, fit, pair_of, toxicity, without_toxic
from casetally.llm.words import NOT_ALPHANUMERIC, split_words

tokenizers = pytest.importorskip("public_tokenizers")
SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def both(edge_docs, clashing_docs):
    return [edge_docs, clashing_docs]


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# ---- words ---------------------------------------------------------------------------


def test_words_and_hashes():
    texts = [r[1] for r in edge_rows()]
    array = pa.array(texts, pa.string())
    for part in (array, array.slice(3, 40)):
        w = split_words(part, lower=True)
        want = [WORD.findall((t or "").translate(LOWER)) for t in part.to_pylist()]
        got = [[w.word(i).decode() for i in range(a, b)] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        assert got == want
        by_hash = defaultdict(set)
        for h, word in zip(w.hashes.tolist(), (x for t in want for x in t), strict=True):
            by_hash[h].add(word)
        assert all(len(x) == 1 for x in by_hash.values())
        assert len(by_hash) == len({x for t in want for x in t})
    assert len(split_words(pa.array([], pa.string()), NOT_ALPHANUMERIC)) == 0


# ---- op7 -----------------------------------------------------------------------------


def brute_copies(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[SPACE.sub("", text or "")].append((i, len(text or "")))
    out = Counter()
    for norm, own in groups.items():
        best = min(own, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        for i, chars in own:
            out[i, best[0], len(own), (i, chars) == best, sha(norm.encode())] += 1
    return out


def test_exact_duplicates(edge_docs, clashing_docs, no_docs):
    want = brute_copies(edge_rows())
    for docs in both(edge_docs, clashing_docs):
        found = exact_duplicates(docs)
        assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert exact_duplicates(no_docs).count() == 0


def test_without_copies(clashing_docs, no_docs):
    left = without_copies(clashing_docs)
    assert left.columns == clashing_docs.columns
    texts = [SPACE.sub("", r.text or "") for r in left.collect()]
    assert sorted(texts) == sorted({SPACE.sub("", r[1] or "") for r in edge_rows()})
    assert without_copies(no_docs).count() == 0


def test_quotient_filters_merge_without_loss():
    r = np.random.default_rng(3)
    values = r.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    values = np.concatenate([values, np.repeat(values[:7], 400), values[:100], np.array([0, 0, 2**64 - 1], np.uint64)])
    r.shuffle(values)
    merged = QuotientFilter.of(np.empty(0, np.uint64))
    for part in np.array_split(values, 9):
        merged = merged.merged(QuotientFilter.from_bytes(QuotientFilter.of(part).to_bytes()))
    want = Counter(values.tolist())
    assert dict(zip(merged.fingerprints().tolist(), merged.counts.tolist(), strict=True)) == want
    assert (np.diff(merged.fingerprints().astype(object)) > 0).all()


def test_quotient_filters_are_packed():
    r = np.random.default_rng(4)
    for n in (200, 1000, 100_000, 500_000):
        for bits in (64, 51):
            values = r.integers(0, 1 << bits, n, dtype=np.uint64, endpoint=False) if bits < 64 else r.integers(
                0, 2**64, n, dtype=np.uint64, endpoint=False)
            data = QuotientFilter.of(values, bits).to_bytes()
            distinct = np.unique(values)
            assert len(data) < n * (bits - math.log2(n) + 4.2) / 8 + 16 < n * bits / 8
            assert (QuotientFilter.from_bytes(data).fingerprints() == distinct).all()
    counts = np.array([1, 2, 129, 130, 2**14 + 2, 2**40], np.int64)
    one = QuotientFilter._packed(np.arange(6, dtype=np.uint64), counts, 40)
    both = QuotientFilter.from_bytes(one.to_bytes()).merged(QuotientFilter.of(np.array([1, 9], np.uint64), 40))
    assert both.counts.tolist() == [1, 3, *counts[2:], 1]
    assert both.fingerprints().tolist() == [0, 1, 2, 3, 4, 5, 9]


@pytest.mark.parametrize("per_range", [3, 10, 1000])
def test_repeated_fingerprints_over_ranges(spark, per_range):
    values = [-(2**63), 2**63 - 1, 0, -1, 5, 5, 5, -1, 2**63 - 1, 2**62, -(2**62), 2**62, 17, 18]
    df = spark.createDataFrame([(v,) for v in values], "f long").repartition(3)
    got = {r.f: r.times for r in repeated_fingerprints(df, "f", per_range).collect()}
    assert got == {v: n for v, n in Counter(values).items() if n > 1}


# ---- op10 ----------------------------------------------------------------------------


def test_byte_shards(edge_docs, clashing_docs, no_docs):
    rows = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows()]
    rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[2], x[1]))
    total, at, want, slots = sum(x[1] for x in rows), 0, Counter(), Counter()
    for i, size, crc in rows:
        shard = (2 * at + size) * 4 // (2 * total)
        want[i, size, crc, "bytes", shard, slots[shard], None] += 1
        slots[shard] += 1
        at += size
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    for docs in both(edge_docs, clashing_docs):
        assert rows_of(byte_shards(docs, shards=4), *columns) == want
    assert byte_shards(no_docs).count() == 0


def test_equal_rows_are_spread_over_partitions(spark, monkeypatch):
    """Half of the rows agree in everything; no partition gets many more rows than others."""
    monkeypatch.setattr(sharding, "RUN", 50)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    rows = [(None, None) for _ in range(3000)] + [(i, "x" * (i % 7)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    seen = []
    monkeypatch.setattr(sharding, "stored", lambda df: seen.append(stored(df)) or seen[-1])
    try:
        found = byte_shards(docs, shards=4).collect()
    finally:
        spark.conf.set(key, "true")
    per_part = Counter(r["_part"] for r in seen[0].select("_part").collect())
    assert sum(per_part.values()) == 6000 and max(per_part.values()) < 2 * 6000 / 8
    sizes = sorted((i is not None, i or 0, zlib.crc32((t or "").encode()), len(t or "") + 1) for i, t in rows)
    total, at, want, slots = sum(x[3] for x in sizes), 0, Counter(), Counter()
    for given, i, crc, size in sizes:
        shard = (2 * at + size) * 4 // (2 * total)
        want[i if given else None, size, crc, shard, slots[shard]] += 1
        slots[shard] += 1
        at += size
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found) == want


def test_shards_are_near_equal(spark):
    r = random.Random(5)
    docs = spark.createDataFrame(
        [(i, "x" * r.randint(0, 50), None, None, None) for i in range(3000)],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).repartition(7)
    sizes = byte_shards(docs).groupBy("shard").agg({"size": "sum", "slot": "max", "doc_id": "count"}).collect()
    weights = [x["sum(size)"] for x in sizes]
    assert len(weights) == 16 and max(weights) - min(weights) <= 102
    assert all(x["max(slot)"] == x["count(doc_id)"] - 1 for x in sizes)


# ---- op5 -----------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_targets_and_taken(edge_docs, clashing_docs, no_docs):
    sizes = Counter()
    for _, text, _, source, _ in edge_rows():
        sizes[source] += len(WORD.findall(text or ""))
    want = brute_targets(sizes)
    for docs in both(edge_docs, clashing_docs):
        rows = mix(docs, per_bucket=20).collect()
        assert Counter((r.doc_id, r.size) for r in rows) == Counter(
            (i, len(WORD.findall(t or ""))) for i, t, *_ in edge_rows()
        )
        taken = Counter()
        for r in rows:
            assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-9)
            assert r.taken in (0, r.size, 2 * r.size)
            taken[r.source] += r.taken
        largest = max(r.size for r in rows)
        assert all(abs(taken[s] - want[s]) <= 2 * largest for s in sizes)
        assert rows_of(mix(docs, per_bucket=10**6), "doc_id", "size", "taken") == Counter(
            (r.doc_id, r.size, r.taken) for r in rows
        )
    assert mix(no_docs).count() == 0


def test_one_id_is_spread_over_ranges(spark, monkeypatch):
    """Half of the texts have no id; no range gets many more of them than others."""
    written = []
    monkeypatch.setattr(mixing, "stored", lambda df: written.append(stored(df)) or written[-1])
    rows = [(None if i % 2 else i, f"w{i} " * (i % 5 + 1), None, "ab"[i % 3 == 0], None) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken, target = Counter(), {}
    for x in mix(docs, per_bucket=250).collect():
        taken[x.source] += x.taken
        target[x.source] = x.target
    assert all(abs(taken[s] - target[s]) <= 10 for s in target)
    queue = next(df for df in written if "_range" in df.columns)
    sizes = [r["count"] for r in queue.groupBy("_range").count().collect()]
    assert len(sizes) > 8 and max(sizes) <= 3 * 250


def test_mix_comes_near_its_targets(spark):
    r = random.Random(1)
    rows = [(i, "w " * r.randint(1, 9), None, r.choice("aaaaaabcdef") if i % 9 else None, None) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken, target = Counter(), {}
    for x in mix(docs, per_bucket=300).collect():
        taken[x.source] += x.taken
        target[x.source] = x.target
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    mixed = mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert sum(len(x.text.split()) for x in mixed.collect()) == sum(taken.values())


# ---- op3 -----------------------------------------------------------------------------


def der(tag: int, content: bytes) -> bytes:
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + content


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([1 + i]) * (40 + i)) for i in range(8)))
OPENSSH = secret_scan.OPENSSH_MAGIC + b"".join(
    len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")
) + (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"pub" * 9, b"private" * 20))


def url64(data: bytes) -> str:
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def token(alg: str, size: int) -> str:
    return ".".join((url64(json.dumps({"alg": alg}).encode()), url64(b'{"sub":"x"}'), url64(b"s" * size)))


def test_confirmed_candidates():
    rsa64 = base64.b64encode(RSA).decode()
    text = (
        f"é {token('HS256', 32)} and {token('HS256', 31)} no {token('XX', 32)}\n"
        f"key {rsa64} broken {rsa64[:-8]} hex {RSA.hex()} bad {RSA.hex()[:-2]}\n"
        f"{base64.b64encode(OPENSSH).decode()}\n-----BEGIN RSA PRIVATE KEY-----\n"
        + "\n".join(rsa64[i : i + 64] for i in range(0, len(rsa64), 64))
        + "\n-----END RSA PRIVATE KEY-----\n-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----"
    )
    got = sorted(secret_scan.confirmed_spans(text))
    assert [k for *_, k in got] == ["jwt", "der", "der", "openssh", "der"]
    assert text[got[0][0] : got[0][1]] == token("HS256", 32)
    assert text[got[1][0] : got[1][1]] == rsa64
    assert text[got[4][0] : got[4][1]].startswith("-----BEGIN RSA")


@pytest.mark.parametrize("key, kind", [(RSA, "der"), (OPENSSH, "openssh")])
def test_keys_after_equals_signs_and_with_escaped_line_ends(key, kind):
    key64 = base64.b64encode(key).decode()
    for before, after in (("PRIVATE_KEY=", "\n"), ("https://x.org/?a==&key=", "&b=1"), ('"k": "a\\n', '\\n"'), ("x\\r\\n", "\\r")):
        text = f"é {before}{key64}{after}"
        assert secret_scan.confirmed_spans(text) == [(2 + len(before), 2 + len(before) + len(key64), kind)]
    for end in ("\n", "\r\n", "\r", "\\n", "\\r\\n", "\\\\n"):
        pem = end.join(["-----BEGIN PRIVATE KEY-----", *re.findall(".{1,64}", key64), "-----END PRIVATE KEY-----"])
        text = json.dumps({"type": "x"}) + f'"private_key": "{pem}{end}"'
        start = text.index("-----BEGIN")
        assert secret_scan.confirmed_spans(text) == [(start, start + len(pem), kind)]
    assert secret_scan.confirmed_spans("=" + key64[:-8] + "\\n" + "\\" * 100_000) == []


def test_base_spans_follow_the_patterns():
    loose_hex, loose_access = re.compile(r"[0-9a-f]+"), re.compile(r"AKIA[A-Z0-9]+")
    r = random.Random(2)
    parts = ["password", "TOKEN", "api_key", "apikey", "secret", " ", "=", ":", "'", '"', "AKIA", "a1b2c3", "ABC123XYZ",
             "0123456789abcdef", "ſecret", "toKen", "é", "\n", "==", "-----", "x.y_z"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        want = [(m.start(), m.end(), "assign") for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 6]
        want += [(m.start(), m.end(), "access") for m in loose_access.finditer(text) if len(m[0]) >= 20]
        want += [(m.start(), m.end(), "hex") for m in loose_hex.finditer(text) if len(m[0]) >= 24]
        assert sorted(secret_scan.base_spans(text)) == sorted(want)


def test_span_digests(spark, edge_docs, clashing_docs, no_docs):
    for docs in both(edge_docs, clashing_docs):
        assert span_digests(docs).count() == len(edge_rows())
    assert span_digests(no_docs).count() == 0
    text = "😀 password = \"hunter22\" " + "ab" * 12 + " AKIA" + "Z" * 16
    rows = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    one, none = span_digests(rows).orderBy("doc_id").collect()
    base = "assign:2:22,hex:24:48,access:49:69"
    assert (one.n_assign, one.n_access, one.n_hex, one.spans) == (1, 1, 1, base)
    assert one.base_sha256 == sha(base.encode()) and none.base_sha256 == sha(b"") and none.spans == ""


# ---- op4 -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def own_bpe():
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    return ByteBpe.from_file(bpe._vocabulary(path), tokenizers.PATTERN, WORD_CHUNKS)


@pytest.fixture(scope="module")
def reference_bpe(own_bpe):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding(
        "own", pat_str=tokenizers.PATTERN, mergeable_ranks=own_bpe.ranks, special_tokens={}
    )


def test_bpe_equals_the_merges(own_bpe, reference_bpe):
    r = random.Random(1)
    letters = "abcdefthe  \n\t\x1c\x85\xa0é漢١'s're 　😀ABC.,!!-"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(r.choice("aab ") for _ in range(90)) for _ in range(300)]
    texts += [t[1] or "" for t in edge_rows()] + ["a" * 5000, " " * 3000 + "x", "<|endoftext|>"]
    for t in texts:
        ids = own_bpe.encode(t)
        assert ids == reference_bpe.encode_ordinary(t), repr(t[:80])
        assert own_bpe.decode(ids) == t.encode()


def test_prefix_table_appends_and_edits(own_bpe):
    r = random.Random(4)
    table = PrefixEncoding(own_bpe, b"an encoding of some bytes that go on " * 12)
    for _ in range(40):
        start = r.randint(0, len(table.data))
        end = min(len(table.data), start + r.randint(0, 5))
        table.edit(start, end, bytes(r.choice(b"abc the") for _ in range(r.randint(0, 6))))
        assert table.last == PrefixEncoding(own_bpe, table.data).last
    before = table.filled
    table.append(b" tail")
    assert table.filled == before + 5 and table.last == PrefixEncoding(own_bpe, table.data).last
    assert own_bpe.decode(table.ids) == table.data


def test_token_digests(edge_docs, clashing_docs, no_docs, reference_bpe):
    want = Counter()
    for i, text, *_ in edge_rows():
        ids = reference_bpe.encode_ordinary(text or "")
        want[i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())] += 1
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    for docs in both(edge_docs, clashing_docs):
        found = token_digests(docs, path, tokenizers.PATTERN, WORD_CHUNKS)
        assert rows_of(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert token_digests(no_docs, path, tokenizers.PATTERN).count() == 0


# ---- op6 -----------------------------------------------------------------------------


def shingle_set(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows, threshold=0.8):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and n >= threshold * len(sets[i] | sets[j]) - 1e-9:
                parent[find(i)] = find(j)
                if rows[i][1] != rows[j][1]:
                    links[i].add(rows[j][1])
                    links[j].add(rows[i][1])
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    copies = Counter(sets)
    out = Counter()
    for own in members.values():
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        for i in own:
            out[rows[i][0], min(ids) if ids else None, len(own), len(links[i]), copies[sets[i]] if sets[i] else 1] += 1
    return out


def test_near_duplicates(clashing_docs, no_docs):
    want = brute_classes(edge_rows())
    assert max(links for _, _, _, links, _ in want) >= 5
    found = near_duplicates(clashing_docs, recall=0.9999)
    assert rows_of(found, "doc_id", "class_id", "class_size", "links", "copies") == want
    assert near_duplicates(no_docs).count() == 0


def test_links_in_wide_classes(spark):
    """Chains of gradual change: links are neither all pairs nor a star."""
    r = random.Random(9)
    rows, own = [], [f"w{r.randrange(500)}" for _ in range(150)]
    for i in range(330):
        own = list(own)
        own[r.randrange(150)] = f"n{i}"
        rows.append((i, " ".join(own), None, None, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = near_duplicates(docs, recall=0.9999)
    assert rows_of(found, "doc_id", "class_id", "class_size", "links", "copies") == brute_classes(rows)


def test_one_of_each(clashing_docs, no_docs):
    left = one_of_each(clashing_docs, recall=0.9999)
    assert left.columns == clashing_docs.columns
    texts = [r.text for r in left.collect()]
    blank = sum(not WORD.findall(r[1] or "") for r in edge_rows())
    classes = len({c for _, c, _, _, _ in brute_classes([r for r in edge_rows() if WORD.findall(r[1] or "")])})
    assert sum(not WORD.findall(t or "") for t in texts) == blank
    assert len(texts) - blank == classes
    assert one_of_each(no_docs).count() == 0


def changed_texts(r, n):
    """Pairs of texts of 60 to 200 words whose similarity lies between 0.8 and 0.85."""
    rows, i = [], 0
    while len(rows) < 2 * n:
        own = [f"p{i}w{r.randrange(10**6)}" for _ in range(r.randint(60, 200))]
        other = list(own)
        for at in r.sample(range(len(own)), max(1, len(own) // 45)):
            other[at] = f"p{i}changed{at}"
        x, y = shingle_set(" ".join(own)), shingle_set(" ".join(other))
        if 0.8 <= len(x & y) / len(x | y) <= 0.85:
            rows += [(2 * i, " ".join(own), None, None, None), (2 * i + 1, " ".join(other), None, None, None)]
        i += 1
    return rows


def test_recall_near_the_threshold_as_registered(spark):
    """Each pair is a class, or is missed; at most one in a hundred may be."""
    rows = changed_texts(random.Random(21), 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = Counter(near_duplicates(docs).select("doc_id", "class_id", "class_size", "links").collect())
    pairs = sum((i + 1, i, 2, 1) in found and (i, i, 2, 1) in found for i, *_ in rows[::2])
    alone = sum(i == c and size == 1 and links == 0 for i, c, size, links in found)
    assert pairs >= 0.99 * 300 and alone + 2 * pairs == 600


def test_links_are_between_texts_and_small_sets_need_few_steps(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (2, long.replace(" ", "  ")), (3, long + "\n"), (4, long), (5, long + " more"), (6, "a b c"),
            (7, "a  b c"), (8, "a b d"), (9, "a b c d e f g h"), (10, "a b c d e f g h i"), (11, None), (12, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.class_id, r.class_size, r.links, r.copies) for r in near_duplicates(docs).collect()}
    assert found == {
        1: (1, 5, 3, 4), 2: (1, 5, 3, 4), 3: (1, 5, 3, 4), 4: (1, 5, 3, 4), 5: (1, 5, 3, 1), 6: (6, 2, 1, 2),
        7: (6, 2, 1, 2), 8: (8, 1, 0, 1), 9: (9, 2, 1, 1), 10: (9, 2, 1, 1), 11: (11, 1, 0, 1), 12: (12, 1, 0, 1),
    }


def test_steps_follow_what_a_size_allows():
    forest = Forest()
    assert [forest.steps(n) for n in (1, 2, 3)] == [0, 0, 0]
    for n in range(4, 61):
        alike = [
            b / (n + o - b) for o in range(1, 2 * n) for b in range(1, min(n, o) + 1)
            if 0.8 - 1e-9 <= b / (n + o - b) < 1
        ]
        assert math.isclose(forest.least_similarity(n), min(alike))
        tried = forest.depths[forest.steps(n) - 1]
        assert forest.recall(min(alike), tried) >= 0.995
    assert {forest.steps(n) for n in (61, 1000, 10**6)} == {3}


def test_units_are_bounded_by_bytes(spark):
    """A group of few but very long texts is dealt to several units."""
    long = [(i, 7, i % 5 == 0, 1 << 20) for i in range(120)]
    short = [(1000 + i, 100 + i % 3, True, 100) for i in range(30)]
    rows = spark.createDataFrame(long + short, "node long, key long, asks boolean, bytes long")
    dealt = _sides(rows, "key", "asks", 256, block_bytes=16 << 20).collect()
    units, met = Counter(), defaultdict(set)
    for r in dealt:
        units[r.key, r.m, r.u, r.side] += r.bytes
        met[r.key, r.m, r.u, r.side].add(r.node)
    assert len(dealt) > 150 and max(units.values()) <= 32 << 20
    pairs = {(a, b) for (k, m, u, side), own in met.items() if side for a in own for b in met[k, m, u, False]}
    assert pairs == {
        (a, b) for a, k, asks, _ in long + short if asks for b, l, _, _ in long + short if k == l
    }


@pytest.mark.parametrize("thin", [without_copies, one_of_each])
def test_rows_repeated_very_often(spark, thin):
    """Half of the rows agree in everything, with and without words; one of each stays."""
    same = [(None, "one text of some words that is repeated", "x")] * 1500 + [(None, None, "x")] * 500
    other = [(i, f"text number {i} of the others {i * 7} and {i * i} so on", "y") for i in range(2000)]
    docs = spark.createDataFrame(same + other, "doc_id long, text string, _doc string").repartition(8)
    left = Counter(r.text for r in thin(docs).collect())
    assert left.pop("one text of some words that is repeated") == 1
    assert left.pop(None) == (1 if thin is without_copies else 500)
    assert left == Counter(t for _, t, _ in other)


def test_forest_depth_follows_the_recall():
    assert Forest(recall=0.995).depths == [8, 7, 6]
    assert Forest(recall=0.9999).depths[-1] == 4
    with pytest.raises(ValueError):
        Forest(threshold=0.1, recall=0.99, trees=5)


# ---- op8 -----------------------------------------------------------------------------


def test_lattice_scores(edge_docs, clashing_docs, no_docs):
    path = tokenizers.path("piece_bpe_32k.model")
    rows = edge_rows()
    tokens = [[*WORD.findall((r[1] or "").translate(LOWER)), None] for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    counts = Counter(t for x, h in zip(tokens, held, strict=True) if not h for t in x)
    n, v = sum(counts.values()), len(counts)
    want = Counter(
        (r[0], h, len(t), sum(counts[x] > 0 for x in t), n,
         round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t), 4))
        for r, t, h in zip(rows, tokens, held, strict=True)
    )
    for docs, frequent in ((edge_docs, 1 << 18), (clashing_docs, 3)):  # all words shared, nearly none
        found = lattice_scores(docs, path, frequent=frequent).collect()
        assert want == Counter(
            (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found
        )
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert lattice_scores(no_docs, path).count() == 0


def all_segmentations(word, first, inner, bare):
    def rest(s):
        return 1.0 if not s else sum(p * rest(s[len(x):]) for x, p in inner.items() if s.startswith(x))

    return sum(p * rest(word[len(x):]) for x, p in first.items() if word.startswith(x)) + bare * rest(word)


def test_forward_recursion_sums_all_segmentations():
    lattice = Lattice.of({"▁ab": -1.0, "▁a": -2.0, "b": -3.0, "ba": -4.0, "abab": -5.0, "a": -6.0, "▁": -7.0})
    w = split_words(pa.array(["abab ab b aabba", "bbbbabab x"]))
    p = np.exp(lattice.scores)
    tables = []
    for keys, numbers in (lattice.first, lattice.inner):
        candidates = [b"ab", b"a", b"b", b"ba", b"abab", *[bytes([i]) for i in range(256)]]
        found = lattice.find((keys, numbers), np.array([hash_of(c) for c in candidates], np.uint64))
        tables.append({c: p[i] for c, i in zip(candidates, found, strict=True) if i != lattice.never})
    got = lattice.words(w, np.arange(len(w.hashes)))
    want = [math.log(all_segmentations(w.word(i), *tables, p[lattice.bare])) for i in range(len(w.hashes))]
    assert np.allclose(got, want)
    long = [lattice.long_word(w.data[a:b], None, 1) for a, b in zip(w.starts, w.ends, strict=True)]
    assert np.allclose(long, want)
    into = np.zeros(len(lattice.scores))
    lattice.words(w, np.arange(len(w.hashes)), np.ones(len(w.hashes)), into)
    starts = into[lattice.bare] + sum(into[i] for i in lattice.first[1])
    assert math.isclose(starts, len(w.hashes))  # each word begins once


@pytest.mark.parametrize("size", [1, 7, 64, 65, 200, 5000])
def test_expected_counts_follow_one_rule_for_every_length(monkeypatch, size):
    """A word's lattice in stretches gives what the one held whole gives."""
    monkeypatch.setattr(lattice_lm, "STRETCH", 33)
    lattice = Lattice.of({"▁ab": -1.0, "▁a": -2.0, "b": -3.0, "ba": -4.0, "abab": -5.0, "a": -6.0, "▁": -7.0, "aba": -8.0})
    r = random.Random(size)
    w = split_words(pa.array(["".join(r.choice("aabbx") for _ in range(size))]))
    found = []
    for limit in (0, 1 << 20):
        monkeypatch.setattr(lattice_lm, "LONG", limit)
        into = np.zeros(len(lattice.scores))
        score = lattice.words(w, np.array([0]), np.array([3.0]), into)
        found.append((score[0], into))
    assert math.isclose(found[0][0], found[1][0], rel_tol=1e-9)
    assert np.allclose(found[0][1], found[1][1], rtol=1e-6, atol=1e-9)


def test_expected_counts_are_those_of_all_segmentations():
    lattice = Lattice.of({"▁ab": -1.0, "▁a": -2.0, "b": -3.0, "ba": -4.0, "abab": -5.0, "a": -6.0, "▁": -7.0})
    pieces = {(kind, c): i for kind, (keys, numbers) in enumerate((lattice.first, lattice.inner))
              for c in [b"ab", b"a", b"b", b"ba", b"abab"]
              for i in lattice.find((keys, numbers), np.array([hash_of(c)], np.uint64)) if i != lattice.never}
    p = np.exp(lattice.scores)

    def ways(rest, start):
        if not rest and not start:
            yield 1.0, []
        if start:
            yield from ((q * p[lattice.bare], [lattice.bare, *x]) for q, x in ways(rest, False))
        for (kind, c), i in pieces.items():
            if kind == (0 if start else 1) and rest.startswith(c):
                yield from ((q * p[i], [i, *x]) for q, x in ways(rest[len(c):], False))

    word = b"abababbaab"
    want, total = Counter(), 0.0
    for q, x in ways(word, True):
        total += q
        for i in x:
            want[i] += q
    into = np.zeros(len(lattice.scores))
    got = lattice.long_word(np.frombuffer(word, np.uint8), into, 1)
    assert math.isclose(got, math.log(total))
    assert np.allclose(into, [want[i] / total for i in range(len(into))])


def test_vocabulary_has_no_control_pieces():
    pieces = vocabulary_of(tokenizers.path("piece_bpe_32k.model"))
    assert len(pieces) > 30_000 and "</s>" not in pieces and "<0x00>" not in pieces


# ---- op9 -----------------------------------------------------------------------------


def test_toxicity_edges(edge_docs, clashing_docs, no_docs, edge_labels):
    for docs in both(edge_docs, clashing_docs):
        rows = toxicity(docs, edge_labels).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in edge_rows())
        for r in rows:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
            assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    assert toxicity(no_docs, edge_labels).count() == 0
    assert {r.predicted for r in toxicity(edge_docs, edge_labels.limit(0)).collect()} == {0}
    model = fit(edge_docs, edge_labels)
    assert without_toxic(clashing_docs, model).columns == clashing_docs.columns


def test_toxicity_learns(spark):
    r = random.Random(6)
    mild, bad = [f"m{i}" for i in range(300)], ["vile", "rotten", "nasty"]
    rows, labels = [], []
    for i in range(3000):
        toxic = r.random() < 0.2
        own = [r.choice(mild) for _ in range(r.randint(5, 60))]
        if toxic:
            for _ in range(max(1, len(own) // 20)):
                own.insert(r.randrange(len(own)), r.choice(bad))
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).filter("held_out").collect()
    truth = dict(labels)
    assert sum(x.predicted == truth[x.doc_id] for x in found) / len(found) > 0.95
    again = docs.withColumnRenamed("text", "body").withColumnRenamed("doc_id", "id")
    named = spark.createDataFrame(labels, "id long, bad int")
    same = fit(again, named, label="bad", doc_id="id", text="body")
    assert without_toxic(again, same, text="body").count() < 3000


def test_toxicity_finds_few_bad_words_in_long_texts(spark):
    """One document in ten is toxic, by two words; chance words of long texts are many more."""
    r = random.Random(9)
    rows, labels = [], []
    for i in range(4000):
        own = [f"w{int(r.paretovariate(0.35)) % 200_000}" for _ in range(int(8 * r.paretovariate(0.8)) % 1500 + 5)]
        labels.append((i, int(r.random() < 0.1)))
        for _ in range(2 * labels[-1][1]):
            own.insert(r.randrange(len(own)), r.choice(["vile", "rotten", "nasty", "foul", "base"]))
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    stays = {x.doc_id for x in without_toxic(docs, fit(docs, marks)).collect()}
    unseen = [(i, toxic) for i, toxic in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    caught, clean = ([(i in stays) != toxic for i, toxic in unseen if toxic == k] for k in (1, 0))
    assert sum(caught) >= 0.95 * len(caught) and sum(clean) >= 0.95 * len(clean)


def test_toxicity_does_not_give_up_the_rarer_class():
    r = np.random.default_rng(5)
    y = np.array([0.0] * 9500 + [1.0] * 500)
    x = r.normal(size=(len(y), 1)) + 2 * y[:, None]
    w = _fit_logistic(x, y)
    found = w[0] + x @ w[1:] >= 0
    assert abs(found[y == 1].mean() - 0.841) < 0.05 and abs((~found)[y == 0].mean() - 0.841) < 0.05


def test_toxicity_strongest_word_follows_the_formula(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 9))), int(i % 5 == 0)) for i in range(200)]
    model = fit(spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"),
                spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int"))
    contexts = [defaultdict(set), defaultdict(set)]
    for i, text, x in rows:
        if zlib.crc32(str(i).encode()) % 5 > 1:
            own = text.split()
            for a, b in zip([None, *own], own, strict=False):
                contexts[x][b].add(a)
    kinds = [sum(map(len, contexts[x].values())) for x in (0, 1)]

    def evidence(b):
        added = [n / sum(kinds) for n in kinds]
        return math.log(1 + len(contexts[1][b]) / added[1]) - math.log(1 + len(contexts[0][b]) / added[0])

    texts = ["", "unseen", "w1 w2 unseen", *[x[1] for x in rows[:40]]]
    got = model.inputs(split_words(pa.array(texts), NOT_ALPHANUMERIC, lower=True))
    assert got.shape == (len(texts), 5) and got[0, 4] == got[1, 4] == 0 < got[:, 4].max()
    assert np.allclose(got[:, 4], [max([0, *map(evidence, t.split())]) for t in texts], atol=1e-9)


def test_toxicity_counts_every_label_below_the_sample(spark):
    docs = spark.range(24_000).selectExpr("id AS doc_id", "concat('same ', id) AS text")
    model = fit(docs, spark.range(24_000).selectExpr("id AS doc_id", "int(id % 50 = 0) AS toxic"))
    folds = [(zlib.crc32(str(i).encode()) % 5 > 1, i % 50 == 0) for i in range(24_000)]
    want = [sum(learns and toxic == k for learns, toxic in folds) for k in (False, True)]
    assert want[0] > 12_000 and model.heads.at(np.array([_BEGIN]))[0, :2].tolist() == want


def test_toxicity_keeps_all_counts(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 30))), int(i % 3 == 0)) for i in range(200)]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, x int"),
                spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int"))
    pairs, heads, tails = Counter(), Counter(), Counter()
    for i, text, x in rows:
        if zlib.crc32(str(i).encode()) % 5 > 1:
            own = text.split()
            pairs.update({(a, b, x) for a, b in zip([None, *own], own, strict=False)})
    for (a, b, x), n in pairs.items():
        heads[a, x], heads[a, x + 2], tails[b, x] = heads[a, x] + n, heads[a, x + 2] + 1, tails[b, x] + 1
    assert Counter(pairs.values())[1] > 1000
    hashes = dict(zip(words, split_words(pa.array([" ".join(words)])).hashes, strict=True)) | {None: _BEGIN}
    keys = sorted({(a or "", b) for a, b, _ in pairs})
    before = np.array([hashes[a or None] for a, _ in keys], np.uint64)
    w = np.array([hashes[b] for _, b in keys], np.uint64)
    got = model.pairs.at(pair_of(before, w))
    assert got.tolist() == [[pairs[a or None, b, x] for x in (0, 1)] for a, b in keys]
    assert model.heads.at(before).tolist() == [[heads[a or None, k] for k in range(4)] for a, _ in keys]
    assert model.tails.at(w).tolist() == [[tails[b, x] for x in (0, 1)] for _, b in keys]


def test_toxicity_features_follow_the_formula(spark):
    """Log-likelihoods by interpolated Kneser-Ney, written out word by word."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(25)]
    rows = [(i, " ".join(r.choices(words, k=r.randint(1, 60))), int(i % 4 == 0)) for i in range(300)]
    rows += [(300 + i, "w0 w1", i % 2) for i in range(1500)]  # counts of more than a byte
    model = fit(spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"),
                spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int"))
    pairs = [Counter(), Counter()]
    for i, text, x in rows:
        if zlib.crc32(str(i).encode()) % 5 > 1:
            own = text.split()
            pairs[x].update(set(zip([None, *own], own, strict=False)))  # once a text
    assert max(pairs[1].values()) > 255
    heads = [Counter(), Counter()]
    followers, contexts = [defaultdict(set), defaultdict(set)], [defaultdict(set), defaultdict(set)]
    for x in (0, 1):
        for (a, b), n in pairs[x].items():
            heads[x][a] += n
            followers[x][a].add(b)
            contexts[x][b].add(a)
    kinds = [sum(map(len, contexts[x].values())) for x in (0, 1)]
    vocabulary = [len(contexts[x]) for x in (0, 1)]

    def probability(x, a, b):
        shared = (len(contexts[0][b]) + len(contexts[1][b]) + 1) / (sum(kinds) + sum(vocabulary) + 1)
        lower = max(len(contexts[x][b]) - 0.75, 0) / kinds[x] + min(0.75 * vocabulary[x] / kinds[x], 1) * shared
        if not heads[x][a]:
            return lower
        n = heads[x][a]
        return max(pairs[x][a, b] - 0.75, 0) / n + 0.75 * len(followers[x][a]) / n * lower

    texts = ["w0 w1", "w3 w3 unseen w4 w0", "", *[x[1] for x in rows[:40]]]
    got = model.features(split_words(pa.array(texts), NOT_ALPHANUMERIC, lower=True))
    for text, found in zip(texts, got, strict=True):
        own = text.split()
        ratios = [math.log(probability(1, a, b) / probability(0, a, b)) for a, b in zip([None, *own], own, strict=False)]
        telling = sum({b: v - 2 for b, v in reversed(list(zip(own, ratios, strict=True))) if v > 2}.values())
        n = max(1, len(own))
        want = [sum(ratios) / n, telling / n, math.log1p(telling), math.log1p(len(own))]
        assert np.allclose(found, want, atol=1e-9)


def test_count_tables_hold_every_key():
    r = np.random.default_rng(2)
    for n in (0, 1, 7, 5000):
        keys = np.sort(r.integers(-(2**63), 2**63 - 1, n))
        counts = [r.integers(0, 300, n), r.integers(0, 5, n) * 10**6]
        table = Compact.empty(n, 2)
        cuts = [0, n // 3, n // 3, n]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            table.fill(a, keys[a:b], [c[a:b] for c in counts])
        assert (table(keys.view(np.uint64)) == np.stack(counts, axis=1)).all()
        assert not table(r.integers(0, 2**63, 3000, dtype=np.uint64)).any()
        assert n < 5000 or table.rest.nbytes + table.starts.nbytes + sum(c.nbytes for c in table.small) < 8 * n
