"""Source divergence, ranked search and benchmark passages: brute force and edge cases."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import edge_rows

from casetally.llm import decontamination, ranked_search as ranked
from casetally.llm.decontamination import Passages, benchmark_passages, contamination, words_of
from casetally.llm.divergence import source_divergence
from casetally.llm.queries import ORACLE, QUERIES
from casetally.llm.ranked_search import ranked_search
from compare import differences, duckdb_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WITH_SQL = [
    "op5_weighted_fair_mixing", "op7_quotient_filter_dedup", "op10_prefix_sum_shards",
    "op11_count_cell_divergence", "op12_accumulator_ranked_search", "op13_wu_manber_decontamination",
]


def terms(text, pattern=TERM):
    return pattern.findall((text or "").translate(LOWER))


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", WITH_SQL)
def test_against_sql(spark, name):
    con = duckdb_connection(SF_DIR)
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []
    con.close()


# ---- op11 ----------------------------------------------------------------------------


def brute_divergence(rows, least, most):
    rows = [(text or "", lang or "", source or "") for _, text, lang, source, *_ in rows]
    out = Counter()
    for lang in {r[1] for r in rows}:
        docs, by_source = Counter(), defaultdict(Counter)
        for text, own, source in rows:
            if own == lang:
                found = terms(text, LETTERS)
                docs.update(set(found))
                by_source[source].update(found)
        kept = sorted(t for t, n in docs.items() if n >= least)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in by_source.items()}
        q = shares(sum(by_source.values(), Counter()))
        for s in p:
            others = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in p if o != s]
            up = [(q[t] - p[s][t], t.encode()) for t in kept if by_source[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(others)), ("term", sorted(up)[:most])):
                for i, (value, item) in enumerate(found):
                    out[lang, s, part, item.decode(), -value, i + 1] += 1
    return out


@pytest.mark.parametrize("least, most", [(3, 50), (1, 4), (1000, 5)])
def test_divergence(edge_docs, clashing_docs, no_docs, least, most):
    want = brute_divergence(edge_rows(), least, most)
    for docs in (edge_docs, clashing_docs):
        assert rows_of(source_divergence(docs, least, most)) == want
    assert source_divergence(no_docs, least, most).count() == 0


def test_divergence_of_many_equal_terms(spark):
    """One cell holds most terms, and more of them are tied than are asked for."""
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)] + ["é", "zz", "Ω"]
    rows = [(i, " ".join(words if s == "a" else ["common", *words[:40], *words[:20] * (i % 3)]), "en", s, 0)
            for i, s in enumerate("aaabbcca")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = source_divergence(docs, 2, 50)
    assert rows_of(found) == brute_divergence(rows, 2, 50)
    assert found.filter("part = 'term' AND source = 'a'").count() == 50


def test_divergence_of_huge_counts(spark):
    """Shares stay exact where 10^9 times a count leaves 64 bits."""
    from casetally.llm.divergence import _share

    n, total = 10**12 + 7, 10**13 + 1
    row = spark.createDataFrame([(n, total, 99)], "n long, total long, terms long").select(_share("n", "total", "terms"))
    assert row.first()[0] == 1 + 10**9 * (n + 5) // (total + 5 * 99)


# ---- op12 ----------------------------------------------------------------------------


def brute_search(docs, items, k):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, Counter(t), len(t)) for i, t in held if t]
    n_docs, words = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for i, count, n in held:
            m = 100 - 25 + 25 * n * n_docs // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * count[t] // (1000 * count[t] + 12 * m))
                for t in terms(text) if t in count
            )
            if score > 0:
                scored.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]):
            out[item, rank + 1, i, -score] += 1
    return out


EDGE_ITEMS = [
    (1, "alpha Beta gamma"), (2, "word"), (3, None), (4, ""), (5, "nowhere found"), (6, "same same one two 漢字"),
    (7, "alpha alpha épsilon idiot eta theta zeta changed61 delta"), (7, "negative"), (None, "row without id"),
    (8, "same same"), (8, "same same"), (9, "... ,,, !"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(EDGE_ITEMS, "item_id long, text string").selectExpr("*", "'own' AS score", "1 AS _q")


@pytest.mark.parametrize("block", [8192, 4])
def test_ranked_search(edge_docs, clashing_docs, items, monkeypatch, block):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", block)
    want = brute_search([r[:2] for r in edge_rows()], EDGE_ITEMS, 5)
    for docs in (edge_docs, clashing_docs):
        assert rows_of(ranked_search(docs, items, 5)) == want


def test_ranked_search_in_groups_of_items(edge_docs, items, no_docs):
    want = brute_search([r[:2] for r in edge_rows()], EDGE_ITEMS, 20)
    assert rows_of(ranked_search(edge_docs, items, 20, query_bytes=60)) == want
    assert ranked_search(no_docs, items).count() == 0
    assert ranked_search(edge_docs, items.limit(0)).count() == 0


def test_ranked_search_with_ties_and_early_stops(spark, monkeypatch):
    """Many equal scores over many small blocks; the first round ends most creation."""
    monkeypatch.setattr(ranked, "BLOCK_DOCS", 16)
    monkeypatch.setattr(ranked, "RARE_DOCS", 2)
    r = random.Random(3)
    vocabulary = [f"t{i}" for i in range(60)]
    docs = [(i, " ".join(r.choices(vocabulary, [1 / (1 + k) for k in range(60)], k=r.randint(1, 30)))) for i in range(500)]
    docs += [(1000 + i, "t50 t51 t3 t1") for i in range(100)]
    asked = [(i, " ".join(r.choices(vocabulary, k=8))) for i in range(20)] + [(99, "t50 t51 t0 t1 t2")]
    found = ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(asked, "item_id long, text string"), 7,
    )
    assert rows_of(found) == brute_search(docs, asked, 7)


def test_accumulators_are_limited():
    """Creation ends once a long list cannot lift a new document above the k-th score."""
    def lists(**own):
        names = sorted(own)
        return {
            "ids": np.arange(100).tobytes(), "without_id": np.zeros(100, np.uint8).tobytes(),
            "lengths": np.full(100, 10).tobytes(), "terms": np.arange(len(names), dtype=np.int32).tobytes(),
            "starts": np.cumsum([0] + [len(own[n]) for n in names]).tobytes(),
            "places": np.concatenate([np.array(own[n], np.int32) for n in names]).tobytes(),
            "times": np.ones(sum(map(len, own.values())), np.int64).tobytes(),
        }

    block = ranked.Block.of(lists(a_rare=[5, 9], b_common=list(range(100))), 100, 1000)
    places, scores = block.best(np.array([0, 1]), np.array([4000, 10]), 2, 0)
    assert places.tolist() == [5, 9] and scores.tolist() == [4010 * int(block.most[0])] * 2
    read = []
    block.impacts = type("Seen", (), {"__getitem__": lambda s, x, a=block.impacts: read.append(x) or a[x]})()
    block.best(np.array([0, 1]), np.array([4000, 10]), 2, 0)
    # The rare list is read whole, the common one only where an accumulator is.
    assert read[0] == slice(0, 2) and read[1].tolist() == [2 + 5, 2 + 9] and len(read) == 2


# ---- op13 ----------------------------------------------------------------------------


def brute_passages(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        own = terms(text)
        for i in range(max(1, len(own) - size + 1) if own else 0):
            windows[tuple(own[i : i + size])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = Counter()
    for i, text in docs:
        own, hit, found = terms(text), set(), set()
        for n in lengths:
            for a in range(len(own) - n + 1):
                named = windows.get(tuple(own[a : a + n]))
                if named:
                    hit.update(range(a, a + n))
                    found |= named
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i, len(own), len(hit), len(found), digest, bool(hit)] += 1
    return out


def passages_fixture():
    r = random.Random(11)
    words = [f"w{i}" for i in range(12)] + ["Ünder", "漢字", "A1"]
    items = [(i, " ".join(r.choices(words, k=r.choice([1, 2, 3, 5, 9, 10, 11, 14, 40])))) for i in range(40)]
    items += [(3, items[20][1]), (10, items[39][1]), (None, "w1 w2 w1 w2 w1"), (77, None), (78, " .. "), (79, "w0"),
              (80, "one two three four"), (81, "word " * 10), (82, "w3 " * 40)]
    docs = [(i, " ".join(r.choices(words[1:], k=r.randint(0, 400)))) for i in range(60)]
    for i in range(60, 90):
        text = r.choice(items[:40])[1]
        docs.append((i, f"Before-it, {text.upper() if i % 2 else text.replace(' ', '; ')}! after {r.choice(words)}"))
    docs += [(90, "w3 " * 300), (91, items[39][1] * 1), (91, items[39][1]), (92, " ".join(t or "" for _, t in items))]
    return docs + [r[:2] for r in edge_rows()], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_contamination(spark, block_bytes):
    docs, items = passages_fixture()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'own' AS spans", "'x' AS items").repartition(3)
    found = contamination(df, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    assert rows_of(found) == brute_passages(docs, items)


def test_contamination_of_empty_tables(spark, edge_docs, no_docs):
    items = spark.createDataFrame(EDGE_ITEMS, "item_id long, text string")
    assert contamination(no_docs, items).count() == 0
    found = contamination(edge_docs, items.limit(0))
    assert found.count() == len(edge_rows()) and found.filter("contaminated OR n_hit > 0 OR n_items > 0").count() == 0


def test_spans_and_items(spark):
    item = "The quick brown fox jumps over the lazy dog today again"
    docs = spark.createDataFrame([(1, f"Said: {item.upper()}, and {item}."), (2, item[:-6])], "doc_id long, text string")
    items = spark.createDataFrame([("q/1", item), ("q/2", "lazy dog")], "item_id string, text string")
    rows = {r.doc_id: r for r in benchmark_passages(docs, items).collect()}
    assert [tuple(s) for s in rows[1].spans] == [(1, 12), (13, 24)] and rows[1]["items"] == ["q/1", "q/2"]
    assert [tuple(s) for s in rows[2].spans] == [(0, 10)] and rows[2]["items"] == ["q/1", "q/2"]


def test_shift_tables_skip_and_find_all():
    """In a text without the benchmark's word pairs a search moves on by whole windows."""
    passages = Passages.of(["1"], pa.array([" ".join(f"b{i}" for i in range(30))]), 10)
    other = words_of(pa.array([" ".join(f"x{i}" for i in range(5000))]))
    table = passages.tables[0]
    assert table.shift.max() == 9 and len(table.possible_ends(other)) < 20
    own = words_of(pa.array([" ".join(f"b{i}" for i in range(30)) * 2]))
    assert len(table.found(own)[0]) >= 21


def test_equal_hashes_do_not_confuse(monkeypatch):
    """Words are compared byte by byte, whatever their hashes say."""
    def all_alike(texts):
        w = words_of(texts)
        w.hashes[:] = 7
        return w

    monkeypatch.setattr(decontamination, "words_of", all_alike)
    passages = Passages.of(["1", "2"], pa.array(["a b c", "a x c"]), 10)
    edges, items = passages.search(all_alike(pa.array(["a b c d", "q a x c", "a y c"])))
    assert items == [{"1"}, {"2"}, set()]
    assert (np.cumsum(edges)[:-1] > 0).tolist() == [True] * 3 + [False] * 2 + [True] * 3 + [False] * 3
