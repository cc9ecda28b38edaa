"""WARC archives and exact top-k against brute force."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casetally.llm.common import shared_folder
from casetally.llm.topk import _narrow, _wide, quantised, threshold_search, top_k
from casetally.llm.warc import (
    archived_pages, assemble, one_line, page_captures, parse_record, read_records, write_archives,
)

PAGES = "page_id long, url string, html string"


def page_rows() -> list[tuple]:
    long, other = "<p>é漢</p>" * 30, "<b>x</b>" * 40
    rows = [(i, f"http://h/{i}", long) for i in range(9, 3, -1)]
    rows += [(20, None, other), (21, "http://a\r\nInjected: 1", other), (22, "u", "x" * 99), (23, "u", "x" * 99),
             (24, "u", "x" * 100), (25, "u", "x" * 100), (30, "u", None), (31, "u", ""), (32, None, None),
             (None, "u", long), (None, "v", "only null ids " * 20), (None, "v", "only null ids " * 20),
             (40, "u", "twice " * 50), (40, "u", "twice " * 50), (41, "u", "twice " * 50),
             (50, "big", "z" * 3_000_000), (51, "big", "z" * 3_000_000), (60, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    return rows


def brute_pages(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100:
            best = first.get(data)
            if data not in first or (i is not None and (best is None or i < best)):
                first[data] = i
    out = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and first[data] != i
        out[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
            first[data] if again else None] += 1
    return out


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_pages_go_round(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    clashing = pages.select("*", *[F.lit("own").alias(c) for c in ("payload", "digest", "kind", "archive", "part")])
    for df in (pages, clashing):
        found = archived_pages(df)
        assert Counter(tuple(r) for r in found.select(*COLUMNS).collect()) == brute_pages(rows)
    assert archived_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_archives_hold_whole_records(spark):
    pages = spark.createDataFrame(page_rows(), PAGES)
    folder = shared_folder(spark)
    archives = write_archives(pages, folder, archive_bytes=2000)
    assert archives.agg(F.sum("captures")).first()[0] == len(page_rows()) and archives.count() > 3
    for row in archives.collect():
        with open(row.archive, "rb") as f:
            text = gzip.decompress(f.read())
        assert text.startswith(b"WARC/1.1\r\n") and b"\r\nInjected: 1" not in text
    records = read_records(spark, archives, folder)
    assert records.count() == 3 * len(page_rows())
    captures = assemble(records)
    full = captures.filter("capture.record_type = 'response'").select(
        F.decode("capture.payload", "UTF-8").alias("html"), F.size("requests").alias("r"), F.size("metadata").alias("m")
    ).collect()
    assert {(x.r, x.m) for x in full} == {(1, 1)}
    assert {x.html for x in full} == {h or "" for _, _, h in page_rows()}
    named = page_captures(assemble(read_records(spark, archives, folder, payloads=False)))
    assert Counter(tuple(r) for r in named.select(*COLUMNS).collect()) == brute_pages(page_rows())


RECORD = ("record_id string, record_type string, concurrent_to array<string>, target_uri string, "
          "headers map<string,string>, payload binary, payload_bytes long, payload_digest string, "
          "archive string, position long")


def records_of(spark, rows):
    return spark.createDataFrame(
        [(i, kind, to, None, {}, None, 0, "", "a", n) for n, (i, kind, to) in enumerate(rows)], RECORD
    )


def test_assembly_follows_links_of_either_side(spark):
    rows = [
        ("r1", "response", ["q1"]), ("q1", "request", []), ("m1", "metadata", ["q1"]),  # through the request
        ("r2", "response", []), ("q2", "request", ["r2"]), ("m2", "metadata", ["r2", "q2"]),
        ("r3", "revisit", []), ("m9", "metadata", ["nowhere"]), ("w", "warcinfo", []),
    ]
    got = {
        r.record_id: (r.capture and r.capture.record_type, sorted(x.record_id for x in r.requests),
                      sorted(x.record_id for x in r.metadata))
        for r in assemble(records_of(spark, rows)).collect()
    }
    assert got == {
        "r1": ("response", ["q1"], ["m1"]), "r2": ("response", ["q2"], ["m2"]),
        "r3": ("revisit", [], []), "m9": (None, [], ["m9"]),
    }
    assert assemble(records_of(spark, [])).count() == 0


def test_assembly_follows_chains_to_their_end(spark):
    chain = [(f"m{i}", "metadata", [f"m{i - 1}" if i else "r1"]) for i in range(6)]
    other = [("q0", "request", ["q1"]), ("q1", "request", ["q2"]), ("q2", "request", []), ("x", "metadata", ["q2", "r2"])]
    rows = [("r1", "response", []), ("r2", "response", []), ("w", "warcinfo", []), *chain, *other,
            ("k5", "metadata", ["m5", "w"]), ("k6", "metadata", ["w"]), ("a", "metadata", ["b"]), ("b", "request", ["a"])]
    got = {
        r.record_id: (r.capture is not None, sorted(x.record_id for x in [*r.requests, *r.metadata]))
        for r in assemble(records_of(spark, rows)).collect()
    }
    assert got == {
        "r1": (True, ["k5", *[f"m{i}" for i in range(6)]]), "r2": (True, ["q0", "q1", "q2", "x"]),
        **{i: (False, [i]) for i in ("k6", "a", "b")},  # a warcinfo record is no link
    }


def test_a_capture_with_very_many_records_goes_on_in_parts(spark):
    rows = [("r", "response", [])] + [(f"m{i}", "metadata", ["r"]) for i in range(500)]
    got = assemble(records_of(spark, rows), per_row=50).collect()
    assert len(got) > 5 and sum(len(r.metadata) for r in got) == 500
    assert max(len(r.metadata) for r in got) < 100 and len({r.part for r in got}) == len(got)


def test_headers_are_read_as_written():
    fields, block = parse_record(
        b"WARC/1.1\r\nWARC-Type: metadata\r\nX: a\r\n b\r\nX: c\r\nContent-Length: 3\r\n\r\nabcd"
    )
    assert fields["x"] == ["a b", "c"] and block == b"abc"
    assert one_line("a\r\nb\x7f") == "a%0D%0Ab%7F"
    with pytest.raises(ValueError):
        parse_record(b"HTTP/1.1 200\r\n\r\n")


# ---- op2 -----------------------------------------------------------------------------


def brute_top(vectors, queries, k):
    out = Counter()
    for qi, q in queries:
        scores = [
            (-sum(a * b for a, b in zip(q, v, strict=True)), i is None, i or 0, i)
            for i, v in vectors if i != qi and len(v) == len(q)
        ]
        for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1):
            out[qi, rank, i, -s] += 1
    return out


@pytest.mark.parametrize("block", [7, 1000])
def test_top_k(spark, block):
    r = random.Random(3)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, r.uniform(-1, 1)]) for _ in range(4)]) for i in range(120)]
    rows += [(i, rows[5][1]) for i in range(120, 150)]  # ties
    rows += [(None, [0.1] * 4), (None, [0.9] * 4), (200, None), (201, [0.1, None, 0.2, 0.3]), (202, [math.nan] * 4),
             (203, [math.inf, 0.0, 0.0, 0.0]), (250, [1.0, 2.0]), (251, [3.0, -1.0]), (300, []), (350, [1e30] * 4),
             (100, [0.3] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    df = df.select("*", F.lit("own").alias("vector"), F.lit("own").alias("score"))
    whole = quantised(df.filter("vec_id IS NULL OR vec_id != 350"))
    got = top_k(whole.filter("vec_id % 50 = 0"), whole, k=5, query_block=3, block=block)
    vectors = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if i != 350 and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = [(i, v) for i, v in vectors if i is not None and i % 50 == 0]
    want = brute_top(vectors, queries, 5)
    assert Counter(tuple(x) for x in got.select("query_id", "rank", "vec_id", "score").collect()) == want
    assert top_k(whole.limit(0), whole).count() == top_k(whole, whole.limit(0)).count() == 0
    assert quantised(df).filter("vec_id = 350").count() == 1


@pytest.mark.parametrize("n, dims, high", [(1, 3, 5), (40, 2, 3), (500, 8, 4), (3000, 64, 100), (300, 5, 2**30), (50, 3, 2**45)])
def test_threshold_search(n, dims, high):
    r = np.random.default_rng(n)
    x, q = r.integers(-high, high, (n, dims)), r.integers(-high, high, (12, dims))
    own = r.integers(0, n + 3, 12)
    found, scores = threshold_search(q, own, x, np.arange(n), 5)
    exact = q.astype(object) @ x.T.astype(object)
    for i in range(12):
        want = sorted((-exact[i, j], j) for j in range(n) if j != own[i])[:5]
        assert [(-int(s), int(j)) for s, j in zip(scores[i], found[i], strict=True) if j >= 0] == want


def test_search_stops_early_where_the_bound_allows():
    """One dimension far above the rest: a short way down its list is enough."""
    r = np.random.default_rng(1)
    x = r.integers(0, 2, (20_000, 4))
    x[:, 0] = np.arange(20_000)
    found, scores = threshold_search(np.array([[1, 0, 0, 0]]), np.array([-1]), x, np.arange(20_000), 3)
    assert found[0].tolist() == [19_999, 19_998, 19_997]


def test_a_known_score_ends_the_search():
    """What k rows elsewhere reach: nothing above it is lost, and blocks below it are passed."""
    r = np.random.default_rng(5)
    x, q = r.integers(-50, 50, (2000, 6)), r.integers(-50, 50, (30, 6))
    lists = np.argsort(x, axis=0, kind="stable")
    exact = q @ x.T
    best = np.sort(exact, axis=1)[:, ::-1]
    none = np.full(30, -1)
    for floor in (best[:, 0] + 1, best[:, 0], best[:, 2], best[:, 100]):
        found, scores = threshold_search(q, none, x, np.arange(2000), 5, lists=lists, floor=floor)
        for i in range(30):
            want = [j for _, j in sorted((-exact[i, j], j) for j in range(2000))[:5] if exact[i, j] >= floor[i]]
            assert [int(j) for j in found[i] if j >= 0 and exact[i, j] >= floor[i]] == want
    most = np.maximum(q, 0) @ x.max(axis=0) + np.minimum(q, 0) @ x.min(axis=0)
    found, _ = threshold_search(q, none, x, np.arange(2000), 5, lists=lists, floor=most + 1)
    assert (found == -1).all()


@pytest.mark.parametrize("low, high, width", [(-(2**15), 2**15 - 1, 2), (0, 2**15, 4), (-(2**31), 5, 4), (-(2**63), 2**63 - 1, 8)])
def test_numbers_go_through_the_narrowest_width(low, high, width):
    x = np.array([[low, 0, 1], [high, -1, 2]], np.int64)
    assert len(_narrow(x)) == 6 * width and (_wide(_narrow(x), 2, 3) == x).all()
    assert _wide(_narrow(np.empty((4, 0), np.int64)), 4, 0).shape == (4, 0)
