"""The pipeline's stages, each judged on its own input by brute force."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import pytest

from casetally.llm.common import stored
from casetally.llm.toxicity import fit, toxicity

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, edge_docs, edge_labels, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    edge_docs.write.parquet(f"{root}/documents.parquet")
    edge_labels.write.parquet(f"{root}/labels.parquet")
    return root


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def test_stages_on_their_own_input(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "mixing", "encoding",
    ]
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    clean = stored(stage["toxicity"](spark, docs, folder))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rejected = {r.doc_id for r in toxicity(docs, labels).filter("predicted = 1").collect()}
    assert Counter(r.doc_id for r in clean.collect()) == Counter(
        r.doc_id for r in docs.collect() if r.doc_id not in rejected
    )

    single = stored(stage["exact_dedup"](spark, clean, folder))
    norms = [SPACE.sub("", r.text or "") for r in single.collect()]
    assert sorted(norms) == sorted({SPACE.sub("", r.text or "") for r in clean.collect()})

    apart = stored(stage["near_dedup"](spark, single, folder))
    sets = [shingles(r.text) for r in apart.collect()]
    for i, x in enumerate(sets):
        assert not any(x and len(x & y) >= 0.8 * len(x | y) for y in sets[:i])
    before = [shingles(r.text) for r in single.collect()]
    for x in before:  # what went has a way to something that stayed
        assert x in sets or any(len(x & y) >= 0.5 * len(x | y) for y in sets if x | y)

    mixed = stored(stage["mixing"](spark, apart, folder))
    for df in (clean, single, apart, mixed):
        assert df.columns == columns
    copies = Counter((r.doc_id, r.text) for r in mixed.collect())
    sizes = sum(len(WORD.findall(r.text or "")) for r in apart.collect())
    longest = max(len(WORD.findall(r.text or "")) for r in apart.collect())
    assert max(copies.values()) <= 2
    total = sum(n * len(WORD.findall(t or "")) for (_, t), n in copies.items())
    assert abs(total - 1.5 * sizes) <= 6 * longest

    out = stage["encoding"](spark, mixed, folder)
    assert out.count() == mixed.count() and "ids_sha256" in out.columns
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == Counter(
        r.doc_id for r in out.collect()
    )


def test_stages_of_empty_and_clashing_tables(spark, folder, no_docs, clashing_docs):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert fit(no_docs, labels) is not None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, no_docs, folder)
        assert out.count() == 0
        if name != "encoding":
            assert out.columns == no_docs.columns
            assert stage(spark, clashing_docs, folder).columns == clashing_docs.columns
