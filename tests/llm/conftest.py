from __future__ import annotations

import pathlib
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).parent))

from edge_cases import edge_rows  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for results or inside; as extra columns they must not disturb.
CLASHING = (
    "size", "kept", "keep_id", "group_size", "shard", "slot", "target", "taken", "copies", "score",
    "node", "label", "links", "class_id", "ids", "decoded", "_k1", "_k2", "_part", "_norm", "_print",
    "_order", "_text", "held_out", "n_tokens", "word", "uid",
)


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing_docs(spark):
    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(i, 1, i % 2) for i in range(0, 80)] + [(None, 1, 1), (3, None, None), (4, 1, 7), (5, 0, 0), (5, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
