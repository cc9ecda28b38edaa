"""Judges, secretaries and other staff."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.operators.scope import matching

# Categories of the list and the id of external agents.
OFFICIALS = "JUEZ|SECRETARIO|VOCAL|FISCAL|DEFENSOR"
EXTERNAL_AGENT = "0"


def officials(posts: DataFrame, persons: DataFrame, pattern: str = OFFICIALS) -> DataFrame:
    """Staffed posts whose holder's category is in the list."""
    details = persons.select("idagente", "categoria", "apellido", "nombres")
    return matching(posts.join(details, "idagente", "left"), "categoria", pattern)


def official_ids(posts: DataFrame, persons: DataFrame, pattern: str = OFFICIALS) -> DataFrame:
    """Ids of the officials, one per post, and the id of external agents.

    The extra id is a one-row literal; no table is read twice.
    """
    ids = officials(posts, persons, pattern).select("idagente")
    external = ids.sparkSession.range(1).select(F.lit(EXTERNAL_AGENT).alias("idagente"))
    return ids.unionByName(external)


def agents(persons: DataFrame, ids: DataFrame) -> DataFrame:
    """Personnel rows of the given ids."""
    return persons.join(ids.select("idagente").distinct(), "idagente", "left_semi")
