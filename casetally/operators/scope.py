"""Which courts and which period a report covers."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import day

# Districts of the default scope.
DISTRICTS = (
    "Gualeguaychú", "Uruguay", "Concordia", "Paraná", "Diamante", "Federación", "Federal",
    "San Salvador", "Tala", "Victoria", "Islas del Ibicuy", "Chajarí", "Colón", "Gualeguay",
    "La Paz", "Nogoyá", "Villaguay", "Feliciano",
)
# Court-code patterns by instances in scope.
INSTANCE_CODES = {
    (1, 2, 3): "oma|oga|jez|jdopna|jdo|cam|sal",
    (1, 2): "oma|oga|jez|jdopna|jdo|cam",
    (1,): "oma|oga|jez|jdopna|jdo|camcad",
    (2,): "cam",
    (3,): "sal",
}
# Subject-matter prefixes whose court codes use another name.
MATTER_CODES = (("civ", "cco"), ("pen|pej", "pen"), ("pme", "oma|equ"))
ENFORCEMENT_MATTERS = "eje|cqb"


def in_interval(
    df: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    start_col: str = "data_interval_start",
    end_col: str = "data_interval_end",
) -> DataFrame:
    """Rows whose reporting interval lies inside ``[start, end]``.

    On a table partitioned by ``data_interval_start`` this prunes partitions.
    """
    return df.filter((F.col(start_col) >= day(start)) & (F.col(end_col) <= day(end)))


def members(
    df: DataFrame, population: DataFrame, key: str = "iep", member: str = "organismo",
) -> DataFrame:
    """Rows of courts in the population.

    Reports count first and call this on the few groups left. On rows, Spark decides by
    the sizes it knows or measures whether the population is broadcast.
    """
    return df.join(population.select(F.col(member).alias(key)), key, "left_semi")


def _codes_of(matters: Sequence[str]) -> str:
    pattern = "|".join(m.lower()[:3] for m in matters)
    for old, new in MATTER_CODES:
        pattern = re.sub(old, new, pattern, count=1)
    return pattern


def select_courts(
    directory: DataFrame,
    matters: Sequence[str],
    instances: Sequence[int],
    district: str | None = None,
) -> DataFrame:
    """The population of a report: courts by subject matter, instance and district."""
    courts = _codes_of(matters)
    kinds = tuple(sorted(set(instances)))
    if kinds not in INSTANCE_CODES:
        kinds = kinds[:1]  # the lowest instance decides, as for one alone
    if courts == "ecq":
        in_matter = F.col("materia").rlike(ENFORCEMENT_MATTERS)
    else:
        in_matter = F.col("organismo").rlike(courts)
    return directory.filter(
        in_matter
        & F.col("organismo").rlike(INSTANCE_CODES[kinds])
        & F.col("circunscripcion").rlike(district or "|".join(DISTRICTS))
    )


def with_court_names(df: DataFrame, courts: DataFrame, key: str = "organismo") -> DataFrame:
    """Add name and district of a court; unknown courts keep NULL there.

    Reports call this on counted groups; only listings name single rows.
    """
    names = courts.select(
        F.col("organismo").alias(key), "organismo_descripcion", "circunscripcion"
    )
    return df.join(names, key, "left")


def excluding(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Rows whose text does not match; a NULL text is dropped as well."""
    return df.filter(~F.col(name).rlike(pattern))


def matching(df: DataFrame, name: str, pattern: str) -> DataFrame:
    return df.filter(F.col(name).rlike(pattern))


def dispatch_column(df: DataFrame) -> str:
    """Higher courts keep the dispatch date in another column."""
    return "fdesp1" if "fdesp1" in df.columns else "fdesp"
