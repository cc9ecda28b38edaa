"""Typed hearings and their parties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetally.functions.dates import date_of
from casetally.schemas import CORRUPT, HEARING_COLUMNS, HEARING_DATES, HEARING_INTS

PARTY_FIELDS = ("name", "doc_id", "role", "address")


def parties(packed: Column) -> Column:
    """Parties of a hearing from ``a$b$c$d%a$b$c$d%…``.

    A short record leaves its last fields NULL, an empty field is NULL.
    """
    records = F.filter(F.split(F.trim(packed), "%"), lambda r: F.trim(r) != "")
    fields = F.transform(records, lambda r: F.split(r, r"\$"))

    def field(values: Column, i: int) -> Column:
        return F.nullif(F.trim(F.get(values, F.lit(i))), F.lit(""))

    return F.transform(
        fields,
        lambda v: F.struct(*[field(v, i).alias(n) for i, n in enumerate(PARTY_FIELDS)]),
    )


def typed_hearings(raw: DataFrame) -> DataFrame:
    """Listing columns in their types; what does not parse is NULL."""
    columns = []
    for c in HEARING_COLUMNS:
        if c == "nro":
            typed = F.col(c).try_cast("bigint")
        elif c in HEARING_INTS:
            typed = F.col(c).try_cast("int")
        elif c in HEARING_DATES:
            typed = date_of(raw, c)
        elif c == "justiables":
            typed = parties(F.col(c))
        else:
            typed = F.col(c)
        columns.append(typed.alias(c))
    return raw.select(*columns)


def exploded_parties(df: DataFrame, packed: str, *keep: str) -> DataFrame:
    """One row per party of each case, numbered in file order."""
    return df.select(*keep, F.posexplode(parties(F.col(packed))).alias("orden", "_p")).select(
        *keep, "orden", *[F.col(f"_p.{n}").alias(n) for n in PARTY_FIELDS]
    )


def faults(raw: DataFrame) -> Column:
    """The error classes of a listing's row, in order of the columns; none when it is typed.

    ``campos``: another number of fields. ``numero:c`` and ``fecha:c``: column ``c`` holds
    something else than digits that fit, or no date; only the case number has to be given.
    ``partes``: a party without its four fields.
    """
    broken = F.col(CORRUPT).isNotNull()

    def given(c: str) -> Column:
        return F.coalesce(F.trim(c) != "", F.lit(False))

    def unless(ok: Column, name: str) -> Column:
        return F.when(~broken & ~F.coalesce(ok, F.lit(False)), F.lit(name))

    found = [F.when(broken, F.lit("campos"))]
    for c in HEARING_COLUMNS:
        if c == "nro" or c in HEARING_INTS:
            digits = F.col(c).rlike("^[0-9]+$") & F.col(c).try_cast("bigint" if c == "nro" else "int").isNotNull()
            found.append(unless(digits if c == "nro" else ~given(c) | digits, f"numero:{c}"))
        elif c in HEARING_DATES:
            found.append(unless(~given(c) | date_of(raw, c).isNotNull(), f"fecha:{c}"))
    records = F.filter(F.split(F.trim("justiables"), "%"), lambda r: F.trim(r) != "")
    whole = F.forall(records, lambda r: F.size(F.split(r, r"\$")) == 4)
    found.append(unless(~given("justiables") | whole, "partes"))
    return F.array_compact(F.array(*found))


def quarantined(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A listing's rows as typed hearings and as rejects; every row is in one of them.

    Rejects keep their fields as text, with all their error classes (``errores``), the
    first of them (``error``) and the whole line where the fields do not fit. Both parts
    read the listing; where that is costly, pass a stored table of :func:`judged` rows.
    """
    rows = raw if "errores" in raw.columns else judged(raw)
    clean = F.size("errores") == 0
    typed = typed_hearings(rows.filter(clean).drop("errores"))
    return typed, rows.filter(~clean).withColumn("error", F.col("errores")[0])


def judged(raw: DataFrame) -> DataFrame:
    """The listing's rows with the error classes of each (``errores``)."""
    return raw.withColumn("errores", faults(raw))
