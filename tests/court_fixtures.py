"""Invented court tables, small enough to work out by hand."""

from __future__ import annotations

import datetime as dt

from casetally import schemas

JUL, AUG, SEP = dt.date(2018, 7, 1), dt.date(2018, 8, 1), dt.date(2018, 9, 1)
DEC, JAN = dt.date(2018, 12, 1), dt.date(2019, 1, 1)

COURTS = [
    ("jdocco01", "Juzgado Civil 1", "Norte", "cco"),
    ("jdocco02", "Juzgado Civil 2", "Norte", "cco"),
    ("jdopaz01", "Juzgado de Paz 1", "Sur", "paz"),
    ("camcco01", "Cámara Civil", "Sur", "cco"),
]


def ruling(iep, start, end, fdesp, fres, due1, due2, tres="1", as_="S", tproc="ORDINARIO", nro="1"):
    return (iep, start, end, nro, "A contra B", tproc, as_, tres, "01/06/2018",
            fdesp, fres, due1, due2)


CASES = [
    # on the first due date: on time
    ruling("jdocco01", JUL, AUG, "02/07/2018", "10/07/2018", "10/07/2018", "20/07/2018"),
    # a day later: after the first
    ruling("jdocco01", JUL, AUG, "03/07/2018", "11/07/2018", "10/07/2018", "20/07/2018", as_="s"),
    # on the second due date: still after the first only
    ruling("jdocco01", JUL, AUG, "03/07/2018", "20/07/2018", "10/07/2018", "20/07/2018", as_="A"),
    # past the second; NULL code counts as final
    ruling("jdocco01", JUL, AUG, "04/07/2018", "21/07/2018", "10/07/2018", "20/07/2018",
           tres=None, as_=None),
    # interim measure: never resolved
    ruling("jdocco01", JUL, AUG, "05/07/2018", "09/07/2018", "10/07/2018", "20/07/2018", tres="0"),
    # on the start of the interval: inside; dispatched in August
    ruling("jdocco01", AUG, SEP, "01/08/2018", "01/08/2018", "10/08/2018", "20/08/2018"),
    # on the end of the interval: outside
    ruling("jdocco01", JUL, AUG, "30/07/2018", "01/08/2018", "10/08/2018", "20/08/2018"),
    # no ruling, and an impossible dispatch date
    ruling("jdocco01", JUL, AUG, "31/02/2018", None, "10/08/2018", "20/08/2018"),
    # a court with one pending case and no rulings
    ruling("jdocco02", JUL, AUG, "06/07/2018", None, "10/07/2018", "20/07/2018"),
    # a violence case of a court missing from the directory
    ruling("jdofam0101con", JUL, AUG, "07/07/2018", "08/07/2018", "10/07/2018", "20/07/2018",
           tproc="VIOLENCIA FAMILIAR", tres="99"),
    ruling("jdofam0100con", JUL, AUG, "07/07/2018", "08/07/2018", "10/07/2018", "20/07/2018",
           tproc=None),
    ruling("jdofam0101con", JUL, AUG, "07/07/2018", "08/07/2018", "10/07/2018", "20/07/2018"),
]


def cases(spark, rows=CASES):
    return spark.createDataFrame(rows, schemas.RULINGS)


def courts(spark):
    return spark.createDataFrame(COURTS, schemas.COURTS)


def population(spark, *codes):
    return spark.createDataFrame([(c,) for c in codes], "organismo string")


ALL_COURTS = ("jdocco01", "jdocco02", "jdofam0101con", "jdofam0100con")


def rows_by(df, *keys):
    """Rows keyed by a column or several."""
    out = {}
    for r in df.collect():
        k = tuple(r[c] for c in keys)
        key = k[0] if len(k) == 1 else k
        assert key not in out, key
        out[key] = r
    return out
