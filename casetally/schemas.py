"""Explicit schemas of the court tables.

Dates arrive as ``dd/MM/yyyy`` text in the listings and stay text until a report
parses them, so that a dirty value becomes NULL instead of failing a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
_INTERVAL = {"data_interval_start": _D, "data_interval_end": _D}

RULINGS = _struct(
    iep=_S, **_INTERVAL, nro=_S, caratula=_S, tproc=_S, **{"as": _S}, tres=_S,
    finicio=_S, fdesp=_S, fres=_S, fvenc1=_S, fvenc2=_S,
)
RULINGS_HIGHER_COURT = _struct(
    iep=_S, **_INTERVAL, nro=_S, caratula=_S, tproc=_S, **{"as": _S}, tres=_S,
    finicio=_S, fdesp1=_S, fres=_S, fvenc1=_S, fvenc2=_S,
)
RULINGS_ONE_DEADLINE = _struct(
    iep=_S, **_INTERVAL, nro=_S, caratula=_S, tproc=_S, **{"as": _S}, tres=_S,
    finicio=_S, fdesp=_S, fres=_S, fvenc=_S,
)
RULINGS_ONE_DEADLINE_HIGHER_COURT = _struct(
    iep=_S, **_INTERVAL, nro=_S, caratula=_S, tproc=_S, **{"as": _S}, tres=_S,
    finicio=_S, fdesp1=_S, fres=_S, fvenc=_S,
)
RULINGS_APPEAL = T.StructType(
    [*RULINGS_ONE_DEADLINE_HIGHER_COURT.fields, T.StructField("recirc", T.BooleanType(), True)]
)
RULINGS_THIRD_INSTANCE = _struct(
    iep=_S, **_INTERVAL, nro=_S, caratula=_S, tproc=_S, **{"as": _S}, tres=_S, fres=_S,
)
STARTED_CASES = _struct(
    iep=_S, nro=_S, caratula=_S, tproc=_S, finicio=_S, fmov=_S,
)
STARTED_COUNTS = _struct(
    circunscripcion=_S, organismo=_S, grupo_proceso=_S, tipo_proceso=_S, cantidad=_L,
)
MEDIATIONS = _struct(
    iep=_S, tipo_circ=_S, **_INTERVAL, tres_disc=_S, duracion=_I,
)
MOVEMENTS = _struct(
    jurisdiccion=_S, juzgado=_S, fecha=_D, movimientos_tipo=_S, cantidad=_L,
)
SUBMISSIONS = _struct(
    id_submission=_L, iep=_S, operation=_S, jurisdiction=_S, **_INTERVAL,
    enabled=T.BooleanType(), datetime=_S, input=_S,
)
COURTS = _struct(
    organismo=_S, organismo_descripcion=_S, circunscripcion=_S, materia=_S,
)
OPERATIONS = _struct(operacion=_S, operacion_descripcion=_S)
POSTS = _struct(puesto=_S, idagente=_S)
PERSONNEL = _struct(idagente=_S, categoria=_S, apellido=_S, nombres=_S)

# The hearing listing: 18 TAB-separated columns in fixed order, all read as text.
HEARING_COLUMNS = (
    "nro", "caratula", "tproc", "asis", "finicio", "duracm", "duracb", "ffa", "fea",
    "faprueb", "fprog", "ta", "ra", "esta", "jaud", "oralidad", "audvid", "justiables",
)
HEARING_INTS = ("asis", "duracm", "duracb")
HEARING_DATES = ("finicio", "ffa", "fea", "faprueb", "fprog")
CORRUPT = "_corrupt_record"
HEARINGS_RAW = _struct(**{c: _S for c in HEARING_COLUMNS}, **{CORRUPT: _S})

BUDGET = _struct(anio=_I, monto=T.DoubleType(), concepto=_S)

# The seven budget amounts (year, amount, concept).
BUDGET_ROWS = (
    (2017, 2718527.0, "gasto_personal"),
    (2018, 3995684.0, "gasto_personal"),
    (2019, 4003967.0, "gasto_personal"),
    (2017, 0.0, "activos_intangibles"),
    (2018, 2196000.0, "activos_intangibles"),
    (2019, 1000000.0, "activos_intangibles"),
    (2018, 2900000.0, "aportes_no_reintegrables"),
)


def budget_table(spark: SparkSession) -> DataFrame:
    """The inline constant table of budget amounts."""
    return spark.createDataFrame(list(BUDGET_ROWS), BUDGET)
