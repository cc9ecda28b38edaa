"""The registered queries in plain SQL, to check the Spark results against.

The SQL is written from the meaning of each report and not from the Spark plans:
joins where Spark groups twice, windows where Spark joins, and so on.
"""

from __future__ import annotations

from casetally.functions import codes
from casetally.functions.classify import NOT_CASES, OTHER, RULES
from casetally.sources import starschema as star

ORACLE: dict[str, str] = {}

_MONTH_NAMES = (
    "['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre',"
    "'octubre','noviembre','diciembre']"
)


def _month(c: str) -> str:
    return f"list_extract({_MONTH_NAMES}, CAST(month({c}) AS INTEGER))"


def _case(value: str, table: dict[str, str], default: str) -> str:
    hits = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {value} {hits} ELSE {default} END"


_TPROC = (
    "trim(array_to_string(["
    + _case("p_type", star.PROCEDURES, "upper(p_type)") + ", "
    + _case("split_part(p_name, ' ', 1)", star.FIRST_WORDS, "upper(split_part(p_name, ' ', 1))") + ", "
    + _case("split_part(p_name, ' ', 2)", star.SECOND_WORDS, "upper(split_part(p_name, ' ', 2))")
    + "], ' '))"
)

_CASES = """cases AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS iep, l_orderkey AS nro, l_linenumber AS linea,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS istart,
    CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS iend,
    CASE l_returnflag WHEN 'R' THEN 's' WHEN 'A' THEN 'A' END AS clase,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE CAST(l_linenumber - 1 AS VARCHAR) END AS tres,
    CAST(o_orderdate AS DATE) AS fdesp,
    CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS fres,
    CAST(o_orderdate AS DATE) + 30 AS fvenc1, CAST(o_orderdate AS DATE) + 60 AS fvenc2,
    o_orderstatus = 'F' AS recirc{extra}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey{join}
)"""
_PLAIN = _CASES.format(extra="", join="")
_WITH_TPROC = _CASES.format(
    extra=f", {_TPROC} AS tproc", join=" JOIN part ON l_partkey = p_partkey"
)
_COURTS = """courts AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS organismo, n_name AS organismo_descripcion,
    r_name AS circunscripcion
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name <> 'NATION_24'
)"""


def _rulings(
    late: dict[str, str],
    monthly: bool,
    total: str | None,
    cases: str = _PLAIN,
    where: str = "TRUE",
    court: str = "iep",
    late_sum: str = "",
    closing_date: bool = False,
    select: str | None = None,
    period: tuple[str, str] = (star.START, star.END),
) -> str:
    """The rulings report; ``total`` is 'court', 'all' or None."""
    names = list(late)
    late_sum = late_sum or " + ".join(names)
    measures = ["causas_adespacho", "causas_resueltas", "a_termino", *names,
                "sentencias", "autos", "sin_clasif"]
    on = "r.organismo = p.organismo" + (" AND r.istart = p.mes" if monthly else "")
    sql = f"""
WITH {cases}, {_COURTS},
scoped AS (
  SELECT *, coalesce(fres >= istart AND fres < iend AND coalesce(tres, '') <> '0', FALSE) AS resuelta
  FROM cases WHERE {where} AND istart >= DATE '{period[0]}' AND iend <= DATE '{period[1]}'
),
rulings AS (
  SELECT {court} AS organismo{', istart, iend' if monthly else ''},
    count(*) FILTER (resuelta) AS causas_resueltas,
    count(*) FILTER (resuelta AND fres <= fvenc1) AS a_termino,
    {', '.join(f'{expr} AS {n}' for n, expr in late.items())},
    count(*) FILTER (resuelta AND upper(clase) = 'S') AS sentencias,
    count(*) FILTER (resuelta AND upper(clase) = 'A') AS autos,
    count(*) FILTER (resuelta AND (clase IS NULL OR upper(clase) NOT IN ('S', 'A'))) AS sin_clasif
  FROM scoped GROUP BY ALL
),
pending AS (
  SELECT iep AS organismo{", CAST(date_trunc('month', fdesp) AS DATE) AS mes" if monthly else ''},
    count(*) AS causas_adespacho
  FROM scoped WHERE fdesp >= DATE '{period[0]}' AND fdesp < DATE '{period[1]}' GROUP BY ALL
),
detail AS (
  SELECT c.circunscripcion, r.organismo, c.organismo_descripcion{', r.istart, r.iend' if monthly else ''},
    p.causas_adespacho, {', '.join('r.' + m for m in measures[1:])}
  FROM rulings r LEFT JOIN pending p ON {on} LEFT JOIN courts c ON r.organismo = c.organismo
),
rows_ AS (
  SELECT *, FALSE AS is_total FROM detail"""
    if total:
        by_court = total == "court"
        keys = ("circunscripcion, organismo, organismo_descripcion" if by_court
                else "'Total', NULL, NULL")
        sql += f"""
  UNION ALL SELECT {keys}{', NULL, NULL' if monthly else ''},
    {', '.join(f'coalesce(CAST(sum({m}) AS BIGINT), 0)' for m in measures)}, TRUE
  FROM detail{' GROUP BY circunscripcion, organismo, organismo_descripcion' if by_court else ''}"""
    months = f""", istart AS mes_inicio, CASE WHEN is_total THEN 'Total' ELSE {_month('istart')} END AS mes,
  CASE WHEN is_total THEN 13 ELSE CAST(month(istart) AS INTEGER) END AS mes_orden""" if monthly else ""
    sql += f"""
),
report AS (
SELECT circunscripcion, organismo, organismo_descripcion{months}, {', '.join(measures)},
  CAST(CAST(round_even(({late_sum}) / causas_resueltas * 100, 0) AS BIGINT) AS VARCHAR) || ' %'
    AS resol_vencidas{', iend - 1 AS fecha' if closing_date else ''}, is_total
FROM rows_ WHERE causas_resueltas > 0
)
SELECT {select or '*'} FROM report"""
    return sql


_TWO_LATE = {
    "luego_1er_venc": "count(*) FILTER (resuelta AND fres > fvenc1 AND fres <= fvenc2)",
    "luego_2do_venc": "count(*) FILTER (resuelta AND fres > fvenc2)",
}
_ONE_LATE = {"luego_1er_venc": "count(*) FILTER (resuelta AND fres > fvenc1)"}
_ADMIN_LATE = {"luego_venc": "count(*) FILTER (resuelta AND fres > fvenc1)"}

ORACLE["rulings_monthly"] = _rulings(_TWO_LATE, True, "court", closing_date=True)
ORACLE["rulings_range"] = _rulings(_TWO_LATE, False, "all")
ORACLE["rulings_from_text_dates"] = ORACLE["rulings_range"]
ORACLE["rulings_range_no_total"] = _rulings(_ADMIN_LATE, False, None)
ORACLE["rulings_single_deadline"] = _rulings(_ONE_LATE, True, "court")
ORACLE["rulings_excluding_regex"] = _rulings(
    _TWO_LATE, True, "court", cases=_WITH_TPROC,
    where="NOT regexp_matches(tproc, 'VIOLENCIA')",
    court="CASE iep WHEN '21' THEN '1' WHEN '22' THEN '2' WHEN '23' THEN '3' WHEN '20' THEN '3' ELSE iep END",
)
ORACLE["rulings_peace_range"] = _rulings(
    _TWO_LATE, False, None, cases=_WITH_TPROC,
    where="NOT regexp_matches(tproc, "
          "'VIOLENCIA|CERTIFICACION|PROBATION|DILIGENCIAS|INFORMACION SUMARIA|SU ')",
)
ORACLE["rulings_appeal_variant"] = _rulings(
    {"luego_1er_venc": "count(*) FILTER (resuelta AND fres > fvenc1 AND recirc) + "
                       "count(*) FILTER (resuelta AND fres > fvenc1 AND NOT recirc)"},
    True, "court",
)
ORACLE["rulings_appeal_null_flag"] = ORACLE["rulings_labour_higher"] = ORACLE["rulings_single_deadline"]
_NOT_LEFT_OUT = "iep NOT IN (" + ", ".join(f"'{c}'" for c in star.LEFT_OUT) + ")"
ORACLE["rulings_some_courts"] = _rulings(_TWO_LATE, True, "court", where=_NOT_LEFT_OUT)
ORACLE["rulings_single_month"] = _rulings(
    _TWO_LATE, True, "all", closing_date=True, period=("1997-03-01", "1997-04-01")
)
ORACLE["rulings_printed"] = _rulings(
    _ADMIN_LATE, True, "court",
    select='circunscripcion AS "circunscripción", organismo_descripcion AS organismo, mes, '
           'causas_adespacho AS "causas a despacho del mes", causas_resueltas AS "causas resueltas", '
           'a_termino AS "a termino", luego_venc AS "luego Vencim", sentencias, autos, '
           'sin_clasif AS "sin clasif", resol_vencidas AS "resol vencidas"',
)
ORACLE["pending_by_month"] = f"""
WITH {_PLAIN}
SELECT iep, CAST(date_trunc('month', fdesp) AS DATE) AS mes_inicio, count(*) AS causas_adespacho,
  {_month('any_value(fdesp)')} AS mes
FROM cases GROUP BY 1, 2"""


def _by_type(labels: dict[str, str], default: str, keep_null: bool, name: str = "tipo_resolucion",
             classes: str = "'S'", override: str = "", where: str = "TRUE") -> str:
    code = "(tres IS NULL OR tres <> '0')" if keep_null else "tres <> '0'"
    kind = _case("tres", labels, f"'{default}'")
    if override:
        kind = f"CASE WHEN upper(clase) = 'A' THEN '{override}' ELSE {kind} END"
    return f"""
WITH {_PLAIN}, {_COURTS},
counted AS (
  SELECT circunscripcion, organismo_descripcion, {kind} AS {name}, count(*) AS cantidad
  FROM cases LEFT JOIN courts ON iep = organismo
  WHERE {where} AND fres IS NOT NULL AND upper(clase) IN ({classes}) AND fres >= istart AND fres < iend AND {code}
  GROUP BY 1, 2, 3
)
SELECT *, FALSE AS is_total FROM counted
UNION ALL
SELECT circunscripcion, organismo_descripcion, NULL, CAST(sum(cantidad) AS BIGINT), TRUE
FROM counted GROUP BY 1, 2"""


ORACLE["rulings_by_type_keep_null"] = _by_type(codes.CIVIL_RULINGS, "Sent.Definitiva", True)
ORACLE["rulings_by_type_some_courts"] = _by_type(
    codes.CIVIL_RULINGS, "Sent.Definitiva", True, where=_NOT_LEFT_OUT
)
ORACLE["rulings_by_type_drop_null"] = _by_type(codes.CIVIL_THIRD_RULINGS, "sin dato", False)
ORACLE["rulings_by_type_labour"] = _by_type(codes.LABOUR_RULINGS, "Sent.Definitiva", True)
ORACLE["rulings_by_type_labour_third"] = _by_type(codes.LABOUR_THIRD_RULINGS, "sin dato", False)
ORACLE["rulings_by_type_override"] = _by_type(
    codes.ENFORCEMENT_RULINGS, "Sentencia", True, "tipo_sentencia", "'S', 'A'", "Sent_Quiebra"
)


def _listing(two: bool, where: str = "TRUE", show_due: bool = True, total: bool = True,
             first_only: bool = False) -> str:
    due = ("fvenc1, fvenc2," if two else "fvenc1 AS fvenc,") if show_due else ""
    ok = "(tres IS NULL OR tres <> '0') AND fres >= istart AND fres < iend"
    first = "fres > fvenc1" + (" AND fres <= fvenc2" if two and not first_only else "")
    second = f"CASE WHEN fres > fvenc2 AND {ok} THEN 1 END AS res_luego2venc," if two else ""
    if first_only:
        second = "CAST(NULL AS INTEGER) AS res_luego2venc,"
    sums = ["med_mej_prov", "atermino", "res_luego1venc",
            *(["res_luego2venc"] if two else []), "inconsistencia2venc"]
    return f"""
WITH {_PLAIN}, {_COURTS},
listing AS (
  SELECT circunscripcion, organismo_descripcion, CAST(month(istart) AS INTEGER) AS mes_orden,
    {_month('istart')} AS mes, nro, fdesp AS fecha_despacho, {due} fres AS fecha_resolucion,
    CASE WHEN tres = '0' THEN 1 END AS med_mej_prov,
    CASE WHEN fres <= fvenc1 AND {ok} THEN 1 END AS atermino,
    CASE WHEN {first} AND {ok} THEN 1 END AS res_luego1venc, {second}
    CAST(NULL AS INTEGER) AS inconsistencia2venc
  FROM cases LEFT JOIN courts ON iep = organismo WHERE fres IS NOT NULL AND {where}
)
""" + (f"""SELECT *, FALSE AS is_total FROM listing
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, {('NULL, NULL,' if two else 'NULL,') if show_due else ''} NULL,
  {', '.join(f'coalesce(CAST(sum({c}) AS BIGINT), 0)' for c in sums)}, TRUE FROM listing"""
           if total else "SELECT * FROM listing")


ORACLE["case_listing_two_deadlines"] = _listing(True)
ORACLE["case_listing_one_deadline"] = _listing(False)
ORACLE["case_listing_labour_higher"] = _listing(False, show_due=False)
ORACLE["case_listing_some_courts"] = _listing(True, _NOT_LEFT_OUT, total=False)
ORACLE["case_listing_third_instance"] = _listing(True, _NOT_LEFT_OUT, first_only=True)
ORACLE["case_inconsistency"] = f"""
WITH {_PLAIN}, {_COURTS},
marked AS (
  SELECT *, (tres IS NULL OR tres <> '0') AND fres >= istart AND fres < iend AS vale,
    fvenc1 - 25 AS segundo
  FROM cases WHERE fres IS NOT NULL
)
SELECT circunscripcion, organismo_descripcion, CAST(month(istart) AS INTEGER) AS mes_orden,
  count(*) AS causas,
  CAST(sum(CASE WHEN vale AND fres <= fvenc1 THEN 1 END) AS BIGINT) AS atermino,
  CAST(sum(CASE WHEN vale AND fres > segundo THEN 1 END) AS BIGINT) AS luego_2do,
  CAST(sum(CASE WHEN vale AND fres <= fvenc1 AND fres > segundo THEN 1 END) AS BIGINT) AS inconsistentes
FROM marked LEFT JOIN courts ON iep = organismo GROUP BY 1, 2, 3"""

_MEDIATIONS = """mediations AS (
  SELECT o_orderkey AS nro, CAST(c_nationkey AS VARCHAR) AS iep, r_name AS tipo_circ,
    c_mktsegment AS tres_disc, CAST(o_orderdate AS DATE) AS finicio,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS istart,
    CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS iend
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
_OUTCOME_COUNTS = """count(*) FILTER (tres_disc = 'BUILDING') AS building,
    count(*) FILTER (tres_disc = 'FURNITURE') AS furniture,
    count(*) FILTER (tres_disc = 'HOUSEHOLD') AS household,
    count(*) FILTER (tres_disc NOT IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD')) AS otros,
    count(*) AS total"""
ORACLE["mediation_pivot"] = f"""
WITH {_MEDIATIONS}
SELECT tipo_circ AS circunscripcion, istart AS mes_inicio, {_month('istart')} AS mes,
  CAST(month(istart) AS INTEGER) AS mes_orden, {_OUTCOME_COUNTS}, iend - 1 AS fecha, FALSE AS is_total
FROM mediations GROUP BY tipo_circ, istart, iend
UNION ALL
SELECT tipo_circ, NULL, 'Total', 13, {_OUTCOME_COUNTS}, NULL, TRUE FROM mediations GROUP BY tipo_circ"""
ORACLE["mediation_range"] = f"""
WITH {_MEDIATIONS}
SELECT tipo_circ AS circunscripcion, {_OUTCOME_COUNTS}, FALSE AS is_total
FROM mediations GROUP BY tipo_circ
UNION ALL SELECT 'Total', {_OUTCOME_COUNTS}, TRUE FROM mediations"""
ORACLE["mediation_some_courts"] = f"""
WITH {_MEDIATIONS}, held AS (SELECT * FROM mediations WHERE {_NOT_LEFT_OUT})
SELECT tipo_circ AS circunscripcion, {_OUTCOME_COUNTS}, FALSE AS is_total FROM held GROUP BY tipo_circ
UNION ALL SELECT 'Total', {_OUTCOME_COUNTS}, TRUE FROM held"""
ORACLE["mediation_single_month"] = f"""
WITH {_MEDIATIONS}, held AS (SELECT * FROM mediations WHERE istart = DATE '1997-03-01')
SELECT tipo_circ AS circunscripcion, istart AS mes_inicio, 'marzo' AS mes, 3 AS mes_orden,
  {_OUTCOME_COUNTS}, iend - 1 AS fecha, FALSE AS is_total FROM held GROUP BY tipo_circ, istart, iend
UNION ALL SELECT 'Total', NULL, 'Total', 13, {_OUTCOME_COUNTS}, NULL, TRUE FROM held"""
_ALL_OUTCOMES = ", ".join(
    f"count(*) FILTER (tres_disc = '{o}') AS \"{o}\""
    for o in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
) + """, count(*) FILTER (tres_disc IS NULL) AS otros, count(*) AS "Total"\n"""
ORACLE["mediation_all_outcomes"] = f"""
WITH {_MEDIATIONS}
SELECT tipo_circ AS "circunscripción", {_month('istart')} AS mes, {_ALL_OUTCOMES}
FROM mediations GROUP BY tipo_circ, istart
UNION ALL SELECT tipo_circ, 'Total', {_ALL_OUTCOMES} FROM mediations GROUP BY tipo_circ"""
_DURATION = """count(*) AS resultado,
  CAST(median(date_diff('day', finicio, CAST(l_shipdate AS DATE))) AS DOUBLE) AS mediana_durac_inic_fin
FROM mediations JOIN lineitem ON nro = l_orderkey"""
ORACLE["median_duration"] = f"""
WITH {_MEDIATIONS} SELECT tipo_circ, tres_disc, {_DURATION} GROUP BY tipo_circ, tres_disc"""
ORACLE["median_duration_monthly"] = f"""
WITH {_MEDIATIONS} SELECT tipo_circ, tres_disc, istart AS data_interval_start,
  iend AS data_interval_end, {_DURATION} GROUP BY ALL"""

_SUBMITTING = """courts AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS organismo, s_name AS organismo_descripcion,
    n_name AS circunscripcion
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""
_MOVEMENTS = """movements AS (
  SELECT circunscripcion AS jurisdiccion,
    CASE user_id % 4 WHEN 0 THEN 'JUZGADO DE FAMILIA' WHEN 1 THEN 'juzgado de paz'
      WHEN 2 THEN 'DEFENSORIA DE FAMILIA' ELSE 'Juzgado FAM. y Penal' END || ' ' || organismo AS juzgado,
    CAST(ts AS DATE) AS fecha,
    CASE event_type WHEN 'click' THEN 'violencia_familiar' WHEN 'view' THEN 'violencia_c-mujer' END
      AS movimientos_tipo
  FROM events JOIN courts ON CAST(user_id AS VARCHAR) = organismo
)"""


def _title(c: str) -> str:
    word = "upper(w[1]) || lower(w[2:])"
    return f"array_to_string([{word} for w in string_split({c}, ' ')], ' ')"


ORACLE["movements_pivot"] = f"""
WITH {_SUBMITTING}, {_MOVEMENTS},
counted AS (
  SELECT jurisdiccion, juzgado,
    count(*) FILTER (movimientos_tipo = 'violencia_familiar') AS violencia_familiar,
    count(*) FILTER (movimientos_tipo = 'violencia_c-mujer') AS violencia_c_mujer
  FROM movements
  WHERE movimientos_tipo IS NOT NULL AND lower(juzgado) LIKE '%fam%'
    AND lower(juzgado) NOT LIKE '%defensor%'
    AND fecha >= DATE '2024-01-01' AND fecha <= DATE '2024-01-31'
  GROUP BY 1, 2
)
SELECT {_title('jurisdiccion')} AS jurisdiccion, {_title('juzgado')} AS juzgado, violencia_familiar,
  violencia_c_mujer, violencia_familiar + violencia_c_mujer AS total FROM counted"""
ORACLE["movements_by_type"] = f"""
WITH {_SUBMITTING}, {_MOVEMENTS}
SELECT jurisdiccion, juzgado, movimientos_tipo, count(*) AS cantidad FROM movements
WHERE fecha BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1, 2, 3"""
ORACLE["grand_total"] = f"""
WITH {_MEDIATIONS}, {_COURTS},
counted AS (
  SELECT iep AS organismo, count(*) AS causas, count(*) FILTER (tres_disc = 'BUILDING') AS edificios
  FROM mediations GROUP BY 1
)
SELECT circunscripcion, organismo, organismo_descripcion, causas, edificios, FALSE AS is_total,
  causas + edificios AS total
FROM counted LEFT JOIN courts USING (organismo)
UNION ALL
SELECT NULL, NULL, NULL, CAST(sum(causas) AS BIGINT), CAST(sum(edificios) AS BIGINT), TRUE,
  CAST(sum(causas + edificios) AS BIGINT) FROM counted"""

_PROCEDURES = f"procedures AS (SELECT p_brand AS organismo, {_TPROC} AS tproc FROM part)"


def _group(matter: str) -> str:
    hits = " ".join(
        f"WHEN regexp_matches(tproc, '{pattern}') THEN '{group}'" for pattern, group in RULES[matter]
    )
    return f"CASE {hits} ELSE '{OTHER}' END"


_DROPPED = ", ".join(f"'{g}'" for g in NOT_CASES)
for _matter in RULES:
    ORACLE[f"classify_{_matter}"] = f"""
WITH {_PROCEDURES}
SELECT organismo, {_group(_matter)} AS gtproc_forma, count(*) AS cantidad FROM procedures
GROUP BY 1, 2 HAVING gtproc_forma NOT IN ({_DROPPED})"""
ORACLE["classified_rows"] = f"""
WITH {_PROCEDURES}, grouped AS (SELECT *, {_group('civil')} AS gtproc_forma FROM procedures)
SELECT * FROM grouped WHERE gtproc_forma NOT IN ({_DROPPED})"""

ORACLE["latest_per_case"] = """
SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey FROM orders
QUALIFY rank() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC) = 1"""
ORACLE["started_union_distinct"] = """
WITH source AS (
  SELECT CAST(o_custkey % 25 AS VARCHAR) AS iep, CAST(o_custkey AS VARCHAR) AS nro,
    o_orderpriority AS caratula,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'OFICIO' ELSE 'ORDINARIO' END AS tproc,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS finicio, CAST(o_orderdate AS DATE) AS fmov,
    o_orderstatus = 'F' AS older
  FROM orders
),
older AS (
  SELECT * FROM source
  WHERE older AND tproc NOT LIKE '%OFICIO%' AND finicio < DATE '1998-07-01'
  QUALIFY fmov = max(fmov) OVER (PARTITION BY nro, caratula)
)
SELECT iep, nro, caratula, tproc, finicio FROM older
UNION
SELECT iep, nro, caratula, tproc, finicio FROM source WHERE NOT older AND tproc NOT LIKE '%OFICIO%'"""

ORACLE["started_some_courts"] = f"""
WITH started AS ({ORACLE["started_union_distinct"].replace("FROM orders", f"""FROM orders
  WHERE CAST(o_custkey % 25 AS VARCHAR) NOT IN {star.LEFT_OUT}""")})
SELECT * FROM started"""

_LOG = """log AS (
  SELECT event_id AS id_submission, CAST(user_id AS VARCHAR) AS iep, event_type AS operation,
    CAST(date_trunc('month', ts) - to_months(CAST(event_id % 24 AS INTEGER)) AS DATE) AS istart,
    value > 2 AS enabled, CAST(CAST(ts AS DATE) AS VARCHAR) AS dia
  FROM events
)"""


def _tracking(per_cell: int, day: str = "dia", where: str = "TRUE") -> str:
    return f"""
WITH {_LOG}, {_SUBMITTING},
operations AS (
  SELECT * FROM (VALUES ('view', 'Resoluciones'), ('click', 'Audiencias'), ('signup', 'Iniciados'),
    ('purchase', 'Mediaciones')) AS t(operation, operacion_descripcion)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY iep, operation ORDER BY istart, id_submission) - 1 AS lugar
  FROM log WHERE enabled AND {where}
),
listed AS (
  SELECT iep, operation, lugar // {per_cell} + 1 AS part, count(*) AS presentaciones,
    string_agg(CAST(month(istart) AS VARCHAR) || ' (' || id_submission || '/' || {day} || ')', ', '
      ORDER BY lugar) AS periodos_informados
  FROM placed GROUP BY 1, 2, 3
),
named AS (
  SELECT circunscripcion, organismo_descripcion, iep, operacion_descripcion, part,
    periodos_informados, presentaciones
  FROM listed LEFT JOIN operations USING (operation) LEFT JOIN courts ON iep = organismo
)
SELECT *, FALSE AS is_total FROM named
UNION ALL
SELECT circunscripcion, organismo_descripcion, NULL, NULL, NULL, NULL,
  CAST(sum(presentaciones) AS BIGINT), TRUE
FROM named GROUP BY 1, 2"""


ORACLE["submission_tracking"] = _tracking(1000)
ORACLE["submission_tracking_parts"] = _tracking(5)
ORACLE["submission_tracking_gaps"] = _tracking(
    20, "CASE WHEN id_submission % 7 = 0 THEN '?' ELSE dia END",
    "iep IN (SELECT organismo FROM courts WHERE regexp_matches(circunscripcion, 'NATION_[0-9]$'))",
)
ORACLE["pending_by_schedule"] = f"""
WITH {_LOG}, {_SUBMITTING},
operations(operation) AS (VALUES ('view'), ('click'), ('signup'), ('purchase'), ('closing')),
months AS (
  SELECT CAST(m AS DATE) AS mes_inicio
  FROM generate_series(DATE '2022-01-01', DATE '2024-01-01', INTERVAL 1 MONTH) AS t(m)
)
SELECT organismo AS iep, operation, mes_inicio FROM courts, operations, months
EXCEPT SELECT iep, operation, istart FROM log WHERE enabled"""
ORACLE["has_submission"] = f"""
WITH {_LOG}
SELECT coalesce(bool_or(regexp_matches(operation, 'click|view')), FALSE) AS presentada
FROM log WHERE enabled"""
ORACLE["pending_submissions"] = f"""
WITH {_LOG}, pairs AS (SELECT DISTINCT iep, operation FROM log),
months AS (
  SELECT CAST(m AS DATE) AS mes_inicio
  FROM generate_series(DATE '2022-01-01', DATE '2024-01-01', INTERVAL 1 MONTH) AS t(m)
)
SELECT iep, operation, mes_inicio FROM pairs, months
EXCEPT SELECT iep, operation, istart FROM log WHERE enabled"""
ORACLE["current_submissions"] = f"""
WITH {_LOG}
SELECT id_submission, iep, operation, istart AS data_interval_start FROM log WHERE enabled"""

_STARTED = """started AS (
  SELECT CASE WHEN p_size <= 25 THEN 'NORTE' ELSE 'SUR' END AS circunscripcion, p_brand AS organismo,
    p_type AS grupo_proceso, p_name AS tipo_proceso, count(*) AS cantidad
  FROM part GROUP BY ALL
)"""


def _reallocation(receivers: tuple[str, ...], group_test: str) -> str:
    n = len(receivers)
    to = ", ".join(f"('{r}')" for r in receivers)
    share = f"CAST(round_even(todo / {n}.0, 0) AS BIGINT)" if n > 1 else "todo"
    return f"""
WITH {_STARTED}, receivers(nombre) AS (VALUES {to}),
moved AS (
  SELECT * FROM started WHERE organismo IN ('Brand#1', 'Brand#2') AND {group_test}
),
sums AS (
  SELECT circunscripcion, grupo_proceso, CAST(sum(cantidad) AS BIGINT) AS todo FROM moved GROUP BY 1, 2
)
SELECT circunscripcion, organismo, grupo_proceso, tipo_proceso, cantidad,
  CAST(NULL AS BIGINT) AS residuo
FROM started s WHERE NOT EXISTS (
  SELECT 1 FROM moved m WHERE m.organismo = s.organismo AND m.grupo_proceso = s.grupo_proceso
    AND m.tipo_proceso = s.tipo_proceso)
UNION ALL
SELECT circunscripcion, nombre, grupo_proceso, '-', {share}, todo - {n} * {share} FROM sums, receivers"""


ORACLE["reallocation_one_receiver"] = _reallocation(
    ("Brand#3",), "grupo_proceso IN ('ECONOMY', 'PROMO')"
)
ORACLE["reallocation_many"] = _reallocation(
    ("Brand#3", "Brand#4", "Brand#5", "Brand#6"), "grupo_proceso <> 'ECONOMY'"
)
ORACLE["conditional_correction"] = """
WITH started AS (
  SELECT CAST(o_custkey % 25 AS VARCHAR) AS iep, o_orderpriority AS tipo_procesos,
    o_orderkey AS iniciados, CAST(date_trunc('month', o_orderdate) AS DATE) AS data_interval_start,
    CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS data_interval_end
  FROM orders
)
SELECT * FROM started
WHERE NOT (iep = '7' AND regexp_matches(tipo_procesos, 'LOW|HIGH')
  AND EXISTS (SELECT 1 FROM started WHERE iep = '7')
  AND EXISTS (SELECT 1 FROM started WHERE data_interval_start > DATE '1998-01-01')
  AND EXISTS (SELECT 1 FROM started WHERE data_interval_end >= DATE '1999-01-01'))"""
ORACLE["code_remap"] = """
SELECT CASE c_nationkey WHEN 21 THEN '1' WHEN 22 THEN '2' WHEN 23 THEN '3' WHEN 20 THEN '3'
  ELSE CAST(c_nationkey AS VARCHAR) END AS iep, count(*) AS causas
FROM customer GROUP BY 1"""
ORACLE["code_labels"] = """
SELECT CASE WHEN l_returnflag = 'A' THEN 'Sent_Quiebra' WHEN l_linenumber = 1 THEN 'Conciliación'
  WHEN l_linenumber = 2 THEN 'Transacción' WHEN l_linenumber = 4 THEN 'Desistimiento'
  ELSE 'sin dato' END AS tipo, count(*) AS cantidad
FROM lineitem GROUP BY 1"""

_STAFF = """persons AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS idagente,
    CASE n_nationkey % 4 WHEN 0 THEN 'JUEZ DE CAMARA' WHEN 1 THEN 'SECRETARIO'
      WHEN 2 THEN 'ESCRIBIENTE' END AS categoria,
    n_name AS apellido, CAST(n_regionkey AS VARCHAR) AS nombres
  FROM nation
),
posts AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS puesto, CAST(s_nationkey AS VARCHAR) AS idagente FROM supplier
)"""
ORACLE["officials"] = f"""
WITH {_STAFF}
SELECT idagente, puesto, categoria, apellido, nombres FROM posts LEFT JOIN persons USING (idagente)
WHERE regexp_matches(categoria, 'JUEZ|SECRETARIO|VOCAL|FISCAL|DEFENSOR')"""
ORACLE["official_ids"] = f"""
WITH {_STAFF}
SELECT idagente FROM posts LEFT JOIN persons USING (idagente)
WHERE regexp_matches(categoria, 'JUEZ|SECRETARIO|VOCAL|FISCAL|DEFENSOR')
UNION ALL SELECT '0'"""
ORACLE["staff_lookup"] = f"""
WITH {_STAFF} SELECT * FROM persons WHERE idagente IN (SELECT idagente FROM posts)"""

ORACLE["period_label"] = f"""
WITH spans AS (
  SELECT date_trunc('month', o_orderdate) AS a, 1 + CAST(o_orderkey % 18 AS INTEGER) AS n,
    date_trunc('month', o_orderdate) + to_months(1 + CAST(o_orderkey % 18 AS INTEGER)) AS b
  FROM orders
),
named AS (
  SELECT *, {_month('a')} AS desde, {_month('b - INTERVAL 1 DAY')} AS hasta FROM spans
)
SELECT CASE WHEN n = 1 THEN desde || ' ' || year(a)
  WHEN n = 6 AND month(a) = 1 THEN 'primer semestre ' || year(a)
  WHEN n = 6 AND month(a) = 7 THEN 'segundo semestre ' || year(a)
  WHEN n > 12 THEN desde || ' ' || year(a) || ' - ' || hasta || ' ' || year(b)
  WHEN n = 12 THEN 'anual ' || year(a)
  ELSE desde || ' - ' || hasta || ' ' || year(a) END AS periodo, count(*) AS causas
FROM named GROUP BY 1"""
ORACLE["date_parts"] = f"""
WITH dated AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT CAST(year(d) AS INTEGER) AS anio, CAST(month(d) AS INTEGER) AS mes_orden,
  {_month('any_value(d)')} AS mes,
  strftime(max(d), '%d-%m-%Y') AS ultimo, strftime(min(d) - 1, '%d/%m/%Y') AS anterior,
  CAST((year(d) - 1990) * 12 + month(d) - 1 AS INTEGER) AS meses
FROM dated GROUP BY year(d), month(d)"""

_AMOUNTS = """amounts AS (
  SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS anio,
    CAST(round_even(sum(o_totalprice) / 1000000, 1) AS DECIMAL(28, 1)) AS millones
  FROM orders GROUP BY 1, 2 HAVING round_even(sum(o_totalprice) / 1000000, 1) <> 0
)"""


def _label(members: str, name: str) -> str:
    total = f"CAST(coalesce(sum(millones) FILTER (o_orderpriority IN ({members})), 0) AS DECIMAL(28, 1))"
    return (f"'$' || regexp_replace(CAST({total} AS VARCHAR), '\\.0$', '') || ' millones' AS {name}")


ORACLE["category_amounts"] = f"""
WITH {_AMOUNTS} SELECT o_orderpriority, anio, CAST(millones AS DOUBLE) AS millones FROM amounts"""
ORACLE["category_summary"] = f"""
WITH {_AMOUNTS}
SELECT {_label("'1-URGENT', '2-HIGH'", 'altas')}, {_label("'3-MEDIUM'", 'medias')},
  {_label("'5-LOW'", 'bajas')} FROM amounts"""

ORACLE["court_raw_rows"] = f"""
WITH {_PLAIN}
SELECT nro, linea, clase AS "as", tres, fdesp, fres, istart AS data_interval_start
FROM cases WHERE iep = '7'"""
ORACLE["population_by_regex"] = f"""
WITH {_MEDIATIONS}, {_COURTS}
SELECT iep, istart AS data_interval_start, count(*) AS causas FROM mediations
WHERE iep IN (SELECT organismo FROM courts WHERE regexp_matches(circunscripcion, 'AMERICA|EUROPE'))
GROUP BY 1, 2"""
ORACLE["columns_by_pattern"] = """
SELECT o_orderkey AS causa_orderkey, o_totalprice AS causa_totalprice, o_orderdate AS causa_orderdate
FROM orders"""

ORACLE["quality_index"] = f"""
WITH {_PLAIN},
shares AS (
  SELECT iep, istart AS data_interval_start, count(*) AS filas,
    count(*) FILTER (tres IS NOT NULL AND regexp_full_match(tres, '[0-9]+')) / count(*) AS codigo,
    count(*) FILTER (tres IS NULL OR tres = '' OR regexp_full_match(tres, '[0-9]+')) / count(*)
      AS codigo_o_vacio,
    count(*) FILTER (fres IS NOT NULL AND clase IS NOT NULL) / count(*) AS resolucion,
    count(*) FILTER (fdesp >= istart AND fdesp < iend) / count(*) AS despacho_en_intervalo
  FROM cases GROUP BY 1, 2
)
SELECT *, (codigo + codigo_o_vacio + resolucion + despacho_en_intervalo) / 4 AS indice_calidad
FROM shares"""
ORACLE["valid_events"] = """
WITH h AS (
  SELECT CAST(user_id AS VARCHAR) AS iep, event_id AS no,
    event_id % 5 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AS vale
  FROM events
),
shares AS (
  SELECT iep, count(*) AS filas, count(*) FILTER (vale) / count(*) AS audiencia,
    count(*) FILTER (vale AND no % 3 <> 0) / count(*) AS audiencia_penal,
    count(*) FILTER (no % 17 <> 0 AND no % 4 = 0 AND no % 19 <> 0) / count(*) AS sobreseimiento
  FROM h GROUP BY 1
)
SELECT *, (audiencia + audiencia_penal + sobreseimiento) / 3 AS indice_calidad FROM shares"""
ORACLE["field_conformity"] = """
SELECT event_type,
  count(*) FILTER (regexp_full_match(json_extract_string(props, '$.k'), '[0-9]+')) AS conformes,
  count(*) FILTER (props IS NULL OR NOT regexp_full_match(props, '[0-9]+')) AS no_conformes
FROM events GROUP BY 1"""
ORACLE["duplicate_events"] = """
SELECT l_orderkey, l_linenumber, count(*) AS registros FROM lineitem GROUP BY 1, 2 HAVING count(*) > 2"""
ORACLE["out_of_interval"] = f"""
WITH {_PLAIN}
SELECT iep, count(*) AS fuera FROM cases WHERE fdesp < istart OR fdesp >= iend GROUP BY 1"""
ORACLE["within_business_days"] = f"""
WITH {_PLAIN},
days AS (
  SELECT CAST(d AS DATE) AS dia,
    row_number() OVER (ORDER BY d) AS orden,
    sum(CASE WHEN isodow(d) < 6 AND CAST(d AS DATE) NOT IN (DATE '1996-05-01', DATE '1997-01-01',
      DATE '1998-12-25', DATE '1999-05-25', DATE '2000-07-09', DATE '2000-07-10') THEN 1 ELSE 0 END)
      OVER (ORDER BY d) AS habiles
  FROM generate_series(DATE '1994-01-01', DATE '2003-01-01', INTERVAL 1 DAY) AS t(d)
),
counted AS (
  SELECT iep, b.habiles - a.habiles AS habiles
  FROM cases JOIN days a ON fdesp = a.dia JOIN days b ON fres = b.dia
)
SELECT iep, count(*) AS resoluciones, count(*) FILTER (habiles < 50) AS en_termino,
  count(*) FILTER (habiles < 50) / count(*) AS proporcion
FROM counted GROUP BY 1"""
ORACLE["participants_exploded"] = """
SELECT c_custkey, 0 AS orden, c_name AS name, CAST(c_custkey AS VARCHAR) AS doc_id, 'ACTOR' AS role,
  c_mktsegment AS address FROM customer
UNION ALL
SELECT c_custkey, 1, lower(c_name), NULL, 'DEMANDADO', NULL FROM customer"""

ORACLE["mediation_open_outcomes"] = f"""
WITH {_MEDIATIONS},
scoped AS (SELECT * FROM mediations WHERE istart >= DATE '1996-03-01' AND iend <= DATE '1999-06-01'),
cells AS (
  SELECT tipo_circ AS circunscripcion, istart AS mes_inicio, {_month('istart')} AS mes, FALSE AS is_total,
    tres_disc, count(*) AS n FROM scoped GROUP BY tipo_circ, istart, tres_disc
  UNION ALL SELECT tipo_circ, NULL, 'Total', TRUE, tres_disc, count(*) FROM scoped GROUP BY tipo_circ, tres_disc
)
SELECT circunscripcion, mes_inicio, mes,
  CAST(sum(n) OVER (PARTITION BY circunscripcion, mes_inicio, is_total) AS BIGINT) AS total, is_total,
  CAST(row_number() OVER (PARTITION BY circunscripcion, mes_inicio, is_total ORDER BY tres_disc) - 1 AS INTEGER) AS lugar,
  tres_disc AS resultado, n AS cantidad
FROM cells"""
ORACLE["submissions_in_force"] = """
WITH days AS (
  SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 5 = 0
), placed AS (
  SELECT CAST(user_id AS VARCHAR) AS iep, event_type AS operation, days.day, event_id AS id_submission,
    row_number() OVER (PARTITION BY user_id, event_type, days.day ORDER BY ts DESC, event_id DESC) AS place
  FROM events JOIN days ON CAST(ts AS DATE) <= days.day WHERE event_id % 7 <> 0
)
SELECT iep, operation, day, id_submission FROM placed WHERE place = 1"""
_LINE_OPERATIONS = _case(
    "CAST(linea AS VARCHAR)", {str(k): v for k, v in star.LINE_OPERATIONS.items()}, "NULL"
)
ORACLE["indicators_all_operations"] = f"""
WITH {_WITH_TPROC}, {_MEDIATIONS},
ops AS (
  SELECT *, {_LINE_OPERATIONS} AS operation, linea IN (1, 5, 7) AS dos,
    coalesce(fres >= istart AND fres < iend AND coalesce(tres, '') <> '0', FALSE) AS resuelta
  FROM cases WHERE istart >= DATE '{star.START}' AND iend <= DATE '{star.END}' AND {_NOT_LEFT_OUT} AND NOT (
    linea = 5 AND regexp_matches(tproc, 'VIOLENCIA|CERTIFICACION|PROBATION|DILIGENCIAS|INFORMACION SUMARIA|SU '))
),
r AS (
  SELECT operation, iep, istart, iend, any_value(dos) AS dos, count(*) FILTER (resuelta) AS causas_resueltas,
    count(*) FILTER (resuelta AND fres <= fvenc1) AS a_termino,
    count(*) FILTER (resuelta AND fres > fvenc1 AND (NOT dos OR fres <= fvenc2)) AS luego_1er_venc,
    count(*) FILTER (resuelta AND fres > fvenc2) AS luego_2do_venc,
    count(*) FILTER (resuelta AND upper(clase) = 'S') AS sentencias,
    count(*) FILTER (resuelta AND upper(clase) = 'A') AS autos,
    count(*) FILTER (resuelta AND (clase IS NULL OR upper(clase) NOT IN ('S', 'A'))) AS sin_clasif
  FROM ops WHERE operation IS NOT NULL GROUP BY operation, iep, istart, iend
),
p AS (
  SELECT operation, iep, CAST(date_trunc('month', fdesp) AS DATE) AS mes, count(*) AS causas_adespacho
  FROM ops WHERE fdesp >= DATE '{star.START}' AND fdesp < DATE '{star.END}' GROUP BY ALL
),
m AS (
  SELECT tipo_circ, tres_disc, istart, iend, {_DURATION}
  WHERE istart >= DATE '{star.START}' AND iend <= DATE '{star.END}' AND {_NOT_LEFT_OUT} GROUP BY ALL
)
SELECT r.operation, r.iep AS organismo, NULL AS tipo_circ, NULL AS tres_disc, istart AS data_interval_start,
  iend AS data_interval_end, causas_adespacho, causas_resueltas, a_termino, luego_1er_venc,
  CASE WHEN dos THEN luego_2do_venc END AS luego_2do_venc, sentencias, autos, sin_clasif,
  CAST(NULL AS BIGINT) AS resultado, CAST(NULL AS DOUBLE) AS mediana_durac_inic_fin
FROM r LEFT JOIN p ON r.operation = p.operation AND r.iep = p.iep AND istart = mes
UNION ALL SELECT 'CRMED', NULL, tipo_circ, tres_disc, istart, iend, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  resultado, mediana_durac_inic_fin FROM m"""
ORACLE["within_district_business_days"] = f"""
WITH {_PLAIN}, {_COURTS},
off AS (
  SELECT DISTINCT r_name AS district, CAST(o_orderdate AS DATE) AS dia
  FROM orders JOIN region ON o_orderkey % 149 = r_regionkey
),
works AS (
  SELECT r_name AS district, CAST(d AS DATE) AS dia
  FROM region, generate_series(DATE '1994-01-01', DATE '2003-01-01', INTERVAL 1 DAY) AS t(d)
  WHERE isodow(d) < 6
    AND NOT EXISTS (SELECT 1 FROM off WHERE off.district = r_name AND off.dia = CAST(d AS DATE))
),
spans AS (
  SELECT circunscripcion, iep, fdesp, fres, count(*) AS n FROM cases JOIN courts ON iep = organismo
  WHERE fres IS NOT NULL GROUP BY ALL
),
counted AS (
  SELECT circunscripcion, iep, n, (
    SELECT count(*) FROM works WHERE district = circunscripcion AND dia > fdesp AND dia <= fres
  ) AS habiles FROM spans
)
SELECT circunscripcion, iep, CAST(sum(n) AS BIGINT) AS resoluciones,
  CAST(coalesce(sum(n) FILTER (habiles < 50), 0) AS BIGINT) AS en_termino,
  coalesce(sum(n) FILTER (habiles < 50), 0) / sum(n) AS proporcion
FROM counted GROUP BY 1, 2"""
ORACLE["reallocation_apportioned"] = """
WITH started AS (
  SELECT CASE WHEN p_size <= 25 THEN 'NORTE' ELSE 'SUR' END AS circunscripcion, p_brand AS organismo,
    p_type AS grupo_proceso, p_name AS tipo_proceso, count(*) AS cantidad
  FROM part GROUP BY ALL
),
moved AS (
  SELECT * FROM started WHERE organismo IN ('Brand#1', 'Brand#2') AND grupo_proceso <> 'ECONOMY'
),
sums AS (
  SELECT circunscripcion, grupo_proceso, CAST(sum(cantidad) AS BIGINT) AS todo FROM moved GROUP BY 1, 2
),
shares AS (
  SELECT *, todo * peso // 11 AS parte,
    row_number() OVER (PARTITION BY circunscripcion, grupo_proceso ORDER BY todo * peso % 11 DESC, nombre) AS lugar,
    todo - sum(todo * peso // 11) OVER (PARTITION BY circunscripcion, grupo_proceso) AS resto
  FROM sums, (VALUES ('Brand#3', 5), ('Brand#4', 3), ('Brand#5', 3), ('Brand#6', 0)) AS r(nombre, peso)
)
SELECT circunscripcion, organismo, grupo_proceso, tipo_proceso, cantidad, CAST(NULL AS BIGINT) AS residuo
FROM started s WHERE NOT EXISTS (
  SELECT 1 FROM moved m WHERE m.organismo = s.organismo AND m.grupo_proceso = s.grupo_proceso
    AND m.tipo_proceso = s.tipo_proceso AND m.circunscripcion = s.circunscripcion)
UNION ALL
SELECT circunscripcion, nombre, grupo_proceso, '-', CAST(parte + CASE WHEN lugar <= resto THEN 1 ELSE 0 END AS BIGINT), 0
FROM shares"""
