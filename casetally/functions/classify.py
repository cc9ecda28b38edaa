"""Procedure groups: ordered pattern rules per subject matter.

A rule is ``(pattern, group)``. Rules are tried in order on the upper-cased
procedure name, the first hit wins, and a name without a hit (or NULL) falls into
:data:`OTHER`. Groups in :data:`NOT_CASES` mark rows that are no cases of the
subject matter; they are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "OTROS"
NOT_CASES = ("noprocesos", "desclasificados", "error")

# Pattern rules in order of precedence.
RULES: dict[str, tuple[tuple[str, str], ...]] = {
    "civil": (
        ("^ORDINARIO|^ORDINARIO |USUCAP", "ORDINARIOS"),
        ("^SUMARISIMO|^SUMARISIMO ", "SUMARISIMO"),
        ("^INCIDENTE|^INCIDENTE ", "INCIDENTES"),
        ("^MEDIDA CAUTELAR|^MEDIDA CAUTELAR ", "CAUTELARES"),
        ("MONITORIO", "MONITORIOS"),
        ("^EJECU|^PROCESO DE EJECU|^APREMIO", "EJECUCIONES"),
        ("^INTERDICT", "INTERDICTOS"),
        ("AMPARO|HABEAS|INCONSTITUCIONALIDAD|ACCION DE PROHIBICION|ACCION DE EJECUCION",
         "PROC.COSTIT."),
        ("^PREPARACION ", "PREPARATORIOS"),
        ("^SUCESORIO", "SUCESORIOS"),
        ("^BENEFICIO", "BENEF.LITIG.SG."),
        ("^HOMOLOGACION", "HOMOLOGACIONES"),
        ("^DESALOJO", "DESALOJO"),
        ("^COBRO", "COBRO DE PESOS"),
        ("OFICIO|EXHORTO|SUMARIO|COMPENSACION|MATRICULA DE COMERCIANTE|DESARCHIVO|^INFORME"
         "|^DENUNCIA", "noprocesos"),
        ("CIVIL Y COMERCIAL|PROCESO LABORAL|PROCESO DE FAMILIA|CONCURSOS Y QUIEBRAS|^SENTENCIA"
         "|SOLICITA", "desclasificados"),
        ("CONCURSO CERRADO|EXPEDIENTE INTERNO|ADMINISTRATIVO|PERSONAL", "error"),
        ("LABORAL|TRABAJO|COMISION MEDICA|SUSTITUCION DE DEPOSITO|ENFERMEDAD PROFESIONAL|SALARIO"
         "|SINDICAL|CONCILIACION", "desclasificados"),
        ("VIOLENCIA|DIVORCIO|ALIMENTO|RESTRICCIONES CAPAC|REGIMEN COMUNIC|^IMPEDIMENTO DE CON",
         "desclasificados"),
        ("AMENAZA|^MEDIDA DE PROTEC|GUARDA|INSCRIPCION|INTERNACION|RECONSTRUCCION DE EX|CAPACIDAD"
         "|TUTELA|SALUD MENTAL|^SU ", "desclasificados"),
        ("^ADOPCION|^IMPUGNACION DE RECON|^USO DE DOCUMENTO|^TESTIMONIO", "desclasificados"),
    ),
    "familia": (
        ("VIOLENCIA FAMILIAR", "VIOLENCIA FAMILIAR"),
        ("VIOLENCIA DE GENERO", "VIOLENCIA DE GENERO"),
        ("HOMOLOGACION", "HOMOLOGACIONES"),
        ("DIVORCIO", "DIVORCIOS"),
        ("ALIMENTO", "ALIMENTOS"),
        ("^EJECU|^PROCESO DE EJECU", "EJECUCIONES"),
        ("^INCIDENTE|^INCIDENTE ", "INCIDENTES"),
        ("^MEDIDA", "MEDIDAS"),
        ("CAPACIDAD", "CAPACIDAD/INCAPAC."),
        ("^ORDINARIO|^ORDINARIO ", "ORDINARIOS"),
        ("^INTERNACION", "INTERNACIONES"),
        ("^AUTORIZACION", "AUTORIZACIONES"),
        ("^BENEFICIO", "BENEF.LITIG.SG."),
        ("^REGIMEN", "REGIMEN COMUNIC."),
        ("AMPARO|HABEAS|INCONSTITUCIONALIDAD|ACCION DE PROHIBICION|ACCION DE EJECUCION",
         "PROC.COSTIT."),
        ("^SU |^EXHORTO|^OFICIO|DESARCHIVO|^INFORME|^DENUNCIA|^TESTIMONIO", "noprocesos"),
        ("CONCURSOS Y QUIEBRAS|^SENTENCIA|SOLICITA|SUCESORIO|USUCAPION", "desclasificados"),
        ("CONCURSO CERRADO|EXPEDIENTE INTERNO|ADMINISTRATIVO|PERSONAL", "error"),
        ("LABORAL|TRABAJO|COMISION MEDICA|SUSTITUCION DE DEPOSITO|ENFERMEDAD PROFESIONAL|SALARIO"
         "|SINDICAL|CONCILIACION", "desclasificados"),
    ),
    "laboral": (
        ("^COBRO", "COBRO DE PESOS"),
        ("^ACCIDENTE", "ACCIDENTE DE TRABAJO"),
        ("^APELACION DIC", "APELACION COMISION MEDICA"),
        ("^HOMOLOGACION", "HOMOLOGACIONES"),
        ("^EJEC|^PROCESO DE EJECU|^APREMIO", "EJECUCIONES"),
        ("^ORDINARIO|^ORDINARIO ", "ORDINARIOS"),
        ("^SUMARISIMO|^SUMARISIMO ", "SUMARISIMO"),
        ("^INCIDENTE|^INCIDENTE ", "INCIDENTES"),
        ("^MEDIDA CAUTELAR|^MEDIDA CAUTELAR ", "CAUTELARES"),
        ("^MEDIDAS PREP", "MEDIDAS PREPARAT."),
        ("^BENEFICIO", "BENEF.LITIG.SG."),
        ("AMPARO|HABEAS|INCONSTITUCIONALIDAD|ACCION DE PROHIBICION|ACCION DE EJECUCION",
         "PROC.COSTIT."),
        ("OFICIO|EXHORTO|SUMARIO|COMPENSACION|MATRICULA DE COMERCIANTE|DESARCHIVO|^INFORME"
         "|^DENUNCIA", "noprocesos"),
        ("CIVIL Y COMERCIAL|PROCESO DE FAMILIA|CONCURSOS Y QUIEBRAS|^SENTENCIA|SOLICITA|SUCESORIO"
         "|USUCAPION", "desclasificados"),
        ("CONCURSO CERRADO|EXPEDIENTE INTERNO|ADMINISTRATIVO|MONITORI|PERSONAL", "error"),
        ("VIOLENCIA|DIVORCIO|ALIMENTO|RESTRICCIONES CAPAC|REGIMEN COMUNIC|^IMPEDIMENTO DE CON",
         "desclasificados"),
        ("AMENAZA|^MEDIDA DE PROTEC|GUARDA|INSCRIPCION|INTERNACION|RECONSTRUCCION DE EX|CAPACIDAD"
         "|TUTELA|SALUD MENTAL|^SU ", "desclasificados"),
        ("^ADOPCION|^IMPUGNACION DE RECON|^USO DE DOCUMENTO|^TESTIMONIO|^DESALOJO"
         "|^APELACION JUZGADO|^DIVISION DE|^SEGUNDO TEST", "desclasificados"),
    ),
    "pazproc": (
        ("^ORDINARIO|^ORDINARIO |USUCAP", "ORDINARIOS"),
        ("^SUMARISIMO|^SUMARISIMO ", "SUMARISIMO"),
        ("^COBRO DE PESOS", "COBRO DE PESOS"),
        ("^INCIDENTE|^INCIDENTE ", "INCIDENTES"),
        ("^MEDIDA CAUTELAR|^MEDIDA CAUTELAR ", "CAUTELARES"),
        ("MONITORIO", "MONITORIOS"),
        ("^EJECU|^PROCESO DE EJECU|^APREMIO", "EJECUCIONES"),
        ("^INTERDICT", "INTERDICTOS"),
        ("AMPARO|HABEAS|INCONSTITUCIONALIDAD|ACCION DE PROHIBICION|ACCION DE EJECUCION",
         "PROC.COSTIT."),
        ("^PREPARACION ", "PREPARATORIOS"),
        ("^SUCESORIO", "SUCESORIOS"),
        ("^BENEFICIO", "BENEF.LITIG.SG."),
        ("^HOMOLOGACION", "HOMOLOGACIONES"),
        ("^VIOLENCIA", "VIOLENCIAS"),
        ("OFICIO|EXHORTO|SUMARIO|COMPENSACION|MATRICULA DE COMERCIANTE|DESARCHIVO|^INFORME"
         "|^DENUNCIA|^SUPERVIVENCIA|^AUTORIZACION", "noprocesos"),
        ("CIVIL Y COMERCIAL|PROCESO LABORAL|PROCESO DE FAMILIA|CONCURSOS Y QUIEBRAS|^SENTENCIA"
         "|SOLICITA|PAZ", "desclasificados"),
        ("CONCURSO CERRADO|EXPEDIENTE INTERNO|ADMINISTRATIVO|PERSONAL|^LICENCIAS|^ARANCELES",
         "error"),
        ("LABORAL|TRABAJO|COMISION MEDICA|SUSTITUCION DE DEPOSITO|ENFERMEDAD PROFESIONAL|SALARIO"
         "|SINDICAL|CONCILIACION", "desclasificados"),
        ("DIVORCIO|ALIMENTO|RESTRICCIONES CAPAC|REGIMEN COMUNIC|^IMPEDIMENTO DE CON",
         "desclasificados"),
        ("AMENAZA|^LESIONES|^MEDIDA DE PROTEC|GUARDA|INSCRIPCION|INTERNACION|RECONSTRUCCION DE EX"
         "|CAPACIDAD|TUTELA|SALUD MENTAL|^SU ", "desclasificados"),
        ("^ADOPCION|^IMPUGNACION DE RECON|^USO DE DOCUMENTO|^TESTIMONIO", "desclasificados"),
        ("DILIGENCIAMIENTO|^CERTIFICACIONES|^MEDIDAS|(LOPJ)|^DILIGENCIAS", "desclasificados"),
    ),
    "paztram": (
        ("^CERTIFICACION", "CERTIFICACIONES"),
        ("^AUTORIZACION", "AUTORIZACIONES"),
        ("^CARTA PODER", "CARTAS PODER"),
        ("^CARTA DE POBREZA", "CARTAS DE POBREZA"),
        ("^DECLARACION JURADA", "DECLARACION JURADA"),
        ("^FORMULARIO", "FORMULARIOS (ANSES,DDJJ,LEY3011,etc)"),
        ("INFORMACION SUMARIA", "INFORMACION SUMARIA"),
        ("MEDIDAS ALTERNATIVAS", "CONTROL MED.ALTERNAT."),
        ("RUBRICA DE LIBROS", "RUBRICA DE LIBROS"),
    ),
    "ecq": (
        ("^ORDINARIO|^ORDINARIO |USUCAP", "ORDINARIOS"),
        ("^SUMARISIMO|^SUMARISIMO ", "SUMARISIMO"),
        ("^INCIDENTE|^INCIDENTE ", "INCIDENTES"),
        ("^MEDIDA CAUTELAR|^MEDIDA CAUTELAR ", "CAUTELARES"),
        ("MONITORIO", "MONITORIOS"),
        ("^EJECU|^PROCESO DE EJECU|^APREMIO", "EJECUCIONES"),
        ("^INTERDICT", "INTERDICTOS"),
        ("AMPARO|HABEAS|INCONSTITUCIONALIDAD|ACCION DE PROHIBICION|ACCION DE EJECUCION",
         "PROC.COSTIT."),
        ("^PREPARACION ", "PREPARATORIOS"),
        ("^SUCESORIO", "SUCESORIOS"),
        ("^BENEFICIO", "BENEF.LITIG.SG."),
        ("^HOMOLOGACION", "HOMOLOGACIONES"),
        ("^SECUESTRO PREND", "SECUESTRO PRENDARIO"),
        ("^CONCURSO|^QUIEBRA|^PEDIDO DE QUIEBRA", "CONCURSOS/QUIEBRAS"),
        ("OFICIO|EXHORTO|SUMARIO|COMPENSACION|MATRICULA DE COMERCIANTE|DESARCHIVO|^INFORME"
         "|^DENUNCIA", "noprocesos"),
        ("CIVIL Y COMERCIAL|PROCESO LABORAL|PROCESO DE FAMILIA|^SENTENCIA|SOLICITA",
         "desclasificados"),
        ("CONCURSO CERRADO|EXPEDIENTE INTERNO|ADMINISTRATIVO|PERSONAL", "error"),
        ("LABORAL|TRABAJO|COMISION MEDICA|SUSTITUCION DE DEPOSITO|ENFERMEDAD PROFESIONAL|SALARIO"
         "|SINDICAL|CONCILIACION", "desclasificados"),
        ("VIOLENCIA|DIVORCIO|ALIMENTO|RESTRICCIONES CAPAC|REGIMEN COMUNIC|^IMPEDIMENTO DE CON",
         "desclasificados"),
        ("AMENAZA|^MEDIDA DE PROTEC|GUARDA|INSCRIPCION|INTERNACION|RECONSTRUCCION DE EX|CAPACIDAD"
         "|TUTELA|SALUD MENTAL|^SU ", "desclasificados"),
        ("^ADOPCION|^IMPUGNACION DE RECON|^USO DE DOCUMENTO|^TESTIMONIO", "desclasificados"),
    ),
}


def procedure_group(upper_name: Column, matter: str) -> Column:
    """Group of an upper-cased procedure name."""
    chain = None
    for pattern, group in RULES[matter]:
        hit = upper_name.rlike(pattern)
        chain = F.when(hit, group) if chain is None else chain.when(hit, group)
    return chain.otherwise(OTHER)


def classify(
    df: DataFrame, matter: str, name: str = "tproc", into: str = "gtproc_forma"
) -> DataFrame:
    """Upper-case the procedure name, add its group and drop rows that are no cases.

    An unknown subject matter leaves the rows as they are. The group is generated
    from an array that is empty for a row to drop: a filter on the group would be
    pushed below it and run the whole pattern chain a second time.
    """
    if matter not in RULES:
        return df
    kept = F.array_except(
        F.array(procedure_group(F.col(name), matter)), F.array(*[F.lit(g) for g in NOT_CASES])
    )
    return df.withColumn(name, F.upper(name)).select("*", F.explode(kept).alias(into))


def classified_counts(
    df: DataFrame, matter: str, by: tuple[str, ...], name: str = "tproc"
) -> DataFrame:
    """Cases per ``by`` and procedure group.

    Rows are counted per distinct name first, so the long pattern chain runs once
    per name that occurs and not once per case.
    """
    names = df.groupBy(*by, F.upper(name).alias(name)).agg(F.count("*").alias("cantidad"))
    return (
        classify(names, matter, name)
        .groupBy(*by, "gtproc_forma")
        .agg(F.sum("cantidad").alias("cantidad"))
    )
