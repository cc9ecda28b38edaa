"""Code tables: ruling types, bankruptcy classes and merged courts.

The tables are short literals, so a lookup is an expression inside the scan's
generated code and needs neither a join nor a broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ruling-type codes of each operation, in code order.
CIVIL_RULINGS = {
    "1": "Conciliación",
    "2": "Transacción",
    "3": "Caducidad",
    "4": "Desistimiento",
    "5": "Allanamiento",
    "6": "Incompetencia",
    "7": "Excepción",
    "8": "Sentencia monitoria sin oposición",
    "9": "Sentencia monitoria con oposición",
    "10": "Sent.Definitiva",
    "11": "Rechazo “In Limine”",
    "31": "Sucesorio:Declarat.Herederos",
    "32": "Sucesorio:Ampliac./Rect.Declarat.Her.",
    "33": "Sucesorio:Aprobac.Testamento",
    "34": "Sucesorio:Inventario Avalúo",
    "35": "Sucesorio:Partic.yAdjudic.",
    "36": "Sucesorio:Herencia Vacante",
    "37": "Sucesorio:otras resoluciones",
}
ENFORCEMENT_RULINGS = {**CIVIL_RULINGS, "10": "Sentencia"}
LABOUR_RULINGS = {
    "1": "Conciliación",
    "2": "Transacción",
    "3": "Caducidad",
    "4": "Desistimiento",
    "5": "Allanamiento",
    "6": "Incompetencia",
    "7": "Excepciones Previas",
    "8": "Otra",
    "9": "Rechazo “In Limine”",
}
CIVIL_THIRD_RULINGS = {
    "1": "RIL Admisible",
    "2": "RIL Inadmisible",
    "3": "RIL Procedente",
    "4": "RIL Improcedente",
    "5": "Acepta Rec. De Queja",
    "6": "Rechaza Rec.de Queja",
    "7": "Concesión Rec. Extraordinario",
    "8": "Denegación Rec. Extraordinario",
    "9": "Regulación de Honorarios",
    "10": "OTRAS",
}
LABOUR_THIRD_RULINGS = {
    "1": "Declara Mal Concedido RIL",
    "2": "RIL Inadmisible",
    "3": "RIL Procedente",
    "4": "RIL Improcedente",
    "5": "Hace lugar Rec. De Queja",
    "6": "Rechaza Rec.de Queja",
    "7": "Concesión Rec. Extraordinario",
    "8": "Denegación Rec. Extraordinario",
    "9": "Regulación de Honorarios",
    "10": "Otras",
}

# Ruling classes that name a bankruptcy ruling by themselves.
BANKRUPTCY_CLASSES = {
    "S1": "Sent_Conc_Preventivo",
    "S2": "Sent_Conversion_Quieb_en_Conc",
    "S3": "Sent_Quiebra",
    "S4": "Sent_Verific_hasta_20_verif",
    "S5": "Sent_Verific_más_de_20_verif",
    "S6": "Sent_Homologación",
    "S7": "Otras",
}

# Codes of family courts that were merged, old to current.
MERGED_COURTS = {
    "jdofam0101con": "jdofam0100con",
    "jdofam0102con": "jdofam0300con",
    "jdofam0201con": "jdofam0200con",
    "jdofam0202con": "jdofam0300con",
    "jdofam0001gch": "jdofam0100gch",
    "jdofam0002gch": "jdofam0200gch",
    "jdofam0001uru": "jdofam0200uru",
    "jdofam0002uru": "jdofam0200uru",
}


def lookup(code: Column, table: Mapping[str, str]) -> Column:
    """Label of a code, NULL when the code is NULL or not listed.

    The table is a literal map, which Spark folds into a constant when it plans the
    query; it is not built per row.
    """
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(pairs, code)


def label(code: Column, table: Mapping[str, str], default: str) -> Column:
    """Label of a code, ``default`` for NULL and for codes not listed."""
    return F.coalesce(lookup(code, table), F.lit(default))


def overridden(base: Column, code: Column, table: Mapping[str, str]) -> Column:
    """``base``, replaced where a second code is listed."""
    return F.coalesce(lookup(code, table), base)


def remap(code: Column, table: Mapping[str, str] = MERGED_COURTS) -> Column:
    """Old codes replaced by current ones; other codes stay."""
    return F.coalesce(lookup(code, table), code)
