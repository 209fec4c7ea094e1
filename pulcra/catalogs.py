"""Catalogs, month names, patterns, column contracts and rule texts.

These are data that results must agree on; no logic lives here.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- catalogs: lower-case raw value -> canonical value -----------------------------------

SEX_CATALOG = {
    "m": "M",
    "male": "M",
    "hombre": "M",
    "f": "F",
    "female": "F",
    "mujer": "F",
}

STATUS_CATALOG = {
    "completada": "Completada",
    "cancelada": "Cancelada",
    "reprogramada": "Reprogramada",
}

# --- Spanish month names ------------------------------------------------------------------

SPANISH_MONTHS = {
    "ene": 1,
    "enero": 1,
    "feb": 2,
    "febrero": 2,
    "mar": 3,
    "marzo": 3,
    "abr": 4,
    "abril": 4,
    "may": 5,
    "mayo": 5,
    "jun": 6,
    "junio": 6,
    "jul": 7,
    "julio": 7,
    "ago": 8,
    "agosto": 8,
    "sep": 9,
    "septiembre": 9,
    "set": 9,
    "setiembre": 9,
    "oct": 10,
    "octubre": 10,
    "nov": 11,
    "noviembre": 11,
    "dic": 12,
    "diciembre": 12,
}

# --- patterns (Java regular expressions); recovered dates lie in the years 1900 to 2100 ---------------------------------------------------

# Every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
EMAIL_PATTERN = r"(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}$"
ISO_DATE_PATTERN = r"^(?!0000)\d{4}-\d{1,2}-(\d{1,2}| [1-9])$"
# White space inside dates is any Unicode one; digits are ASCII.
SPANISH_DATE_PATTERN = r"(?iU)^([0-9]{1,2})[\s\-/]*(?:de\s*)?([a-z]{3,10})[\s\-/]*(?:de\s*)?(19[0-9]{2}|20[0-9]{2}|2100)$"
SWAPPED_DATE_PATTERN = r"(?U)^\s*\+?0*(19[0-9]{2}|20[0-9]{2}|2100)\s*-\s*\+?0*([0-9]{1,2})\s*-\s*\+?0*([0-9]{1,2})\s*$"
INTEGER_PATTERN = r"^[+-]?\d+(_\d+)*(\.0+)?$"
DECIMAL_PATTERN = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
INFINITY_PATTERN = r"(?i)^[+-]?inf(inity)?$"

# --- table and column names ----------------------------------------------------------------

PARENT_TABLE = "pacientes"
CHILD_TABLE = "citas_medicas"
PARENT_KEY = "id_paciente"
CHILD_KEY = "id_cita"
ROW_ID = "source_row_id"

PARENT_COLUMNS = [
    "id_paciente", "nombre", "fecha_nacimiento", "edad", "sexo", "email", "telefono", "ciudad",
]
CHILD_COLUMNS = [
    "id_cita", "id_paciente", "fecha_cita", "especialidad", "medico", "costo", "estado_cita",
]
REQUIRED_COLUMNS = {
    PARENT_TABLE: ["id_paciente", "nombre", "fecha_nacimiento", "sexo"],
    CHILD_TABLE: ["id_cita", "id_paciente", "fecha_cita", "estado_cita", "costo"],
}
PARENT_EXPORT_COLUMNS = [
    "id_paciente", "nombre", "fecha_nacimiento", "edad", "edad_derivada", "edad_inconsistente",
    "sexo", "email", "telefono", "ciudad",
]
CHILD_EXPORT_COLUMNS = CHILD_COLUMNS
REPORT_COMPLETENESS_COLUMNS = [
    (PARENT_TABLE, "email"),
    (PARENT_TABLE, "telefono"),
    (PARENT_TABLE, "sexo"),
    (PARENT_TABLE, "fecha_nacimiento"),
    (CHILD_TABLE, "estado_cita"),
    (CHILD_TABLE, "fecha_cita"),
    (CHILD_TABLE, "costo"),
    (CHILD_TABLE, "medico"),
    (CHILD_TABLE, "especialidad"),
]

# --- audit rules -----------------------------------------------------------------------------

SEVERITY_RANK = {"info": 0, "warning": 1, "error": 2}


@dataclass(frozen=True)
class Rule:
    rule_id: str
    severity: str
    column: str | None
    detail: str
    reason: str | None = None
    action: str = "Evento de auditoría"


SEX_UNRECOGNIZED = Rule(
    "R_SEXO_UNRECOGNIZED", "warning", "sexo", "Valor de sexo no mapeado al catálogo (M/F)."
)
SEX_MISSING = Rule("R_SEXO_MISSING", "error", "sexo", "Columna sexo ausente en la tabla.")
BIRTH_INVALID = Rule(
    "R_FECHA_NAC_INVALID",
    "warning",
    "fecha_nacimiento",
    "Fecha de nacimiento no parseable (formato esperado YYYY-MM-DD).",
    action="Nulificación: fecha no parseable",
)
DERIVED_AGE_UNREASONABLE = Rule(
    "R_EDAD_DERIVADA_UNREASONABLE",
    "warning",
    "edad_derivada",
    "Edad derivada fuera de rango razonable (0-120).",
)
AGE_OUT_OF_RANGE = Rule(
    "R_EDAD_PROVIDED_OUT_OF_RANGE",
    "warning",
    "edad",
    "Edad provista fuera de rango razonable (0-120).",
    action="Nulificación: edad fuera de rango",
)
AGE_FILLED = Rule(
    "R_EDAD_FILLED_FROM_DERIVADA",
    "info",
    "edad",
    "Se completó edad usando edad derivada (tolerancia=±{tolerance}).",
    action="Corrección automática: rellenar edad",
)
AGE_INCONSISTENT = Rule(
    "R_EDAD_INCONSISTENT_WITH_DERIVED",
    "warning",
    "edad",
    "Inconsistencia entre edad provista y derivada > {tolerance} años.",
    action="Corrección automática: ajustar edad a derivada",
)
EMAIL_INVALID = Rule(
    "R_EMAIL_INVALID",
    "warning",
    "email",
    "Email no cumple formato válido; se establece NULL.",
    action="Nulificación: email inválido",
)
PHONE_LENGTH = Rule(
    "R_TELEFONO_INVALID_LENGTH",
    "warning",
    "telefono",
    "Longitud de teléfono fuera de rango [{low},{high}].",
    action="Nulificación: teléfono fuera de rango",
)
KEY_MISSING = Rule(
    "R_PK_MISSING",
    "error",
    None,
    "Registro rechazado por PK primaria faltante.",
    reason="PK primaria faltante",
)
KEY_CONFLICT = Rule(
    "R_DUP_PK_CONFLICT",
    "error",
    None,
    "Registros con la misma PK presentan diferencias; se rechazan.",
    reason="PK duplicada con datos conflictivos",
    action="Rechazo por PK conflictiva",
)
KEY_EXACT = Rule(
    "R_DUP_PK_EXACT",
    "info",
    None,
    "Duplicado exacto por PK eliminado (keep first).",
    action="Deduplicación exacta (keep first)",
)
EVENT_DATE_INVALID = Rule(
    "R_FECHA_CITA_INVALID",
    "warning",
    "fecha_cita",
    "Fecha de cita no parseable (esperado YYYY-MM-DD).",
)
EVENT_DATE_FUTURE = Rule(
    "R_FECHA_CITA_FUTURE",
    "warning",
    "fecha_cita",
    "Fecha de cita posterior a la fecha de referencia ({reference_date}). "
    "El registro se conserva (puede ser cita programada), pero queda marcado para revisión.",
    action="Advertencia: fecha cita futura (registro conservado)",
)
STATUS_UNRECOGNIZED = Rule(
    "R_ESTADO_CITA_UNRECOGNIZED",
    "warning",
    "estado_cita",
    "Estado de cita no mapeado al catálogo.",
)
AMOUNT_NON_NUMERIC = Rule(
    "R_COST_NON_NUMERIC",
    "error",
    "costo",
    "Costo no convertible a número; registro rechazado.",
    reason="Costo no numérico",
    action="Rechazo por costo inválido",
)
AMOUNT_NEGATIVE = Rule(
    "R_COST_NEGATIVE",
    "error",
    "costo",
    "Costo negativo; registro rechazado.",
    reason="Costo negativo (valor inválido)",
    action="Rechazo por costo inválido",
)
ORPHAN = Rule(
    "R_ORPHAN_CITA",
    "error",
    "id_paciente",
    "El id_paciente en la cita no existe en la tabla pacientes.",
    reason="Cita huérfana (FK id_paciente no encontrado en pacientes)",
    action="Rechazo por FK huérfana",
)
STATUS_REMAINING = Rule(
    "R_ESTADO_CITA_INVALID_REMAINING",
    "warning",
    "estado_cita",
    "Estado de cita inválido presente luego de limpieza.",
)
KEY_DUP_AFTER = Rule(
    "R_DUP_PK_AFTER_CROSS_VALIDATION",
    "error",
    "id_cita",
    "Se detectaron duplicados de PK luego de las validaciones cruzadas (debería ser imposible).",
)

# The order in which rules write to the audit trail: parents, children, cross-table checks.
ISSUE_ORDER = [
    (PARENT_TABLE, SEX_UNRECOGNIZED),
    (PARENT_TABLE, SEX_MISSING),
    (PARENT_TABLE, BIRTH_INVALID),
    (PARENT_TABLE, DERIVED_AGE_UNREASONABLE),
    (PARENT_TABLE, AGE_OUT_OF_RANGE),
    (PARENT_TABLE, AGE_FILLED),
    (PARENT_TABLE, AGE_INCONSISTENT),
    (PARENT_TABLE, EMAIL_INVALID),
    (PARENT_TABLE, PHONE_LENGTH),
    (PARENT_TABLE, KEY_MISSING),
    (PARENT_TABLE, KEY_CONFLICT),
    (PARENT_TABLE, KEY_EXACT),
    (CHILD_TABLE, KEY_MISSING),
    (CHILD_TABLE, EVENT_DATE_INVALID),
    (CHILD_TABLE, EVENT_DATE_FUTURE),
    (CHILD_TABLE, STATUS_UNRECOGNIZED),
    (CHILD_TABLE, AMOUNT_NON_NUMERIC),
    (CHILD_TABLE, AMOUNT_NEGATIVE),
    (CHILD_TABLE, KEY_CONFLICT),
    (CHILD_TABLE, KEY_EXACT),
    (CHILD_TABLE, ORPHAN),
    (CHILD_TABLE, STATUS_REMAINING),
    (CHILD_TABLE, KEY_DUP_AFTER),
]
