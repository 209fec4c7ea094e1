"""The registered queries restated in plain SQL for another engine.

Each text is a chain of common table expressions, from the derived dirty tables over cleaned rows
and resolved keys to the result. Only the parts a query needs are put in front of it.
"""

from __future__ import annotations

import re

from pulcra.catalogs import SPANISH_MONTHS
from pulcra.catalogs import WHITESPACE as WS

REF = "DATE '2026-03-18'"
EMAIL = r"(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
MONTHS = {m: sorted(n for n, v in SPANISH_MONTHS.items() if v == m) for m in range(1, 13)}
# White space inside dates, for this engine's patterns.
BLANK = r"\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def iso(x: str) -> str:
    return f"(CASE WHEN regexp_matches({strip(x)}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN try_cast({strip(x)} AS DATE) END)"


def parse_date(x: str) -> str:
    text = strip(x)
    spanish = rf"(?i)^(\d{{1,2}})[{BLANK}\-/]*(?:de[{BLANK}]*)?([a-z]{{3,10}})[{BLANK}\-/]*(?:de[{BLANK}]*)?(\d{{4}})$"
    month = f"lower(regexp_extract({text}, '{spanish}', 2))"
    number = " ".join(
        f"WHEN {month} IN ({', '.join(repr(n) for n in names)}) THEN '{m}'" for m, names in MONTHS.items()
    )
    year = f"regexp_extract({text}, '{spanish}', 3)"
    by_name = (
        f"CASE WHEN try_cast({year} AS INT) BETWEEN 1900 AND 2100 THEN "
        f"try_cast({year} || '-' || (CASE {number} END) || '-' || regexp_extract({text}, '{spanish}', 1) AS DATE) END"
    )
    swapped = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
    y, a, b = (f"regexp_extract({text}, '{swapped}', {i})" for i in (1, 2, 3))
    by_swap = (
        f"CASE WHEN try_cast({y} AS INT) BETWEEN 1900 AND 2100 THEN "
        f"try_cast({y} || '-' || {b} || '-' || {a} AS DATE) END"
    )
    return f"coalesce({iso(x)}, {by_name}, {by_swap})"


def try_int(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({strip(x)}, '^[+-]?\\d+(\\.0+)?$') "
        f"THEN try_cast(regexp_replace({strip(x)}, '\\.0+$', '') AS BIGINT) END)"
    )


def try_double(x: str) -> str:
    return f"(CASE WHEN regexp_matches({strip(x)}, '{NUMBER}') THEN try_cast({strip(x)} AS DOUBLE) END)"


def sex(x: str) -> str:
    return f"(CASE WHEN lower({strip(x)}) IN ('m', 'male', 'hombre') THEN 'M' WHEN lower({strip(x)}) IN ('f', 'female', 'mujer') THEN 'F' END)"


def status(x: str) -> str:
    names = ("Completada", "Cancelada", "Reprogramada")
    return "(CASE lower(" + strip(x) + ") " + " ".join(f"WHEN '{n.lower()}' THEN '{n}'" for n in names) + " END)"


def email_ok(x: str) -> str:
    return f"coalesce(regexp_matches({strip(x)}, '{EMAIL}'), false)"


def email(x: str) -> str:
    return f"(CASE WHEN {email_ok(x)} THEN lower({strip(x)}) END)"


def digits(x: str) -> str:
    return f"nullif(regexp_replace({x}, '[^0-9]+', '', 'g'), '')"


def phone(x: str) -> str:
    return f"(CASE WHEN length({digits(x)}) BETWEEN 10 AND 15 THEN {digits(x)} END)"


def age(d: str) -> str:
    later = f"(month({d}) > 3 OR (month({d}) = 3 AND day({d}) > 18))"
    return f"CAST(2026 - year({d}) - (CASE WHEN {later} THEN 1 ELSE 0 END) AS INT)"


def date_key(d: str) -> str:
    return f"CAST(coalesce(year({d}) * 10000 + month({d}) * 100 + day({d}), 0) AS INT)"


def share(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / nullif({den}, 0)"


P_COLUMNS = ["id_paciente", "nombre", "fecha_nacimiento", "edad", "sexo", "email", "telefono", "ciudad"]
C_COLUMNS = ["id_cita", "id_paciente", "fecha_cita", "especialidad", "medico", "costo", "estado_cita"]

PARTS: dict[str, str] = {}

PARTS["raw_p"] = """
SELECT k + copy * 100000000 AS source_row_id,
  CASE WHEN k % 211 = 7 THEN NULL ELSE CAST(k AS STRING) END AS id_paciente,
  c_name AS nombre,
  CASE k % 10
    WHEN 0 THEN CASE WHEN day(b) > 12 THEN CAST(year(b) AS STRING) || '-' || lpad(CAST(day(b) AS STRING),2,'0') || '-' || lpad(CAST(month(b) AS STRING),2,'0') ELSE '1959-06-33' END
    WHEN 1 THEN CAST(day(b) AS STRING) || (CASE WHEN k % 3 = 0 THEN '\u00a0de ' ELSE ' de ' END) || CASE month(b) WHEN 1 THEN 'enero' WHEN 2 THEN 'feb' WHEN 3 THEN 'marzo' WHEN 4 THEN 'abr' WHEN 5 THEN 'mayo' WHEN 6 THEN 'jun' WHEN 7 THEN 'julio' WHEN 8 THEN 'ago' WHEN 9 THEN 'set' WHEN 10 THEN 'oct' WHEN 11 THEN 'NOV' ELSE 'diciembre' END || ' de ' || CAST(year(b) AS STRING)
    WHEN 2 THEN CASE WHEN k % 20 = 2 THEN 'invalid' ELSE '' END
    WHEN 3 THEN NULL
    ELSE CAST(year(b) AS STRING) || '-' || lpad(CAST(month(b) AS STRING),2,'0') || '-' || lpad(CAST(day(b) AS STRING),2,'0') END AS fecha_nacimiento,
  CASE WHEN k % 101 = 0 THEN 'abc' WHEN k % 101 = 1 THEN '99999999999999999999' WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN CAST(2026 - year(b) AS STRING) ELSE CAST((k * 31) % 140 AS STRING) END AS edad,
  CASE k % 8 WHEN 0 THEN 'M' WHEN 1 THEN 'Female' WHEN 2 THEN ' male ' WHEN 3 THEN 'X' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'hombre' ELSE 'MUJER' END AS sexo,
  CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'bad-email' WHEN 2 THEN '  ' ELSE ' User.' || CAST(k AS STRING) || '@Example.com ' END AS email,
  CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN '123' WHEN 2 THEN 'abc' WHEN 3 THEN '1234567890123456' ELSE '317-' || lpad(CAST(k AS STRING),7,'0') END AS telefono,
  CASE WHEN k % 9 = 0 THEN NULL WHEN copy = 1 AND k % 2 = 1 THEN 'Otra' ELSE 'Ciudad ' || CAST(c_nationkey AS STRING) END AS ciudad
FROM (
  SELECT c_custkey AS k, copy, c_name, c_nationkey,
         DATE '1895-01-01' + CAST((c_custkey * 7919) % 48000 AS INT) AS b
  FROM customer CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1 AS copy) n
  WHERE copy = 0 OR c_custkey % 97 = 5
) s
"""

PARTS["raw_c"] = """
SELECT k + copy * 100000000 AS source_row_id,
  CASE WHEN k % 499 = 3 THEN NULL WHEN k % 499 = 4 THEN '  ' ELSE 'c-' || CAST(k AS STRING) END AS id_cita,
  CASE WHEN k % 53 = 1 THEN CAST(o_custkey + 5000000 AS STRING) WHEN k % 307 = 2 THEN NULL ELSE CAST(o_custkey AS STRING) END AS id_paciente,
  CASE k % 5
    WHEN 0 THEN NULL
    WHEN 1 THEN CASE WHEN day(f) > 12 THEN CAST(year(f) AS STRING) || '-' || lpad(CAST(day(f) AS STRING),2,'0') || '-' || lpad(CAST(month(f) AS STRING),2,'0') ELSE 'not-a-date' END
    ELSE CAST(year(f) AS STRING) || '-' || lpad(CAST(month(f) AS STRING),2,'0') || '-' || lpad(CAST(day(f) AS STRING),2,'0') END AS fecha_cita,
  CASE WHEN k % 6 = 0 THEN NULL ELSE ' ' || o_orderpriority || ' ' END AS especialidad,
  CASE WHEN k % 5 = 0 THEN '' ELSE 'Dr. ' || CAST(k % 5 AS STRING) END AS medico,
  CASE WHEN k % 401 = 0 THEN 'abc' WHEN k % 401 = 1 THEN '-5' WHEN k % 401 = 2 THEN '12d' WHEN k % 11 = 0 THEN NULL ELSE CAST(CAST(o_totalprice + copy * (k % 2) AS DECIMAL(12,2)) AS STRING) END AS costo,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETADA' WHEN 'O' THEN ' cancelada' ELSE CASE WHEN k % 2 = 0 THEN 'Reprogramada' WHEN k % 3 = 0 THEN NULL ELSE 'Pendiente' END END AS estado_cita
FROM (
  SELECT o_orderkey AS k, copy, o_custkey, o_totalprice, o_orderstatus, o_orderpriority,
         CAST(o_orderdate AS DATE) + CAST(8000 + (o_orderkey * 13) % 3000 AS INT) AS f
  FROM orders CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1 AS copy) n
  WHERE copy = 0 OR o_orderkey % 89 = 6
) s
"""

PARTS["typed_p"] = f"SELECT * REPLACE ({try_int('id_paciente')} AS id_paciente) FROM raw_p"
PARTS["typed_c"] = (
    f"SELECT * REPLACE ({try_int('id_paciente')} AS id_paciente, {strip('id_cita')} AS id_cita) FROM raw_c"
)

PARTS["values_p"] = f"""
SELECT *, {sex('sexo')} AS sexo_n, {parse_date('fecha_nacimiento')} AS birth,
  {try_int('edad')} AS edad_limpia, {email('email')} AS email_n, {digits('telefono')} AS tel_digits,
  {phone('telefono')} AS telefono_n
FROM typed_p
"""
PARTS["ages_p"] = f"SELECT *, {age('birth')} AS derived FROM values_p"
PARTS["steps_p"] = """
SELECT *, CASE WHEN derived BETWEEN 0 AND 120 THEN derived END AS edad_derivada,
  CASE WHEN edad_limpia BETWEEN 0 AND 120 THEN CAST(edad_limpia AS INT) END AS ranged
FROM ages_p
"""
PARTS["rows_p"] = """
SELECT *, coalesce(abs(ranged - edad_derivada) > 2, false) AS edad_inconsistente,
  CASE WHEN ranged IS NULL OR abs(ranged - edad_derivada) > 2 THEN edad_derivada ELSE ranged END AS edad_n,
  concat_ws('|', coalesce(nombre, ''), coalesce(fecha_nacimiento, ''), coalesce(edad, ''), coalesce(sexo, ''),
    coalesce(email, ''), coalesce(telefono, ''), coalesce(ciudad, '')) AS sig
FROM steps_p
"""
PARTS["groups_p"] = """
SELECT id_paciente AS gid, count(DISTINCT sig) AS sigs, min(source_row_id) AS keeper
FROM rows_p WHERE id_paciente IS NOT NULL GROUP BY id_paciente
"""
PARTS["resolved_p"] = """
SELECT r.*, CASE WHEN id_paciente IS NULL THEN 'R_PK_MISSING' WHEN sigs > 1 THEN 'R_DUP_PK_CONFLICT'
  WHEN source_row_id <> keeper THEN 'R_DUP_PK_EXACT' END AS key_rule
FROM rows_p r LEFT JOIN groups_p g ON id_paciente = gid
"""
SHOWN_P = """source_row_id, id_paciente, nombre, CAST(birth AS VARCHAR) AS fecha_nacimiento, edad_n AS edad,
  sexo_n AS sexo, email_n AS email, telefono_n AS telefono, ciudad, sexo AS sexo_original,
  fecha_nacimiento AS fecha_nacimiento_original, edad AS edad_original, email AS email_original,
  telefono AS telefono_original, edad_limpia, edad_derivada, edad_inconsistente"""
PARTS["clean_p"] = f"SELECT {SHOWN_P} FROM resolved_p WHERE key_rule IS NULL"


def reason(rule: str) -> str:
    texts = {
        "R_PK_MISSING": "PK primaria faltante",
        "R_DUP_PK_CONFLICT": "PK duplicada con datos conflictivos",
        "R_COST_NON_NUMERIC": "Costo no numérico",
        "R_COST_NEGATIVE": "Costo negativo (valor inválido)",
        "R_ORPHAN_CITA": "Cita huérfana (FK id_paciente no encontrado en pacientes)",
    }
    return f"(CASE {rule} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in texts.items()) + " END)"


PARTS["rejected_p"] = f"""
SELECT {SHOWN_P}, key_rule AS rejection_rule_id, {reason('key_rule')} AS rejection_reason
FROM resolved_p WHERE key_rule IN ('R_PK_MISSING', 'R_DUP_PK_CONFLICT')
"""

PARTS["values_c"] = f"""
SELECT *, {parse_date('fecha_cita')} AS event, {status('estado_cita')} AS estado_n, {try_double('costo')} AS costo_n,
  nullif({strip('medico')}, '') AS medico_n, nullif({strip('especialidad')}, '') AS especialidad_n
FROM typed_c
"""
PARTS["rows_c"] = f"""
SELECT *, CASE WHEN coalesce({strip('id_cita')}, '') = '' THEN 'R_PK_MISSING'
    WHEN costo IS NOT NULL AND costo_n IS NULL THEN 'R_COST_NON_NUMERIC'
    WHEN costo_n < 0 THEN 'R_COST_NEGATIVE' END AS reject_rule,
  concat_ws('|', coalesce(CAST(id_paciente AS VARCHAR), ''), coalesce(fecha_cita, ''), coalesce(especialidad_n, ''),
    coalesce(medico_n, ''), coalesce(costo, ''), coalesce(estado_cita, '')) AS sig
FROM values_c
"""
PARTS["groups_c"] = """
SELECT id_cita AS gid, count(DISTINCT sig) AS sigs, min(source_row_id) AS keeper
FROM rows_c WHERE reject_rule IS NULL GROUP BY id_cita
"""
PARTS["resolved_c"] = """
SELECT r.*, CASE WHEN reject_rule IS NOT NULL THEN NULL WHEN sigs > 1 THEN 'R_DUP_PK_CONFLICT'
  WHEN source_row_id <> keeper THEN 'R_DUP_PK_EXACT' END AS key_rule
FROM rows_c r LEFT JOIN groups_c g ON id_cita = gid
"""
PARTS["clean_c"] = """
SELECT source_row_id, id_cita, id_paciente, CAST(event AS VARCHAR) AS fecha_cita, especialidad_n AS especialidad,
  medico_n AS medico, costo_n AS costo, estado_n AS estado_cita, fecha_cita AS fecha_cita_original,
  estado_cita AS estado_cita_original, costo AS costo_original, event
FROM resolved_c WHERE reject_rule IS NULL AND key_rule IS NULL
"""
PARTS["rejected_c"] = f"""
SELECT source_row_id, id_cita, id_paciente,
  CASE WHEN reject_rule = 'R_PK_MISSING' THEN fecha_cita ELSE CAST(event AS VARCHAR) END AS fecha_cita,
  CASE WHEN reject_rule IS NULL THEN especialidad_n ELSE especialidad END AS especialidad,
  CASE WHEN reject_rule IS NULL THEN medico_n ELSE medico END AS medico,
  costo,
  CASE WHEN reject_rule = 'R_PK_MISSING' THEN estado_cita ELSE estado_n END AS estado_cita,
  CASE WHEN coalesce(reject_rule, '') <> 'R_PK_MISSING' THEN fecha_cita END AS fecha_cita_original,
  CASE WHEN coalesce(reject_rule, '') <> 'R_PK_MISSING' THEN estado_cita END AS estado_cita_original,
  CASE WHEN coalesce(reject_rule, '') <> 'R_PK_MISSING' THEN costo END AS costo_original,
  {reason('coalesce(reject_rule, key_rule)')} AS rejection_reason, coalesce(reject_rule, key_rule) AS rejection_rule_id
FROM resolved_c WHERE reject_rule IS NOT NULL OR key_rule = 'R_DUP_PK_CONFLICT'
"""
KNOWN = "id_paciente IN (SELECT id_paciente FROM clean_p)"
PARTS["valid_c"] = f"SELECT * FROM clean_c WHERE id_paciente IS NOT NULL AND {KNOWN}"
PARTS["orphans_c"] = f"SELECT * FROM clean_c WHERE id_paciente IS NULL OR NOT {KNOWN}"


def issue(source: str, table: str, column: str, rule: str, severity: str, when: str, original: str, detail: str,
          clean: str = "NULL", row: str = "source_row_id") -> str:
    return f"""SELECT '{table}' AS "table", CAST({row} AS VARCHAR) AS row_id, '{rule}' AS rule_id,
  '{severity}' AS severity, '{column}' AS "column", CAST({original} AS VARCHAR) AS original_value,
  CAST({clean} AS VARCHAR) AS clean_value, '{detail}' AS detail FROM {source} WHERE {when}"""


BIRTH_TEXT = "coalesce(edad, 'NULL') || ' (nació: ' || coalesce(CAST(birth AS VARCHAR), 'NULL') || ')'"
KEYED = "coalesce(reject_rule, '') <> 'R_PK_MISSING'"
P, C = "pacientes", "citas_medicas"
MISSING = "Registro rechazado por PK primaria faltante."
CONFLICT = "Registros con la misma PK presentan diferencias; se rechazan."
EXACT = "Duplicado exacto por PK eliminado (keep first)."
FUTURE = (
    "Fecha de cita posterior a la fecha de referencia (2026-03-18). "
    "El registro se conserva (puede ser cita programada), pero queda marcado para revisión."
)
ISSUES = {
    "sexo": issue("resolved_p", P, "sexo", "R_SEXO_UNRECOGNIZED", "warning", "sexo IS NOT NULL AND sexo_n IS NULL", "sexo", "Valor de sexo no mapeado al catálogo (M/F)."),
    "birth": issue("resolved_p", P, "fecha_nacimiento", "R_FECHA_NAC_INVALID", "warning", "fecha_nacimiento IS NOT NULL AND birth IS NULL", "fecha_nacimiento", "Fecha de nacimiento no parseable (formato esperado YYYY-MM-DD)."),
    "derived": issue("resolved_p", P, "edad_derivada", "R_EDAD_DERIVADA_UNREASONABLE", "warning", "derived IS NOT NULL AND edad_derivada IS NULL", "derived", "Edad derivada fuera de rango razonable (0-120)."),
    "range": issue("resolved_p", P, "edad", "R_EDAD_PROVIDED_OUT_OF_RANGE", "warning", f"regexp_matches({strip('edad')}, '^[+-]?\\d+(\\.0+)?$') AND ranged IS NULL", "coalesce(CAST(edad_limpia AS VARCHAR), edad)", "Edad provista fuera de rango razonable (0-120)."),
    "filled": issue("resolved_p", P, "edad", "R_EDAD_FILLED_FROM_DERIVADA", "info", "ranged IS NULL AND edad_derivada IS NOT NULL", BIRTH_TEXT, "Se completó edad usando edad derivada (tolerancia=±2).", "edad_n"),
    "inconsistent": issue("resolved_p", P, "edad", "R_EDAD_INCONSISTENT_WITH_DERIVED", "warning", "abs(ranged - edad_derivada) > 2", BIRTH_TEXT, "Inconsistencia entre edad provista y derivada > 2 años.", "edad_n"),
    "email": issue("resolved_p", P, "email", "R_EMAIL_INVALID", "warning", "email IS NOT NULL AND email_n IS NULL", "email", "Email no cumple formato válido; se establece NULL."),
    "phone": issue("resolved_p", P, "telefono", "R_TELEFONO_INVALID_LENGTH", "warning", "tel_digits IS NOT NULL AND telefono_n IS NULL", "telefono", "Longitud de teléfono fuera de rango [10,15]."),
    "missing_p": issue("resolved_p", P, "id_paciente", "R_PK_MISSING", "error", "key_rule = 'R_PK_MISSING'", "id_paciente", MISSING),
    "conflict_p": issue("resolved_p", P, "id_paciente", "R_DUP_PK_CONFLICT", "error", "key_rule = 'R_DUP_PK_CONFLICT'", "id_paciente", CONFLICT),
    "exact_p": issue("resolved_p", P, "id_paciente", "R_DUP_PK_EXACT", "info", "key_rule = 'R_DUP_PK_EXACT'", "id_paciente", EXACT),
    "missing_c": issue("resolved_c", C, "id_cita", "R_PK_MISSING", "error", "reject_rule = 'R_PK_MISSING'", "id_cita", MISSING),
    "event": issue("resolved_c", C, "fecha_cita", "R_FECHA_CITA_INVALID", "warning", f"{KEYED} AND fecha_cita IS NOT NULL AND event IS NULL", "fecha_cita", "Fecha de cita no parseable (esperado YYYY-MM-DD)."),
    "future": issue("resolved_c", C, "fecha_cita", "R_FECHA_CITA_FUTURE", "warning", f"{KEYED} AND event > {REF}", "fecha_cita", FUTURE, "event"),
    "status": issue("resolved_c", C, "estado_cita", "R_ESTADO_CITA_UNRECOGNIZED", "warning", f"{KEYED} AND estado_cita IS NOT NULL AND estado_n IS NULL", "estado_cita", "Estado de cita no mapeado al catálogo."),
    "non_numeric": issue("resolved_c", C, "costo", "R_COST_NON_NUMERIC", "error", "reject_rule = 'R_COST_NON_NUMERIC'", "costo", "Costo no convertible a número; registro rechazado."),
    "negative": issue("resolved_c", C, "costo", "R_COST_NEGATIVE", "error", "reject_rule = 'R_COST_NEGATIVE'", "costo", "Costo negativo; registro rechazado."),
    "conflict_c": issue("resolved_c", C, "id_cita", "R_DUP_PK_CONFLICT", "error", "key_rule = 'R_DUP_PK_CONFLICT'", "id_cita", CONFLICT),
    "exact_c": issue("resolved_c", C, "id_cita", "R_DUP_PK_EXACT", "info", "key_rule = 'R_DUP_PK_EXACT'", "id_cita", EXACT),
    "orphan": issue("orphans_c", C, "id_paciente", "R_ORPHAN_CITA", "error", "true", "id_paciente", "El id_paciente en la cita no existe en la tabla pacientes."),
}
REMAINING = issue("clean_c", C, "estado_cita", "R_ESTADO_CITA_INVALID_REMAINING", "warning", "estado_cita_original NOT IN ('Completada', 'Cancelada', 'Reprogramada')", "estado_cita_original", "Estado de cita inválido presente luego de limpieza.")
REPEATED = issue("(SELECT count(*) - count(DISTINCT id_cita) AS extra FROM typed_c WHERE id_cita IS NOT NULL)", C, "id_cita", "R_DUP_PK_AFTER_CROSS_VALIDATION", "error", "extra > 0", "NULL", "Se detectaron duplicados de PK luego de las validaciones cruzadas (debería ser imposible).", row="'TABLE'")
PARTS["issues"] = "\nUNION ALL\n".join(f"SELECT {n} AS stage, * FROM ({sql}) i{n}" for n, sql in enumerate(ISSUES.values(), 1))
ISSUE_COLUMNS = '"table", row_id, rule_id, severity, "column", original_value, clean_value, detail'
RANK = "(CASE severity WHEN 'error' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END)"
NAME = "(CASE {} WHEN 2 THEN 'error' WHEN 1 THEN 'warning' ELSE 'info' END)"
PARTS["by_rule"] = f"SELECT rule_id, count(*) AS \"count\", {NAME.format(f'max({RANK})')} AS severity FROM issues GROUP BY rule_id"
PARTS["by_severity"] = 'SELECT severity, count(*) AS "count" FROM issues GROUP BY severity'
PARTS["firsts"] = "SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY stage, try_cast(row_id AS BIGINT)) AS nth FROM issues"
PARTS["ranked"] = """
SELECT r.*, f.stage, try_cast(f.row_id AS BIGINT) AS first_row,
  CAST(row_number() OVER (ORDER BY r."count" DESC, f.stage, try_cast(f.row_id AS BIGINT)) AS INT) AS rank
FROM by_rule r JOIN firsts f ON r.rule_id = f.rule_id AND f.nth = 1
"""
PARTS["evidence"] = f"""
SELECT CAST(row_number() OVER (ORDER BY f.stage, try_cast(f.row_id AS BIGINT)) AS INT) AS place,
  f."table", f.row_id, f.rule_id, f.severity, f."column", f.original_value, f.clean_value, f.detail
FROM firsts f JOIN ranked r ON f.rule_id = r.rule_id WHERE nth = 1 AND rank <= 8
QUALIFY place <= 5
"""
ACTIONS = {
    "R_ORPHAN_CITA": "Rechazo por FK huérfana",
    "R_DUP_PK_CONFLICT": "Rechazo por PK conflictiva",
    "R_COST_NON_NUMERIC": "Rechazo por costo inválido",
    "R_COST_NEGATIVE": "Rechazo por costo inválido",
    "R_DUP_PK_EXACT": "Deduplicación exacta (keep first)",
    "R_EDAD_FILLED_FROM_DERIVADA": "Corrección automática: rellenar edad",
    "R_EDAD_INCONSISTENT_WITH_DERIVED": "Corrección automática: ajustar edad a derivada",
    "R_EDAD_PROVIDED_OUT_OF_RANGE": "Nulificación: edad fuera de rango",
    "R_FECHA_NAC_INVALID": "Nulificación: fecha no parseable",
    "R_EMAIL_INVALID": "Nulificación: email inválido",
    "R_TELEFONO_INVALID_LENGTH": "Nulificación: teléfono fuera de rango",
    "R_FECHA_CITA_FUTURE": "Advertencia: fecha cita futura (registro conservado)",
}

# --- metrics: one part per side, tables as texts ------------------------------------------------

PARTS["before_p"] = "SELECT * FROM typed_p"
PARTS["before_c"] = "SELECT * FROM typed_c"
PARTS["after_p"] = "SELECT * REPLACE (CAST(edad AS VARCHAR) AS edad) FROM clean_p"
PARTS["after_c"] = "SELECT * REPLACE (CAST(costo AS VARCHAR) AS costo) FROM valid_c"


def metric(scope: str, table: str | None, column: str | None, name: str, value: str, source: str) -> str:
    def text(x: str | None) -> str:
        return f"'{x}'" if x else "CAST(NULL AS VARCHAR)"

    return (
        f"SELECT '{scope}' AS scope, {text(table)} AS \"table\", {text(column)} AS \"column\", "
        f"'{name}' AS metric_name, CAST({value} AS DOUBLE) AS metric_value FROM {source}"
    )


def metrics(side: str) -> dict[str, list[str]]:
    p, c = f"{side}_p", f"{side}_c"
    rows = "count(*)"

    def among_all(condition: str) -> str:
        return share(f"count(CASE WHEN {condition} THEN 1 END)", rows)

    pair = f"(SELECT try_cast(edad AS DOUBLE) AS e, {age(parse_date('fecha_nacimiento'))} AS d FROM {p} WHERE edad IS NOT NULL)"
    fk = f"(SELECT id_paciente AS fk, id_paciente IN (SELECT id_paciente FROM {p} WHERE id_paciente IS NOT NULL) AS known FROM {c} WHERE id_paciente IS NOT NULL)"
    fk_share = share("count(CASE WHEN known THEN 1 END)", rows)
    cells = " + ".join(
        [f"(SELECT count({x}) FROM {p})" for x in P_COLUMNS] + [f"(SELECT count({x}) FROM {c})" for x in C_COLUMNS]
    )
    total = f"({len(P_COLUMNS)} * (SELECT count(*) FROM {p}) + {len(C_COLUMNS)} * (SELECT count(*) FROM {c}))"
    one = "(SELECT 1) one"
    return {
        "rows": [metric("global", None, None, "row_count_total", f"(SELECT count(*) FROM {p}) + (SELECT count(*) FROM {c})", one)],
        "complete_global": [metric("global", None, None, "completeness_global_pct", share(f"({cells})", total), one)],
        "fk_global": [metric("global", None, None, "referential_integrity_fk_valid_pct_among_non_null", fk_share, fk)],
        "complete": [
            metric("table_column", t, x, "completeness_pct", f"CAST(count({x}) AS DOUBLE) / greatest(count(*), 1)", s)
            for t, s, names in ((P, p, P_COLUMNS), (C, c, C_COLUMNS))
            for x in names
        ],
        "valid_p": [
            metric("table", P, None, "fecha_nacimiento_validity_pct", among_all(f"{parse_date('fecha_nacimiento')} IS NOT NULL"), p),
            metric("table", P, None, "sexo_validity_pct", among_all(f"{sex('sexo')} IS NOT NULL"), p),
            metric("table", P, None, "email_validity_pct", among_all(email_ok("email")), p),
            metric("table", P, None, "telefono_validity_pct", among_all(f"length({digits('telefono')}) BETWEEN 10 AND 15"), p),
            metric("table", P, None, "edad_validity_pct", among_all(f"{try_double('edad')} BETWEEN 0 AND 120"), p),
        ],
        "age": [
            metric("table", P, None, "edad_consistency_pct", share("count(CASE WHEN abs(e - d) <= 2 THEN 1 END)", "count(d)"), pair),
            metric("table", P, None, "edad_consistency_pair_count", "count(d)", pair),
        ],
        "key_p": [metric("table", P, None, "pk_uniqueness_pct", share("count(DISTINCT id_paciente)", rows), p)],
        "valid_c": [
            metric("table", C, None, "fecha_cita_validity_pct", among_all(f"{parse_date('fecha_cita')} IS NOT NULL"), c),
            metric("table", C, None, "estado_cita_validity_pct", among_all(f"{status('estado_cita')} IS NOT NULL"), c),
            metric("table", C, None, "costo_validity_pct", among_all(f"{try_double('costo')} >= 0"), c),
        ],
        "key_c": [metric("table", C, None, "pk_uniqueness_pct", share("count(DISTINCT id_cita)", rows), c)],
        "fk": [
            metric("table", C, None, "fk_valid_pct_among_non_null", fk_share, fk),
            metric("table", C, None, "fk_valid_pair_count", "count(CASE WHEN known THEN 1 END)", fk),
            metric("table", C, None, "fk_non_null_count", rows, fk),
        ],
    }


BEFORE, AFTER = metrics("before"), metrics("after")


def union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


PARTS["metrics_before"] = union(*[m for group in BEFORE.values() for m in group])
PARTS["metrics_after"] = union(*[m for group in AFTER.values() for m in group])
PARTS["compared"] = """
SELECT b.scope, b."table", b."column", b.metric_name, b.metric_value AS before, a.metric_value AS after,
  a.metric_value - b.metric_value AS delta
FROM metrics_before b JOIN metrics_after a ON b.scope = a.scope AND b."table" IS NOT DISTINCT FROM a."table"
  AND b."column" IS NOT DISTINCT FROM a."column" AND b.metric_name = a.metric_name
"""

# --- profile --------------------------------------------------------------------------------------


def items(section: str, table: str, source: str, values: dict[str, str]) -> list[str]:
    return [
        f"SELECT '{table}' AS \"table\", '{section}' AS section, '{item}' AS item, CAST({value} AS BIGINT) AS value FROM {source}"
        for item, value in values.items()
    ]


def how_many(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


def dates(column: str) -> dict[str, str]:
    other = f"{column} IS NOT NULL AND {iso(column)} IS NULL"
    return {
        f"{column}_invalid_raw": how_many(other),
        f"{column}_recovered_by_swap": how_many(f"{other} AND {parse_date(column)} IS NOT NULL"),
        f"{column}_final_null": how_many(f"{other} AND {parse_date(column)} IS NULL"),
    }


CATEGORIES = {P: ("typed_p", ["sexo", "ciudad"]), C: ("typed_c", ["estado_cita", "especialidad", "medico"])}
PROFILE: dict[str, list[str]] = {"rows": [], "missing": [], "exact": [], "key": [], "unique": []}
for table, source, columns, key in ((P, "typed_p", P_COLUMNS, "id_paciente"), (C, "typed_c", C_COLUMNS, "id_cita")):
    everything = ", ".join(columns)
    PROFILE["rows"] += items("row_count", table, source, {"rows": "count(*)"})
    PROFILE["missing"] += items("missing_counts", table, source, {c: f"count(*) - count({c})" for c in columns})
    PROFILE["exact"] += items("duplicate_counts", table, f"(SELECT count(*) AS n FROM {source} GROUP BY {everything})", {"exact_duplicate_rows": "sum(n - 1)"})
    PROFILE["key"] += items("duplicate_counts", table, f"(SELECT count(*) AS n FROM {source} GROUP BY {key})", {"pk_duplicate_rows": "sum(n - 1)"})
    PROFILE["unique"] += items("categorical_cardinality", table, source, {c: f"count(DISTINCT {c})" for c in CATEGORIES[table][1]})
PROFILE["dates"] = items("format_anomalies", P, "typed_p", dates("fecha_nacimiento")) + items("format_anomalies", C, "typed_c", dates("fecha_cita"))
PROFILE["catalog_p"] = items("format_anomalies", P, "typed_p", {"sexo_invalid": how_many(f"sexo IS NOT NULL AND {sex('sexo')} IS NULL")})
PROFILE["catalog_c"] = items("format_anomalies", C, "typed_c", {"estado_cita_invalid": how_many(f"estado_cita IS NOT NULL AND {status('estado_cita')} IS NULL")})
PROFILE["email"] = items("format_anomalies", P, "typed_p", {"email_invalid": how_many(f"email IS NOT NULL AND NOT {email_ok('email')}")})
PROFILE["phone"] = items("format_anomalies", P, "typed_p", {"telefono_invalid": how_many(f"telefono IS NOT NULL AND coalesce(length({digits('telefono')}), 0) < 10")})
PROFILE["amount"] = items("format_anomalies", C, "typed_c", {"costo_non_numeric": how_many(f"costo IS NOT NULL AND {try_double('costo')} IS NULL"), "costo_negative": how_many(f"{try_double('costo')} < 0")})
PARTS["profile"] = union(*[sql for group in PROFILE.values() for sql in group])


def part_of_profile(*groups: str) -> str:
    return f'SELECT "table", item, value FROM ({union(*[sql for g in groups for sql in PROFILE[g]])}) p'


def top_values(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST({column} AS VARCHAR) AS value, count(*) AS "count",
  CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) AS INT) AS rank
FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} QUALIFY rank <= 5"""


PLACES = " ".join(
    f"WHEN \"table\" = '{t}' AND item = '{c}' THEN {i}"
    for t, names in ((P, P_COLUMNS), (C, C_COLUMNS))
    for i, c in enumerate(names)
)

# --- star -------------------------------------------------------------------------------------------


def catalog_dim(column: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY name) AS INT) AS key, name
FROM (SELECT DISTINCT {column} AS name FROM valid_c WHERE {column} IS NOT NULL AND {column} <> 'UNKNOWN') n
UNION ALL SELECT 0 AS key, 'UNKNOWN' AS name"""


PARTS["dim_paciente"] = "SELECT id_paciente AS paciente_key, id_paciente, nombre, sexo, ciudad FROM clean_p"
PARTS["dim_medico"] = f"SELECT key AS medico_key, name AS medico_nombre FROM ({catalog_dim('medico')}) d"
PARTS["dim_especialidad"] = f"SELECT key AS especialidad_key, name AS especialidad_nombre FROM ({catalog_dim('especialidad')}) d"
PARTS["dim_fecha"] = f"""
SELECT DISTINCT {date_key('event')} AS fecha_key, CAST(event AS VARCHAR) AS fecha_date, CAST(year(event) AS INT) AS ano,
  CAST(month(event) AS INT) AS mes, CAST(day(event) AS INT) AS dia FROM valid_c WHERE event IS NOT NULL
UNION ALL SELECT 0, 'UNKNOWN', NULL, NULL, NULL
"""
PARTS["fact_citas"] = f"""
SELECT id_cita, {date_key('event')} AS fecha_key, id_paciente AS paciente_key, coalesce(medico_key, 0) AS medico_key,
  coalesce(especialidad_key, 0) AS especialidad_key, costo, estado_cita
FROM valid_c LEFT JOIN dim_medico ON medico = medico_nombre LEFT JOIN dim_especialidad ON especialidad = especialidad_nombre
"""
STAR = ["dim_paciente", "dim_medico", "dim_especialidad", "dim_fecha", "fact_citas"]
PARTS["star_counts"] = union(*[f"SELECT '{t}' AS \"table\", count(*) AS row_count FROM {t}" for t in STAR])


def with_parts(body: str) -> str:
    """Put the parts that ``body`` names in front of it, in the order they build on each other."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n].strip()})" for n in needed) + "\n" + body


def values(source: str, raw: str, expression: str) -> str:
    return f"SELECT source_row_id, {raw}, {expression} AS value FROM {source}"


DATES = "(SELECT 'pacientes' AS \"table\", source_row_id, fecha_nacimiento AS raw FROM raw_p UNION ALL SELECT 'citas_medicas', source_row_id, fecha_cita FROM raw_c) d"


def date_values(expression: str) -> str:
    return f"SELECT \"table\", source_row_id, raw, {expression} AS value FROM (SELECT *, {parse_date('raw')} AS parsed FROM {DATES}) e"


EXPORT_P = "id_paciente, nombre, fecha_nacimiento, edad, edad_derivada, edad_inconsistente, sexo, email, telefono, ciudad"
EXPORT_C = ", ".join(C_COLUMNS)
REQUIRED = [(P, c, "typed_p") for c in ("id_paciente", "nombre", "fecha_nacimiento", "sexo")] + [
    (C, c, "typed_c") for c in ("id_cita", "id_paciente", "fecha_cita", "estado_cita")
]
GENERIC = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in C_COLUMNS) + ")"
SOLVENT = "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"
GENERIC_RESOLVED = f"""(SELECT t.*, CASE WHEN g.sigs > 1 THEN 'conflict' WHEN g.keeper <> t.source_row_id THEN 'exact'
    WHEN g.gid IS NULL THEN 'missing' ELSE 'keep' END AS fate
  FROM typed_c t LEFT JOIN (SELECT id_cita AS gid, count(DISTINCT {GENERIC}) AS sigs, min(source_row_id) AS keeper
    FROM typed_c WHERE coalesce(id_cita, '') <> '' GROUP BY id_cita) g ON t.id_cita = g.gid) r"""

BODIES: dict[str, str] = {
    "src_row_provenance": "SELECT row_number() OVER (ORDER BY source_row_id) - 1 AS source_row_id, source_row_id AS input_key, id_cita FROM raw_c",
    "src_limit_first_n": "SELECT * FROM typed_c ORDER BY source_row_id LIMIT 500",
    "src_read_tables": "SELECT * FROM typed_c",
    "src_document": "SELECT * REPLACE (row_number() OVER (ORDER BY source_row_id) - 1 AS source_row_id) FROM typed_c",
    "src_key_typing_double": "SELECT o_orderkey AS source_row_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey * 1000 END AS id_paciente FROM orders",
    "fn_phone_digits_double": "SELECT o_orderkey AS source_row_id, CAST(o_orderkey + 3170000000 AS VARCHAR) AS value FROM orders",
    "src_numbered_table": "SELECT file_row_number AS source_row_id, o_orderkey, o_custkey FROM (SELECT row_number() OVER () - 1 AS file_row_number, o_orderkey, o_custkey FROM orders) o",
    "src_key_typing": f"""SELECT 'pacientes' AS "table", source_row_id, {try_int('id_paciente')} AS id_paciente, CAST(NULL AS VARCHAR) AS id_cita, CAST(NULL AS VARCHAR) AS raw_id_cita FROM raw_p
UNION ALL SELECT 'citas_medicas', source_row_id, {try_int('id_paciente')}, {strip('id_cita')}, id_cita FROM raw_c""",
    "contract_required_columns": union(
        *[f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", true AS present, count({c}) AS non_null_count FROM {s}" for t, c, s in REQUIRED],
        f"SELECT '{C}', 'costo', false, 0",
    ),
    "export_clean_parent": f"SELECT {EXPORT_P} FROM clean_p",
    "sink_read_back": f"SELECT {EXPORT_P} FROM clean_p",
    "export_clean_child": f"SELECT {EXPORT_C} FROM clean_c",
    "quality_summary": union(
        "SELECT 'global_before' AS section, metric_name AS name, before AS value FROM compared WHERE scope = 'global'",
        "SELECT 'global_after', metric_name, after FROM compared WHERE scope = 'global'",
        "SELECT 'improvement', metric_name, delta FROM compared WHERE scope = 'global' AND metric_name <> 'row_count_total'",
        "SELECT 'rejected_counts', 'pacientes', CAST((SELECT count(*) FROM rejected_p) AS DOUBLE)",
        "SELECT 'rejected_counts', 'citas_medicas', CAST((SELECT count(*) FROM rejected_c) + (SELECT count(*) FROM orphans_c) AS DOUBLE)",
        "SELECT 'issue_stats', 'total_issues', CAST(count(*) AS DOUBLE) FROM issues",
        "SELECT 'issues_by_severity', severity, CAST(\"count\" AS DOUBLE) FROM by_severity",
        "SELECT 'issues_by_rule', rule_id, CAST(\"count\" AS DOUBLE) FROM by_rule",
        "SELECT 'counts', 'before_pacientes_rows', CAST(count(*) AS DOUBLE) FROM typed_p",
        "SELECT 'counts', 'before_citas_medicas_rows', CAST(count(*) AS DOUBLE) FROM typed_c",
        "SELECT 'counts', 'after_pacientes_rows', CAST(count(*) AS DOUBLE) FROM clean_p",
        "SELECT 'counts', 'after_citas_medicas_rows', CAST(count(*) AS DOUBLE) FROM valid_c",
        "SELECT 'dwh', \"table\", CAST(row_count AS DOUBLE) FROM star_counts",
    ),
    "star_row_counts": "SELECT * FROM star_counts",
    "star_published_counts": "SELECT * FROM star_counts",
    "fn_catalog_normalize": values("raw_p", "sexo", sex("sexo")),
    "fn_catalog_status": values("raw_c", "estado_cita", status("estado_cita")),
    "fn_email_valid": values("raw_p", "email", email_ok("email")),
    "fn_email_normalize": f"SELECT word, count(*) AS n, {email('word')} AS value FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents UNION ALL SELECT email FROM raw_p) w GROUP BY word",
    "fn_phone_digits": values("raw_p", "telefono", digits("telefono")),
    "fn_phone_gate": values("raw_p", "telefono", phone("telefono")),
    "fn_parse_date": date_values("CAST(parsed AS VARCHAR)"),
    "fn_strict_iso_date": date_values(f"{iso('raw')} IS NOT NULL"),
    "fn_age_at": date_values(age("parsed")),
    "fn_age_bounded": date_values(f"CASE WHEN {age('parsed')} BETWEEN 0 AND 120 THEN {age('parsed')} END"),
    "fn_date_key": date_values(date_key("parsed")),
    "fn_date_key_text": date_values(date_key(f"(CASE WHEN regexp_matches({strip('raw')}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_cast({strip('raw')} AS DATE) WHEN regexp_matches({strip('raw')}, '^\\d{{8}}$') THEN try_cast(substr({strip('raw')}, 1, 4) || '-' || substr({strip('raw')}, 5, 2) || '-' || substr({strip('raw')}, 7) AS DATE) END)")),
    "fn_date_key_parts": f"SELECT {date_key('d')} AS fecha_key, count(*) AS n, CAST(d AS VARCHAR) AS fecha_date, CAST(year(d) AS INT) AS ano, CAST(month(d) AS INT) AS mes, CAST(day(d) AS INT) AS dia FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) o GROUP BY d",
    "fn_try_int": values("raw_p", "edad", try_int("edad")),
    "fn_try_double": values("raw_c", "costo", try_double("costo")),
    "fn_text_normalize": values("raw_c", "especialidad", f"nullif({strip('especialidad')}, '')"),
    "fn_truncate_text": f"SELECT doc_id, CASE WHEN length(t) > 140 THEN substring(t, 1, 137) || '...' ELSE t END AS value FROM (SELECT doc_id, trim(replace(coalesce(text, 'NULL'), chr(10), ' '), '{WS}') AS t FROM documents) x",
    "fn_row_signature": f"SELECT source_row_id, {GENERIC} AS signature FROM typed_c",
    "rule_catalog_unrecognized": ISSUES["sexo"],
    "rule_date_invalid": ISSUES["birth"],
    "rule_derived_age_range": ISSUES["derived"],
    "rule_age_range": ISSUES["range"],
    "rule_age_filled": ISSUES["filled"],
    "rule_age_inconsistent": ISSUES["inconsistent"],
    "rule_email_invalid": ISSUES["email"],
    "rule_phone_length": ISSUES["phone"],
    "rule_pk_missing": union(ISSUES["missing_p"], ISSUES["missing_c"]),
    "rule_pk_conflict": union(ISSUES["conflict_p"], ISSUES["conflict_c"]),
    "rule_pk_exact_dup": union(ISSUES["exact_p"], ISSUES["exact_c"]),
    "rule_event_date_invalid": ISSUES["event"],
    "rule_event_date_future": ISSUES["future"],
    "rule_status_unrecognized": ISSUES["status"],
    "rule_amount_non_numeric": ISSUES["non_numeric"],
    "rule_amount_negative": ISSUES["negative"],
    "rule_column_missing": f"SELECT rule_id, count(*) AS \"count\", {NAME.format(f'max({RANK})')} AS severity FROM (SELECT rule_id, severity FROM issues WHERE \"table\" = 'pacientes' AND rule_id <> 'R_SEXO_UNRECOGNIZED' UNION ALL SELECT 'R_SEXO_MISSING', 'error') i GROUP BY rule_id",
    "rule_orphan_fk": ISSUES["orphan"],
    "rule_status_remaining": REMAINING,
    "rule_pk_dup_after": REPEATED,
    "clean_parent": "SELECT * FROM clean_p",
    "clean_parent_rejects": "SELECT * FROM rejected_p",
    "clean_contact": f"SELECT source_row_id, {email('email')} AS email, {phone('telefono')} AS telefono, email AS email_original, telefono AS telefono_original FROM typed_p",
    "clean_child": "SELECT * EXCLUDE (event) FROM clean_c",
    "clean_child_rejects": "SELECT * FROM rejected_c",
    "dedup_keep_first": f"SELECT source_row_id, id_cita FROM {GENERIC_RESOLVED} WHERE fate = 'keep'",
    "dedup_conflicts": f"SELECT * EXCLUDE (fate) FROM {GENERIC_RESOLVED} WHERE fate = 'conflict'",
    "dedup_exact_dropped": f"SELECT * EXCLUDE (fate) FROM {GENERIC_RESOLVED} WHERE fate = 'exact'",
    "validate_cross_refs": f"SELECT source_row_id, id_cita, id_paciente, CASE WHEN coalesce({KNOWN}, false) THEN NULL ELSE 'R_ORPHAN_CITA' END AS rejection_rule_id FROM clean_c",
    "join_fk_semi": f"SELECT o_orderkey, o_custkey FROM orders WHERE {SOLVENT}",
    "join_fk_anti": f"SELECT o_orderkey, o_custkey FROM orders WHERE NOT {SOLVENT}",
    "fk_integrity": f"SELECT {how_many('known')} AS fk_valid_pair_count, count(*) AS fk_non_null_count, {share(how_many('known'), 'count(*)')} AS fk_valid_pct_among_non_null FROM (SELECT id_paciente IN (SELECT id_paciente FROM typed_p WHERE id_paciente IS NOT NULL) AS known FROM typed_c WHERE id_paciente IS NOT NULL) f",
    "profile_row_count": part_of_profile("rows"),
    "profile_missing": part_of_profile("missing"),
    "profile_exact_dups": part_of_profile("exact"),
    "profile_pk_dups": part_of_profile("key"),
    "profile_date_anomalies": part_of_profile("dates"),
    "profile_catalog_invalid": part_of_profile("catalog_p", "catalog_c"),
    "profile_email_invalid": part_of_profile("email"),
    "profile_phone_invalid": part_of_profile("phone"),
    "profile_amount_anomalies": part_of_profile("amount"),
    "profile_cardinality": f"SELECT \"table\", item AS \"column\", value AS unique_count FROM ({union(*PROFILE['unique'])}) u",
    "profile_top_values": union(
        *[f"(SELECT * FROM ({top_values(s, c)}) t)" for s, c in (
            ("typed_p", "sexo"), ("typed_p", "ciudad"), ("typed_c", "estado_cita"), ("typed_c", "especialidad"),
            ("typed_c", "medico"), ("orders", "o_orderpriority"), ("orders", "o_custkey"))]
    ),
    "profile_dataset": "SELECT * FROM profile",
    "metric_completeness": union(*BEFORE["complete"]),
    "metric_completeness_global": union(*BEFORE["rows"], *BEFORE["complete_global"]),
    "metric_pk_uniqueness": union(*BEFORE["key_p"], *BEFORE["key_c"]),
    "metric_completeness_counts": union(*[
        f"SELECT '{t}' AS \"table\", '{x}' AS \"column\", count({x}) AS non_null_count, CAST(count({x}) AS DOUBLE) / greatest(count(*), 1) AS completeness_pct FROM {s}"
        for t, s, names in ((P, "before_p", P_COLUMNS), (C, "before_c", C_COLUMNS)) for x in names
    ]),
    "metric_pk_counts": union(*[
        f"SELECT '{t}' AS \"table\", count(DISTINCT {x}) AS unique_pk_count, count(*) - count(DISTINCT coalesce(CAST({x} AS VARCHAR), 'no key')) AS duplicate_pk_rows, {share(f'count(DISTINCT {x})', 'count(*)')} AS pk_uniqueness_pct FROM {s}"
        for t, s, x in ((P, "before_p", "id_paciente"), (C, "before_c", "id_cita"))
    ]),
    "metric_validity_parent": union(*BEFORE["valid_p"]),
    "metric_validity_child": union(*BEFORE["valid_c"]),
    "metric_age_consistency": union(*BEFORE["age"]),
    "metric_referential_integrity": union(*BEFORE["fk_global"], *BEFORE["fk"]),
    "metrics_long": "SELECT * FROM metrics_before",
    "metric_before_after": "SELECT * FROM compared",
    "issues_all": f"SELECT {ISSUE_COLUMNS} FROM issues",
    "issues_by_severity": "SELECT * FROM by_severity",
    "issues_by_rule": "SELECT * FROM by_rule",
    "rejected_counts": "SELECT 'pacientes' AS \"table\", (SELECT count(*) FROM rejected_p) AS rejected_rows UNION ALL SELECT 'citas_medicas', (SELECT count(*) FROM rejected_c) + (SELECT count(*) FROM orphans_c)",
    "rejects_union": f"""SELECT * FROM rejected_c UNION ALL BY NAME
SELECT source_row_id, id_cita, id_paciente, fecha_cita, especialidad, medico, costo_original AS costo, estado_cita,
  fecha_cita_original, estado_cita_original, costo_original, {reason("'R_ORPHAN_CITA'")} AS rejection_reason,
  'R_ORPHAN_CITA' AS rejection_rule_id FROM orphans_c""",
    "report_top_nulls": f"""SELECT "table", CAST(row_number() OVER (PARTITION BY "table" ORDER BY value DESC, CASE {PLACES} END) AS INT) AS rank,
  item AS "column", value AS null_count FROM profile WHERE section = 'missing_counts' QUALIFY rank <= 5""",
    "report_top_rules": 'SELECT rank, rule_id, "count" FROM ranked WHERE rank <= 10',
    "report_evidence": "SELECT * FROM evidence",
    "report_rule_impact": f"""SELECT r.rank, r.rule_id, coalesce(e."table", '?') AS "table", coalesce(e."column", '-') AS "column",
  CASE r.rule_id {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in ACTIONS.items())} ELSE 'Evento de auditoría' END AS action,
  r.severity, r."count" FROM ranked r LEFT JOIN evidence e ON r.rule_id = e.rule_id WHERE r.rank <= 10""",
    "report_completeness_delta": """SELECT place, c."table", c."column", before * 100 AS before_pct, after * 100 AS after_pct, (after - before) * 100 AS delta_pp
FROM compared c JOIN (VALUES (1, 'pacientes', 'email'), (2, 'pacientes', 'telefono'), (3, 'pacientes', 'sexo'), (4, 'pacientes', 'fecha_nacimiento'),
  (5, 'citas_medicas', 'estado_cita'), (6, 'citas_medicas', 'fecha_cita'), (7, 'citas_medicas', 'costo'), (8, 'citas_medicas', 'medico'),
  (9, 'citas_medicas', 'especialidad')) v(place, t, col) ON c."table" = t AND c."column" = col WHERE metric_name = 'completeness_pct'""",
    "star_dim_parent": "SELECT * FROM dim_paciente",
    "star_dim_catalog": "SELECT 'dim_medico' AS dimension, medico_key AS key, medico_nombre AS name FROM dim_medico UNION ALL SELECT 'dim_especialidad', especialidad_key, especialidad_nombre FROM dim_especialidad",
    "star_dim_date": "SELECT * FROM dim_fecha",
    "star_fact": "SELECT * FROM fact_citas",
    "star_fk_check": union(
        *[f"SELECT '{d}' AS dimension, count(*) AS orphan_rows FROM fact_citas f WHERE NOT EXISTS (SELECT 1 FROM {d} d WHERE d.{k} = f.{k})"
          for d, k in (("dim_paciente", "paciente_key"), ("dim_medico", "medico_key"), ("dim_especialidad", "especialidad_key"), ("dim_fecha", "fecha_key"))]
    ),
    "star_pk_check": union(
        *[f"SELECT '{t}' AS \"table\", '{c}' AS \"columns\", count(*) - count(DISTINCT {c}) AS duplicate_rows FROM {t}"
          for t, c in (("dim_paciente", "paciente_key"), ("dim_paciente", "id_paciente"), ("dim_medico", "medico_key"),
                       ("dim_medico", "medico_nombre"), ("dim_especialidad", "especialidad_key"),
                       ("dim_especialidad", "especialidad_nombre"), ("dim_fecha", "fecha_key"), ("fact_citas", "id_cita"))]
    ),
}

ORACLE = {name: with_parts(body) for name, body in BODIES.items()}
