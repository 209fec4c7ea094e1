"""Dirty parent and child tables derived from ``customer`` and ``orders`` by key arithmetic.

The given tables are clean and hold neither model, so the rules get their input from here. The
second copy of some keys comes from an array, not from a join. All values are texts, as read from
a raw source; ``typed`` applies the key typing of the readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulcra.catalogs import CHILD_TABLE, PARENT_TABLE
from pulcra.session import tune
from pulcra.sources.readers import spread, type_keys


def _iso(d: str) -> str:
    return f"CAST({d} AS STRING)"


def _swapped(d: str, otherwise: str) -> str:
    swapped = f"concat(substr({_iso(d)}, 1, 5), substr({_iso(d)}, 9, 2), substr({_iso(d)}, 5, 3))"
    return f"CASE WHEN day({d}) > 12 THEN {swapped} ELSE '{otherwise}' END"


def _copied(table: DataFrame, key: str, every: int, rest: int) -> DataFrame:
    copies = f"explode(CASE WHEN {key} % {every} = {rest} THEN array(0, 1) ELSE array(0) END)"
    return spread(table, key).selectExpr("*", f"{key} AS k", f"{copies} AS copy")


def raw_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = tune(spark).read.parquet(f"{sf_dir}/customer.parquet")
    rows = _copied(customer, "c_custkey", 97, 5).selectExpr(
        "k", "copy", "c_name", "c_nationkey",
        "DATE '1895-01-01' + CAST((k * 7919) % 48000 AS INT) AS b",
    )
    months = "array('enero','feb','marzo','abr','mayo','jun','julio','ago','set','oct','NOV','diciembre')"
    return rows.selectExpr(
        "k + copy * 100000000 AS source_row_id",
        "CASE WHEN k % 211 = 7 THEN NULL ELSE CAST(k AS STRING) END AS id_paciente",
        "c_name AS nombre",
        f"""CASE k % 10 WHEN 0 THEN {_swapped('b', '1959-06-33')}
              WHEN 1 THEN concat(day(b), CASE WHEN k % 3 = 0 THEN '\u00a0de ' ELSE ' de ' END, element_at({months}, month(b)), ' de ', year(b))
              WHEN 2 THEN CASE WHEN k % 20 = 2 THEN 'invalid' ELSE '' END
              WHEN 3 THEN NULL ELSE {_iso('b')} END AS fecha_nacimiento""",
        """CASE WHEN k % 101 = 0 THEN 'abc' WHEN k % 101 = 1 THEN '99999999999999999999' WHEN k % 3 = 0 THEN NULL
              WHEN k % 3 = 1 THEN CAST(2026 - year(b) AS STRING)
              ELSE CAST((k * 31) % 140 AS STRING) END AS edad""",
        """CASE k % 8 WHEN 0 THEN 'M' WHEN 1 THEN 'Female' WHEN 2 THEN ' male ' WHEN 3 THEN 'X'
              WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'hombre' ELSE 'MUJER' END AS sexo""",
        """CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'bad-email' WHEN 2 THEN '  '
              ELSE concat(' User.', k, '@Example.com ') END AS email""",
        """CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN '123' WHEN 2 THEN 'abc'
              WHEN 3 THEN '1234567890123456'
              ELSE concat('317-', lpad(CAST(k AS STRING), 7, '0')) END AS telefono""",
        """CASE WHEN k % 9 = 0 THEN NULL WHEN copy = 1 AND k % 2 = 1 THEN 'Otra'
              ELSE concat('Ciudad ', c_nationkey) END AS ciudad""",
    )


def raw_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tune(spark).read.parquet(f"{sf_dir}/orders.parquet")
    rows = _copied(orders, "o_orderkey", 89, 6).selectExpr(
        "k", "copy", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
        "CAST(o_orderdate AS DATE) + CAST(8000 + (k * 13) % 3000 AS INT) AS f",
    )
    return rows.selectExpr(
        "k + copy * 100000000 AS source_row_id",
        """CASE WHEN k % 499 = 3 THEN NULL WHEN k % 499 = 4 THEN '  '
              ELSE concat('c-', k) END AS id_cita""",
        """CASE WHEN k % 53 = 1 THEN CAST(o_custkey + 5000000 AS STRING)
              WHEN k % 307 = 2 THEN NULL ELSE CAST(o_custkey AS STRING) END AS id_paciente""",
        f"""CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN {_swapped('f', 'not-a-date')}
              ELSE {_iso('f')} END AS fecha_cita""",
        "CASE WHEN k % 6 = 0 THEN NULL ELSE concat(' ', o_orderpriority, ' ') END AS especialidad",
        "CASE WHEN k % 5 = 0 THEN '' ELSE concat('Dr. ', k % 5) END AS medico",
        """CASE WHEN k % 401 = 0 THEN 'abc' WHEN k % 401 = 1 THEN '-5' WHEN k % 401 = 2 THEN '12d'
              WHEN k % 11 = 0 THEN NULL
              ELSE CAST(CAST(o_totalprice + copy * (k % 2) AS DECIMAL(12,2)) AS STRING) END AS costo""",
        """CASE o_orderstatus WHEN 'F' THEN 'COMPLETADA' WHEN 'O' THEN ' cancelada'
              ELSE CASE WHEN k % 2 = 0 THEN 'Reprogramada' WHEN k % 3 = 0 THEN NULL
                        ELSE 'Pendiente' END END AS estado_cita""",
    )


def parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_keys(raw_parents(spark, sf_dir), PARENT_TABLE)


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_keys(raw_children(spark, sf_dir), CHILD_TABLE)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {PARENT_TABLE: parents(spark, sf_dir), CHILD_TABLE: children(spark, sf_dir)}
