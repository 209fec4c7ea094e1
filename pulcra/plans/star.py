"""Star schema: patient, doctor, specialty and date dimensions around the appointment fact."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulcra.catalogs import CHILD_KEY, PARENT_KEY, ROW_ID
from pulcra.config import JoinLimits
from pulcra.functions import date_key, date_key_parts, text_normalize
from pulcra.functions.frames import as_date
from pulcra.operators.keysets import key_words, mark_members, small_set
from pulcra.operators.lookup import lookup_join, materialize, write_observed, write_sized
from pulcra.operators.numbering import number_rows

UNKNOWN = "UNKNOWN"
MANIFEST = "CURRENT"
KEYS = {
    "dim_paciente": "paciente_key",
    "dim_medico": "medico_key",
    "dim_especialidad": "especialidad_key",
    "dim_fecha": "fecha_key",
}
UNIQUE = {
    "dim_paciente": [["paciente_key"], ["id_paciente"]],
    "dim_medico": [["medico_key"], ["medico_nombre"]],
    "dim_especialidad": [["especialidad_key"], ["especialidad_nombre"]],
    "dim_fecha": [["fecha_key"]],
    "fact_citas": [[CHILD_KEY]],
}


class Star(NamedTuple):
    dim_paciente: DataFrame
    dim_medico: DataFrame
    dim_especialidad: DataFrame
    dim_fecha: DataFrame
    fact_citas: DataFrame


def patient_dim(parents: DataFrame) -> DataFrame:
    return parents.select(
        F.col(PARENT_KEY).alias("paciente_key"), PARENT_KEY, "nombre", "sexo", "ciudad"
    )


class Members(NamedTuple):
    """``column, key, name, n``: names of several columns with their surrogate keys and usage, and
    what it takes to broadcast them."""

    names: DataFrame
    size: int

    def of(self, column: str) -> DataFrame:
        return self.names.where(F.col("column") == column).drop("column")


def catalog_members(children: DataFrame, *columns: str, limits: JoinLimits = JoinLimits()) -> Members:
    """The known names of each column, numbered from 1 in code-point order.

    One look at the children, whose names are counted and written. Names that may be broadcast are
    numbered in a window per column, more of them by a distributed sort.
    """
    pairs = [F.struct(F.lit(c).alias("column"), text_normalize(F.col(c)).alias("name")) for c in columns]
    named = children.select(F.inline(F.array(*pairs)))
    known = named.where(F.col("name").isNotNull() & (F.col("name") != UNKNOWN))
    names, size = write_sized(known.groupBy("column", "name").agg(F.count(F.lit(1)).alias("n")))
    if size <= limits.broadcast_bytes:
        key = F.row_number().over(Window.partitionBy("column").orderBy("name"))
        return Members(names.select("column", key.alias("key"), "name", "n"), size)
    numbered = number_rows(names, ["column", "name"], "_number")
    first = F.broadcast(numbered.groupBy("column").agg(F.min("_number").alias("_first")))  # a row per column
    key = (F.col("_number") - F.col("_first") + 1).cast("int")
    numbered = numbered.join(first, "column").select("column", key.alias("key"), "name", "n")
    return Members(materialize(numbered), size)


def catalog_dim(members: DataFrame, key: str, name: str) -> DataFrame:
    unknown = members.sparkSession.range(1).select(
        F.lit(0).alias("key"), F.lit(UNKNOWN).alias("name")
    )
    return unknown.unionByName(members.select("key", "name")).select(
        F.col("key").alias(key), F.col("name").alias(name)
    )


def date_dim(children: DataFrame) -> DataFrame:
    keys = (
        children.select(date_key(as_date(children, "fecha_cita")).alias("fecha_key"))
        .where("fecha_key <> 0")
        .distinct()
    )
    known = keys.select("fecha_key", *[c.alias(n) for n, c in date_key_parts(F.col("fecha_key")).items()])
    null = F.lit(None).cast("int")
    unknown = children.sparkSession.range(1).select(
        F.lit(0).alias("fecha_key"),
        F.lit(UNKNOWN).alias("fecha_date"),
        *[null.alias(c) for c in ("ano", "mes", "dia")],
    )
    return unknown.unionByName(known)


def with_catalog_key(
    children: DataFrame, column: str, members: Members, key: str, limits: JoinLimits
) -> DataFrame:
    """Add the surrogate key of a name, 0 where it is null or not a member."""
    found = lookup_join(
        children,
        members.of(column).select("name", F.col("key").alias("_found"), "n"),
        key=text_normalize(F.col(column)),
        lookup_key="name",
        weight="n",
        row_id=F.col(ROW_ID) if ROW_ID in children.columns else F.col(CHILD_KEY),
        limits=limits,
        size=members.size,
    )
    return found.withColumn(key, F.coalesce("_found", F.lit(0))).drop("_found")


def appointment_fact(children: DataFrame, members: Members, limits: JoinLimits = JoinLimits()) -> DataFrame:
    rows = children.withColumn("fecha_key", date_key(as_date(children, "fecha_cita")))
    rows = with_catalog_key(rows, "medico", members, "medico_key", limits)
    rows = with_catalog_key(rows, "especialidad", members, "especialidad_key", limits)
    return rows.select(
        CHILD_KEY,
        "fecha_key",
        F.col(PARENT_KEY).alias("paciente_key"),
        "medico_key",
        "especialidad_key",
        F.col("costo").cast("double"),
        "estado_cita",
    )


def build_star(parents: DataFrame, children: DataFrame, limits: JoinLimits = JoinLimits()) -> Star:
    members = catalog_members(children, "medico", "especialidad", limits=limits)
    return Star(
        dim_paciente=patient_dim(parents),
        dim_medico=catalog_dim(members.of("medico"), "medico_key", "medico_nombre"),
        dim_especialidad=catalog_dim(members.of("especialidad"), "especialidad_key", "especialidad_nombre"),
        dim_fecha=date_dim(children),
        fact_citas=appointment_fact(children, members, limits),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def row_counts(star: Star) -> DataFrame:
    """``table, row_count``."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
            for name, df in star._asdict().items()
        ]
    )


def unmatched_facts(star: Star) -> DataFrame:
    """``dimension, orphan_rows``: facts whose key the dimension lacks.

    Facts are counted per key first, so the join sees one row per key on both sides.
    """
    parts = []
    for name, key in KEYS.items():
        used = star.fact_citas.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = used.join(getattr(star, name).select(key), key, "left_anti")
        parts.append(
            lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")).select(
                F.lit(name).alias("dimension"), "orphan_rows"
            )
        )
    return _union(parts)


def repeated_keys(star: Star) -> DataFrame:
    """``table, columns, duplicate_rows`` for every primary or unique key."""
    parts = []
    for name, keys in UNIQUE.items():
        for columns in keys:
            groups = getattr(star, name).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
            parts.append(
                groups.agg(
                    F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows")
                ).select(
                    F.lit(name).alias("table"),
                    F.lit(",".join(columns)).alias("columns"),
                    "duplicate_rows",
                )
            )
    return _union(parts)


class BrokenStar(ValueError):
    """A star schema that does not keep its keys."""


def publish_star(
    spark: SparkSession, star: Star, folder: str, limits: JoinLimits = JoinLimits()
) -> tuple[Star, dict[str, int]]:
    """Load a star into ``folder`` if its keys hold; the star as loaded and its rows per table.

    The tables go to a folder of their own below ``versions``. Rows, missing keys and facts without
    a dimension row are counted while they are written, repeated keys in the tables as written. Only
    then ``CURRENT`` is made to name that folder, in one step, so a reader sees the old star or the
    new one. A star with broken keys raises :class:`BrokenStar` and leaves ``CURRENT`` as it was.
    Earlier versions stay; readers that have them open can go on.
    """
    version = f"versions/{uuid.uuid4().hex}"
    loaded, rows, broken, known = {}, {}, [], {}

    def load(name: str, df: DataFrame, lost: Mapping[str, Column]) -> dict[str, int]:
        key = UNIQUE[name][0][0]
        measures = {"rows": F.count(F.lit(1)), "missing": F.count(F.when(F.col(key).isNull(), 1)), **lost}
        path, marks = f"{folder}/{version}/{name}", [f"_in_{dimension}" for dimension in lost]
        loaded[name], seen = write_observed(df, measures, path=path, drop=marks)
        rows[name] = seen["rows"]
        if seen["missing"]:
            broken.append(f"{seen['missing']} rows of {name} without {key}")
        return seen

    for name, key in KEYS.items():
        load(name, getattr(star, name), {})
        known[name] = small_set(key_words(loaded[name], key), limits)
    facts = star.fact_citas
    for name, key in KEYS.items():
        if known[name] is not None:
            facts = mark_members(facts, key, known[name], f"_in_{name}")
    lost = {name: F.count(F.when(~F.col(f"_in_{name}"), 1)) for name in KEYS if known[name] is not None}
    seen = load("fact_citas", facts, lost)
    written = Star(**loaded)
    orphans = {name: seen[name] for name in lost}
    if len(lost) < len(KEYS):
        orphans |= {r["dimension"]: r["orphan_rows"] for r in unmatched_facts(written).collect()}
    again = repeated_keys(written).where("duplicate_rows > 0").collect()
    broken += [f"{n} facts without a row of {name}" for name, n in orphans.items() if n]
    broken += [f"{r['duplicate_rows']} repeated {r['columns']} in {r['table']}" for r in again]
    if broken:
        raise BrokenStar("; ".join(broken))
    _swap_text(spark, f"{folder}/{MANIFEST}", version)
    return written, rows


def read_star(spark: SparkSession, folder: str) -> Star:
    """The star that was published last."""
    version = spark.read.text(f"{folder}/{MANIFEST}").first()[0]
    return Star(*[spark.read.parquet(f"{folder}/{version}/{name}") for name in Star._fields])


def _swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a one-line file in one step, on any file system Spark can write to."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = draft.getFileSystem(conf).create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, target, overwrite)
