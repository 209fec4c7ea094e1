"""Session settings the plans gain from."""

from __future__ import annotations

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Let Spark split generated code that the JVM would otherwise interpret.

    HotSpot never compiles methods above 8000 bytes of bytecode. A projection with all rules of a
    table can exceed that, and Spark's default limit lets it; with this limit such a projection is
    split into small methods instead. Every other setting is left to the cluster.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark
