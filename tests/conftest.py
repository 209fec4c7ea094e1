import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from pulcra.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


PATIENT = "source_row_id long, id_paciente long, nombre string, fecha_nacimiento string, edad string, sexo string, email string, telefono string, ciudad string"
VISIT = "source_row_id long, id_cita string, id_paciente long, fecha_cita string, especialidad string, medico string, costo string, estado_cita string"


@pytest.fixture
def patients(spark):
    def make(*rows):
        return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], PATIENT)

    return make


@pytest.fixture
def visits(spark):
    def make(*rows):
        return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], VISIT)

    return make


@pytest.fixture
def evaluate(spark):
    """Values of an expression over texts, in the given order."""

    def run(expression, texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
        rows = df.select("i", expression(F.col("v")).alias("r")).collect()
        return [row["r"] for row in sorted(rows)]

    return run


def rule_ids(issues):
    return sorted(row["rule_id"] for row in issues.collect())
