"""Numeric columns, row ids and single-line documents of the sources."""

import json

import pytest
from pyspark.sql import functions as F

from pulcra.catalogs import PARENT_TABLE
from pulcra.functions import int_text, parse_date
from pulcra.functions.frames import as_text
from pulcra.operators.audit import rule_totals
from pulcra.plans.patients import clean_patients
from pulcra.sources import readers


def test_double_keys_and_phones_keep_their_digits(spark):
    df = spark.createDataFrame([(0, 12345678.0, 3171234567.0), (1, 1.5, 0.5), (2, None, float("inf"))], "source_row_id long, id_paciente double, telefono double")
    typed = [r["id_paciente"] for r in readers.type_keys(df, PARENT_TABLE).orderBy("source_row_id").collect()]
    assert typed == [12345678, None, None]
    assert [r[0] for r in df.orderBy("source_row_id").select(as_text(df, "telefono")).collect()] == ["3171234567", "0.5", "Infinity"]


def test_ages_beyond_bigint_are_out_of_range(spark, patients):
    done = clean_patients(patients((1, "Lea", None, "9" * 20, "Male", None, None, None)))
    found = [(r["rule_id"], r["original_value"]) for r in done.issues.collect() if r["column"] == "edad"]
    assert found == [("R_EDAD_PROVIDED_OUT_OF_RANGE", "9" * 20)]
    assert [r[0] for r in spark.createDataFrame([("5.0",), ("x",), (None,)], "a string").select(int_text(F.col("a"))).collect()] == [True, False, False]


def test_first_rows_do_not_depend_on_dense_ids(spark):
    for ids in (range(1, 50), range(0, 500, 5)):
        df = spark.createDataFrame([(i,) for i in reversed(ids)], "source_row_id long")
        assert sorted(r[0] for r in readers.first_rows(df, 10).collect()) == list(ids)[:10]


def test_given_row_ids_must_be_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "source_row_id long")
    with pytest.raises(ValueError, match="unique"):
        readers.check_row_ids(df, PARENT_TABLE)
    readers.check_row_ids(df.distinct(), PARENT_TABLE)


def test_blanks_inside_dates(evaluate):
    found = evaluate(lambda c: parse_date(c).cast("string"), ["5\u00a0de marzo de\u20032020", "2020\u00a0-\u00a020-03"])
    assert found == ["2020-03-05", "2020-03-20"]


def test_a_folder_is_not_a_document(spark, tmp_path):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text(json.dumps({"pacientes": [], "citas_medicas": []}))
    with pytest.raises(ValueError, match="one file"):
        readers.read_document(spark, str(tmp_path))


def test_places_of_first_issues_are_aggregated_by_hash(spark, patients):
    done = clean_patients(patients((1, "Lea", "x", "999", "Q", "bad", "1", None)))
    plan = rule_totals(done.issues)._jdf.queryExecution().executedPlan().toString()
    assert any("HashAggregate" in line and "min(_place" in line for line in plan.split("\n"))
