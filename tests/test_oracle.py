"""Registered queries against their SQL on the given tables, and the plans they run with.

A sample of each family runs here; ``python tests/compare.py <folder>`` compares all of them.
"""

import io
from contextlib import redirect_stdout

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from checks import dirty
from checks.oracle import ORACLE
from checks.queries import QUERIES, SETTINGS
from pulcra.operators import metrics
from pulcra.plans.appointments import appointment_rows, resolve_appointments

SF_DIR = driver.SMOKE_DIR
SAMPLE = [
    "src_key_typing", "fn_parse_date", "fn_email_normalize", "fn_truncate_text", "rule_age_filled",
    "rule_pk_conflict", "clean_parent", "clean_child_rejects", "validate_cross_refs", "join_fk_anti",
    "profile_dataset", "metrics_long", "issues_by_rule", "star_fact",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_same_result(spark, con, name):
    assert difference(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name]) is None


def test_expected_rule_counts(spark):
    counts = {r["rule_id"]: r["count"] for r in driver.entry(spark).collect()}
    assert counts == {
        "R_SEXO_UNRECOGNIZED": 38, "R_FECHA_NAC_INVALID": 24, "R_EDAD_DERIVADA_UNREASONABLE": 6,
        "R_EDAD_PROVIDED_OUT_OF_RANGE": 12, "R_EDAD_FILLED_FROM_DERIVADA": 40,
        "R_EDAD_INCONSISTENT_WITH_DERIVED": 36, "R_EMAIL_INVALID": 50, "R_TELEFONO_INVALID_LENGTH": 43,
        "R_PK_MISSING": 7, "R_DUP_PK_CONFLICT": 16, "R_DUP_PK_EXACT": 11, "R_FECHA_CITA_INVALID": 109,
        "R_FECHA_CITA_FUTURE": 302, "R_ESTADO_CITA_UNRECOGNIZED": 169, "R_COST_NON_NUMERIC": 8,
        "R_COST_NEGATIVE": 4, "R_ORPHAN_CITA": 49,
    }


def plan_of(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_row_rules_do_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "children")
    dirty.children(spark, SF_DIR).write.parquet(path)
    raw = spark.read.parquet(path)
    rows = plan_of(appointment_rows(raw, SETTINGS))
    assert "Exchange" not in rows and "Python" not in rows
    resolved = plan_of(resolve_appointments(raw, SETTINGS))
    assert "BroadcastHashJoin" in resolved and "hashpartitioning" not in resolved


def test_key_metric_reads_the_key_only(spark, tmp_path):
    path = str(tmp_path / "children")
    dirty.children(spark, SF_DIR).write.parquet(path)
    plan = plan_of(metrics.key_measures(spark.read.parquet(path), metrics.CHILD_METRICS))
    assert "ReadSchema: struct<id_cita:string>" in plan
