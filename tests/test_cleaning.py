import pytest
from conftest import rule_ids
from pyspark.sql import functions as F

from pulcra import Settings
from pulcra.plans.appointments import appointment_rows, clean_appointments
from pulcra.plans.patients import clean_patients, patient_rows


def test_sample_patients(patients):
    df = patients(
        (1, "Ines", "1984-07-19", None, "Female", "no at sign", "55", "Tunja"),
        (2, "Pavel", "31/31", "42", "Q", "p.r@mail.org", "6015550142", "Leticia"),
        (3, "Noor", "1950-12-02", "20", "Male", "noor@x.co", "601-555-0199", "Mocoa"),
    )
    done = clean_patients(df)
    rows = {r["id_paciente"]: r for r in done.clean.collect()}
    assert done.rejected.count() == 0 and len(rows) == 3
    assert (rows[1]["email"], rows[1]["telefono"], rows[1]["edad"]) == (None, None, 41)
    assert (rows[2]["edad"], rows[2]["sexo"], rows[2]["fecha_nacimiento"]) == (42, None, None)
    assert (rows[3]["edad"], rows[3]["edad_inconsistente"], rows[3]["telefono"]) == (75, True, "6015550199")
    issues = {(r["row_id"], r["rule_id"]): r for r in done.issues.collect()}
    assert set(issues) == {
        ("0", "R_EDAD_FILLED_FROM_DERIVADA"),
        ("0", "R_EMAIL_INVALID"),
        ("0", "R_TELEFONO_INVALID_LENGTH"),
        ("1", "R_FECHA_NAC_INVALID"),
        ("1", "R_SEXO_UNRECOGNIZED"),
        ("2", "R_EDAD_INCONSISTENT_WITH_DERIVED"),
    }
    filled = issues[("0", "R_EDAD_FILLED_FROM_DERIVADA")]
    assert filled["original_value"] == "NULL (nació: 1984-07-19)" and filled["clean_value"] == "41"
    assert filled["detail"] == "Se completó edad usando edad derivada (tolerancia=±2)."


@pytest.mark.parametrize(
    "birth, age, rules, final",
    [
        ("2130-01-01", "30", ["R_EDAD_DERIVADA_UNREASONABLE"], 30),
        (None, "200", ["R_EDAD_PROVIDED_OUT_OF_RANGE"], None),
        ("2000-01-01", "200", ["R_EDAD_FILLED_FROM_DERIVADA", "R_EDAD_PROVIDED_OUT_OF_RANGE"], 26),
        ("2000-01-01", "abc", ["R_EDAD_FILLED_FROM_DERIVADA"], 26),
        (None, "abc", [], None),
        ("2000-01-01", "28", [], 28),
        ("2000-01-01", "29", ["R_EDAD_INCONSISTENT_WITH_DERIVED"], 26),
    ],
)
def test_age_chain(patients, birth, age, rules, final):
    done = clean_patients(patients((1, "A", birth, age, "M", None, None, None)))
    assert rule_ids(done.issues) == rules
    assert done.clean.first()["edad"] == final


def test_patient_keys(patients):
    same = (7, "A", "2000-01-01", "26", "M", None, None, "X")
    df = patients(
        same,
        same,
        (8, "B", None, None, "M", None, None, None),
        (8, "B", None, None, "Male", None, None, None),
        (None, "C", None, None, "X", None, None, None),
        (9, "D", None, None, None, None, None, None),
        (10, "E", None, None, "", None, None, None),
        (10, "E", None, None, None, None, None, None),
    )
    done = clean_patients(df)
    assert sorted(r["source_row_id"] for r in done.clean.collect()) == [0, 5, 6]
    rejected = {r["source_row_id"]: r["rejection_rule_id"] for r in done.rejected.collect()}
    assert rejected == {2: "R_DUP_PK_CONFLICT", 3: "R_DUP_PK_CONFLICT", 4: "R_PK_MISSING"}
    assert rule_ids(done.issues) == [
        "R_DUP_PK_CONFLICT", "R_DUP_PK_CONFLICT", "R_DUP_PK_EXACT", "R_DUP_PK_EXACT",
        "R_PK_MISSING", "R_SEXO_UNRECOGNIZED", "R_SEXO_UNRECOGNIZED",
    ]


def test_empty_and_absent_columns(patients, visits):
    for done in (clean_patients(patients((1,) + (None,) * 7).limit(0)), clean_appointments(visits((None,) * 7).limit(0))):
        assert [df.count() for df in done] == [0, 0, 0]
    bare = patients((1, "A", None, None, "M", "a@a.com", "1234567890", None)).drop("sexo", "email", "telefono", "edad")
    done = clean_patients(bare)
    row = done.clean.first()
    assert (row["sexo"], row["email"], row["telefono"], row["edad"]) == (None,) * 4
    issue = done.issues.collect()
    assert [(i["rule_id"], i["row_id"], i["severity"]) for i in issue] == [("R_SEXO_MISSING", "TABLE", "error")]
    done = clean_appointments(visits(("a", 1, "2020-01-01", None, None, "5", "X")).drop("costo", "estado_cita"))
    assert done.clean.first()["costo"] is None and done.issues.count() == 0
    with pytest.raises(ValueError):
        clean_patients(bare.drop("id_paciente"))
    with pytest.raises(ValueError):
        clean_appointments(visits(("a", 1, None, None, None, None, None)).drop("id_cita"))


def test_appointments(visits):
    df = visits(
        ("a", 1, "2022-02-14", " Card ", "", "100", "completada"),
        ("b", 1, "2027-01-01", None, "Dr. X", "-5", "Cancelada"),
        ("c", 1, "bad", " E ", " M ", "abc", "Pendiente"),
        (None, 1, "bad", None, None, "-1", "Pendiente"),
        ("  ", 1, "2022-14-02", None, None, None, None),
        ("d", 1, "2027-01-01", None, None, None, "Pendiente"),
        ("e", 1, "2022-02-14", " E", None, "1", None),
        ("e", 1, "2022-02-14", "E ", None, "1", None),
        ("f", 1, None, None, None, "1", None),
        ("f", 1, None, None, None, "2", None),
        ("f", 1, None, None, None, "abc", None),
    )
    done = clean_appointments(df)
    clean = {r["source_row_id"]: r for r in done.clean.collect()}
    assert set(clean) == {0, 5, 6}
    assert (clean[0]["especialidad"], clean[0]["medico"], clean[0]["costo"], clean[0]["estado_cita"]) == ("Card", None, 100.0, "Completada")
    rejected = {r["source_row_id"]: r for r in done.rejected.collect()}
    assert {i: r["rejection_rule_id"] for i, r in rejected.items()} == {
        1: "R_COST_NEGATIVE", 2: "R_COST_NON_NUMERIC", 3: "R_PK_MISSING", 4: "R_PK_MISSING",
        8: "R_DUP_PK_CONFLICT", 9: "R_DUP_PK_CONFLICT", 10: "R_COST_NON_NUMERIC",
    }
    assert (rejected[3]["fecha_cita"], rejected[3]["fecha_cita_original"]) == ("bad", None)
    assert (rejected[2]["fecha_cita"], rejected[2]["fecha_cita_original"], rejected[2]["medico"]) == (None, "bad", " M ")
    assert rejected[1]["costo"] == "-5" and rejected[1]["rejection_reason"] == "Costo negativo (valor inválido)"
    by_row = {}
    for i in done.issues.collect():
        by_row.setdefault(i["row_id"], set()).add(i["rule_id"])
    assert by_row == {
        "1": {"R_FECHA_CITA_FUTURE", "R_COST_NEGATIVE"},
        "2": {"R_FECHA_CITA_INVALID", "R_ESTADO_CITA_UNRECOGNIZED", "R_COST_NON_NUMERIC"},
        "3": {"R_PK_MISSING"},
        "4": {"R_PK_MISSING"},
        "5": {"R_FECHA_CITA_FUTURE", "R_ESTADO_CITA_UNRECOGNIZED"},
        "7": {"R_DUP_PK_EXACT"},
        "8": {"R_DUP_PK_CONFLICT"},
        "9": {"R_DUP_PK_CONFLICT"},
        "10": {"R_COST_NON_NUMERIC"},
    }


def test_cleaning_again_changes_nothing(patients):
    df = patients(
        (1, "Nora", "7 ago 1984", "11", "male", " Nora@Correo.ORG ", "605-555-0102", "Tunja"),
        (2, "B", "1850-01-01", "200", "X", "bad", "1", None),
    )
    once = clean_patients(df).clean
    again = clean_patients(once.select(df.columns))
    assert once.select(df.columns).exceptAll(again.clean.select(df.columns)).count() == 0
    assert rule_ids(again.issues) == ["R_EDAD_DERIVADA_UNREASONABLE"]


def test_rows_of_a_stream(spark, patients, visits, tmp_path):
    patients((1, "A", "bad", "10", "x", None, None, None)).write.parquet(str(tmp_path / "p"))
    visits(("a", 1, "bad", None, None, "x", None)).write.parquet(str(tmp_path / "v"))
    for name, build in (("p", patient_rows), ("v", appointment_rows)):
        path = str(tmp_path / name)
        stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        counted = build(stream, Settings()).select(F.size(F.array_compact("_issues")).alias("n"))
        query = counted.writeStream.format("memory").queryName(f"rows_{name}").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        assert [r["n"] for r in spark.table(f"rows_{name}").collect()] == [2]
