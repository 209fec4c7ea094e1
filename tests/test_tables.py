"""Integrity checks, profile, metrics, star schema, sources and the whole run."""

import io
import json
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from pulcra import Settings
from pulcra.catalogs import CHILD_EXPORT_COLUMNS, CHILD_TABLE, PARENT_EXPORT_COLUMNS, PARENT_TABLE
from pulcra.config import JoinLimits
from pulcra.operators import audit, integrity, metrics, profile
from pulcra.operators.rules import ISSUE_COLUMNS
from pulcra.plans.appointments import clean_appointments
from pulcra.plans.patients import clean_patients
from pulcra.plans.run import clean_tables, run
from pulcra.plans.star import BrokenStar, build_star, publish_star, read_star, repeated_keys, row_counts, unmatched_facts
from pulcra.sources import document as document_source
from pulcra.sources import readers

GOOD = (1, "Ruth", "1991-05-06", None, "Male", "ruth@mail.org", "6015550100", "Pasto")


def visit(key, parent, day="2023-06-08", doctor="Dra. Vega", cost="80", state="Completada", kind="Cardiología"):
    return (key, parent, day, kind, doctor, cost, state)


def as_dict(df, *names):
    return {tuple(r[n] for n in names[:-1]): r[names[-1]] for r in df.collect()}


def test_cross_references(patients, visits):
    parents = clean_patients(patients(GOOD)).clean
    children = clean_appointments(visits(visit("a", 1), visit("b", 999), visit("c", None))).clean
    checked = integrity.validate_cross_references(parents, children)
    assert [r["id_cita"] for r in checked.valid.collect()] == ["a"]
    assert sorted(r["id_cita"] for r in checked.rejected.collect()) == ["b", "c"]
    assert [r["original_value"] for r in checked.issues.orderBy("row_id").collect()] == ["999", None]


def test_leftovers(patients, visits):
    parents = clean_patients(patients(GOOD)).clean
    raw = visits(visit("a", 1, state="Rara"), visit("a", 1))
    checked = integrity.validate_cross_references(parents, raw)
    found = {(r["rule_id"], r["row_id"]) for r in checked.issues.collect()}
    assert found == {("R_ESTADO_CITA_INVALID_REMAINING", "0"), ("R_DUP_PK_AFTER_CROSS_VALIDATION", "TABLE")}


def test_profile(patients, visits):
    df = patients(GOOD, (2, None, "2023-19-01", None, None, None, None, None))
    found = as_dict(profile.profile_table(df, profile.PARENT_PROFILE), "section", "item", "value")
    assert found[("row_count", "rows")] == 2
    assert [found[("missing_counts", c)] for c in ("email", "telefono", "sexo")] == [1, 1, 1]
    assert found[("format_anomalies", "sexo_invalid")] == 0
    assert found[("format_anomalies", "fecha_nacimiento_invalid_raw")] == 1
    assert found[("format_anomalies", "fecha_nacimiento_recovered_by_swap")] == 1
    document = profile.profile_document(df, profile.PARENT_PROFILE).first().asDict(recursive=True)
    assert document["missing_counts"]["email"] == 1
    assert document["categorical_cardinality"]["sexo"] == {"unique_count": 1, "top": [{"value": "Male", "count": 1}]}
    none = profile.profile_table(df.limit(0), profile.PARENT_PROFILE)
    assert {r["value"] for r in none.collect()} == {0}
    bare = profile.profile_table(df.select("source_row_id", "nombre"), profile.PARENT_PROFILE)
    assert as_dict(bare, "section", "item", "value")[("missing_counts", "nombre")] == 1


def test_metrics(patients, visits):
    before = {PARENT_TABLE: patients(GOOD), CHILD_TABLE: visits(visit("a", 1), visit("b", 999))}
    after = {PARENT_TABLE: clean_patients(before[PARENT_TABLE]).clean, CHILD_TABLE: visits(visit("a", 1))}
    compared = metrics.compare_metrics(before, after).collect()
    assert len(compared) == 33
    by_name = {(r["metric_name"], r["column"]): r for r in compared}
    fk = by_name[(metrics.GLOBAL_FK, None)]
    assert (fk["before"], fk["after"], fk["delta"]) == (0.5, 1.0, 0.5)
    assert by_name[(metrics.GLOBAL_COMPLETENESS, None)]["delta"] > 0
    assert by_name[("edad_consistency_pct", None)]["before"] is None
    assert by_name[("edad_consistency_pair_count", None)]["after"] == 1.0
    empty = {name: df.limit(0) for name, df in before.items()}
    values = as_dict(metrics.quality_metrics(empty), "metric_name", "column", "table", "metric_value")
    assert values[("pk_uniqueness_pct", None, PARENT_TABLE)] is None
    assert values[("completeness_pct", "email", PARENT_TABLE)] == 0.0
    assert values[("fk_non_null_count", None, CHILD_TABLE)] == 0.0
    without = {PARENT_TABLE: patients(GOOD).drop("id_paciente"), CHILD_TABLE: visits(visit("a", 1)).drop("id_paciente")}
    values = as_dict(metrics.quality_metrics(without), "metric_name", "column", "table", "metric_value")
    assert values[("pk_uniqueness_pct", None, PARENT_TABLE)] is None
    assert values[("fk_valid_pct_among_non_null", None, CHILD_TABLE)] is None


def test_issue_roll_ups(spark):
    rows = [("citas_medicas", str(i), "R_X", s, "c", None, None, "d") for i, s in enumerate(("info", "warning", "error"))]
    issues = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in ISSUE_COLUMNS))
    assert tuple(audit.issues_by_rule(issues).first()) == ("R_X", 3, "error")
    assert tuple(audit.rule_impact(audit.rule_totals(issues)).first())[4:] == ("Evento de auditoría", "error", 3)


def test_star(patients, visits):
    parents = clean_patients(patients(GOOD, (2, *GOOD[1:]))).clean
    rows = [visit("a", 1), visit("b", 2, doctor="Dr. A"), visit("c", 2, day=None, doctor=None, kind=None), visit("d", 1, doctor="UNKNOWN")]
    star = build_star(parents, clean_appointments(visits(*rows)).clean)
    assert as_dict(row_counts(star), "table", "row_count") == {
        ("dim_paciente",): 2, ("dim_medico",): 3, ("dim_especialidad",): 2, ("dim_fecha",): 2, ("fact_citas",): 4,
    }
    assert as_dict(star.dim_medico, "medico_nombre", "medico_key") == {("UNKNOWN",): 0, ("Dr. A",): 1, ("Dra. Vega",): 2}
    facts = {r["id_cita"]: r for r in star.fact_citas.collect()}
    assert [facts["c"][k] for k in ("fecha_key", "medico_key", "especialidad_key")] == [0, 0, 0]
    assert (facts["a"]["fecha_key"], facts["a"]["medico_key"], facts["d"]["medico_key"]) == (20230608, 2, 0)
    assert {r["orphan_rows"] for r in unmatched_facts(star).collect()} == {0}
    assert {r["duplicate_rows"] for r in repeated_keys(star).collect()} == {0}


def test_broken_star_is_refused(spark, patients, visits, tmp_path):
    """A star with broken keys leaves the published one in place; earlier versions stay readable."""
    folder = str(tmp_path / "star")
    parents = clean_patients(patients(GOOD, (2, *GOOD[1:]))).clean
    children = clean_appointments(visits(visit("a", 1), visit("b", 2, doctor="Dr. A"))).clean
    star = build_star(parents, children)
    first, rows = publish_star(spark, star, folder)
    assert rows == {"dim_paciente": 2, "dim_medico": 3, "dim_especialidad": 2, "dim_fecha": 2, "fact_citas": 2}
    orphan = star.fact_citas.withColumn("medico_key", F.lit(99))
    broken = {
        "2 facts without a row of dim_medico": {"fact_citas": orphan},
        "2 facts without a row of dim_paciente": {"fact_citas": star.fact_citas.withColumn("paciente_key", F.lit(None).cast("long"))},
        "1 repeated id_cita in fact_citas": {"fact_citas": star.fact_citas.withColumn("id_cita", F.lit("a"))},
        "1 repeated medico_nombre in dim_medico": {"dim_medico": star.dim_medico.withColumn("medico_nombre", F.when(F.col("medico_key") > 0, "x"))},
        "2 rows of fact_citas without id_cita": {"fact_citas": star.fact_citas.withColumn("id_cita", F.lit(None).cast("string"))},
    }
    for message, change in broken.items():
        with pytest.raises(BrokenStar, match=message):
            publish_star(spark, star._replace(**change), folder)
        assert sorted(r["id_cita"] for r in read_star(spark, folder).fact_citas.collect()) == ["a", "b"]
    more = clean_appointments(visits(visit("a", 1), visit("b", 2), visit("c", 2))).clean
    publish_star(spark, build_star(parents, more), folder)
    assert read_star(spark, folder).fact_citas.count() == 3 and first.fact_citas.count() == 2


def test_run_totals_match_the_trail(spark, patients, visits):
    """What a run counts while it writes equals the roll-ups of its audit trail."""
    rows = [GOOD, GOOD, (2, None, "bad", "200", "X", "bad", "1", None), (2, "other", "bad", "abc", "X", "b", "1", None), (None, "n", None, None, None, None, None, None)]
    kids = [visit("a", 1), visit("a", 1), visit("b", 999, state="Rara"), visit("c", None, cost="-1"), visit("d", 1, day="2040-01-01"), visit(None, 1), visit("e", 1, cost="x"), visit("f", 1), visit("f", 1, kind="Otra")]
    for parents, children in (
        (patients(*rows), visits(*kids)), (patients(*rows).drop("sexo"), visits(*kids).drop("estado_cita")),
        (patients(*rows).limit(0), visits(*kids)), (patients(*rows).limit(0), visits(*kids).limit(0)),
    ):
        done = clean_tables({PARENT_TABLE: parents, CHILD_TABLE: children})
        key = lambda df: sorted(map(str, df.collect()))
        assert key(audit.issues_by_rule(done.totals)) == key(audit.issues_by_rule(done.issues))
        assert key(audit.issues_by_severity(done.totals)) == key(audit.issues_by_severity(done.issues))
        assert key(audit.rule_totals(done.totals)) == key(audit.rule_totals(done.issues))
        assert done.after == {PARENT_TABLE: done.parents.count(), CHILD_TABLE: done.children.count()}
        assert done.rejected == {PARENT_TABLE: done.parents_rejected.count(), CHILD_TABLE: done.children_rejected.count()}
        assert done.before == {PARENT_TABLE: parents.count(), CHILD_TABLE: children.count()}


def test_cross_check_reads_verdict_folders(spark, patients, visits):
    parents = clean_patients(patients(GOOD)).clean
    checked = integrity.validate_cross_references(parents, clean_appointments(visits(visit("a", 1), visit("b", 9), visit("c", 8))).clean)
    assert (checked.seen["valid"], checked.seen["orphans"], checked.seen["repeated_key"]) == (1, 2, 0)
    for df, verdict in ((checked.valid, "valid"), (checked.rejected, "orphan")):
        text = io.StringIO()
        with redirect_stdout(text):
            df.explain("formatted")
        assert text.getvalue().count("Scan parquet") == 2 and "PartitionFilters" in text.getvalue() and verdict in text.getvalue()
        assert "_verdict" not in df.columns


ODD = [("a", 1, None), ("a", 1, None), ("a", None, "1"), (None, 1, "a"), (None, None, None), (None, None, None), ("b", 2, ""), ("b", 2, None)]


@pytest.mark.parametrize("limits", [JoinLimits(), JoinLimits(broadcast_bytes=0, hot_rows=2)], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("strong", [True, False], ids=["fingerprints", "colliding fingerprints"])
def test_repeated_wide_rows(spark, limits, strong):
    rows = [*ODD * 3, *[("hot", 7, "x")] * 50, *[(str(i), i, None) for i in range(40)]]
    df = spark.createDataFrame(rows, "a string, b long, c string")
    weak = lambda columns: (F.pmod(F.xxhash64(*columns), F.lit(3)), F.lit(0))
    with_print = {} if strong else {"fingerprint": weak}
    found = profile.repeated_wide_rows(df, df.columns, "n", limits=limits, **with_print)
    assert found.first()["n"] == len(rows) - len(set(rows))
    assert profile.repeated_wide_rows(df.limit(0), df.columns, "n", limits=limits, **with_print).first()["n"] == 0
    unique = spark.range(30).selectExpr("id AS a", "CAST(NULL AS STRING) AS b")
    assert profile.repeated_wide_rows(unique, unique.columns, "n", limits=limits).first()["n"] == 0


def test_key_pass_equals_separate_passes(spark):
    parents = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,)], "id_paciente long")
    children = spark.createDataFrame([("x", 1), ("x", 1), ("y", 9), (None, None), (None, 3), ("z", None)], "id_cita string, id_paciente long")
    for p, c in ((parents, children), (parents.limit(0), children), (parents, children.limit(0))):
        one = metrics.key_pass(p, c)
        met = metrics.key_pass(p, c, JoinLimits(broadcast_bytes=-1))
        assert sorted(map(str, one.collect())) == sorted(map(str, met.collect()))
        three = [metrics.key_measures(p, metrics.PARENT_METRICS), metrics.key_measures(c, metrics.CHILD_METRICS), metrics.foreign_key_measures(c, p)]
        assert sorted(map(str, one.collect())) == sorted(map(str, three[0].unionByName(three[1]).unionByName(three[2]).collect()))
    counts = {r["table"]: (r["unique_pk_count"], r["duplicate_pk_rows"]) for r in metrics.key_counts(metrics.key_pass(parents, children)).collect()}
    assert counts == {PARENT_TABLE: (3, 2), CHILD_TABLE: (3, 2)}


def test_states_add_up(spark, patients, visits):
    """States of two halves of a dataset, added up, are the states of the whole."""
    parents, children = patients(GOOD, (2, *GOOD[1:]), (3, None, None, "x", None, None, None, None)), visits(visit("a", 1), visit("b", 3, cost="-1"))
    whole = metrics.dataset_measures({PARENT_TABLE: parents, CHILD_TABLE: children}, Settings())
    halves = [
        metrics.column_measures(parents.where(f"source_row_id % 2 = {k}"), metrics.PARENT_METRICS, Settings()) for k in (0, 1)
    ]
    filled = {(r["table"], r["column"]): r["non_null_count"] for r in metrics.completeness_counts(whole).collect()}
    added = {(r["table"], r["column"]): r["non_null_count"] for r in metrics.completeness_counts(halves[0].unionByName(halves[1])).collect()}
    assert added == {k: n for k, n in filled.items() if k[0] == PARENT_TABLE} and filled[PARENT_TABLE, "email"] == 2


def document(tmp_path, content, name="in.json"):
    path = tmp_path / name
    path.write_text(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False, indent=1))
    return str(path)


SAMPLE = {
    "pacientes": [
        {"id_paciente": i, "nombre": "A", "fecha_nacimiento": "2000-01-01", "edad": 26.0 if i else None, "sexo": "Male",
         "email": "a@a.com", "telefono": 1234567890, "ciudad": "Bogotá"}
        for i in range(5)
    ],
    "citas_medicas": [
        {"id_cita": f" u-{i} ", "id_paciente": i, "fecha_cita": "2022-02-14", "especialidad": "Cardiología",
         "medico": "Dra. Ruiz", "costo": 73.25, "estado_cita": "Completada"}
        for i in range(6)
    ],
}


def test_document_source(spark, tmp_path):
    path = document(tmp_path, SAMPLE)
    tables = readers.read_document(spark, path)
    parents = tables[PARENT_TABLE].orderBy("source_row_id").collect()
    assert [r["source_row_id"] for r in parents] == [0, 1, 2, 3, 4]
    assert (parents[1]["id_paciente"], parents[1]["edad"], parents[1]["telefono"]) == (1, "26.0", "1234567890")
    assert tables[CHILD_TABLE].orderBy("source_row_id").first()["id_cita"] == "u-0"
    limited = readers.read_document(spark, path, limit=2)
    assert [df.count() for df in limited.values()] == [2, 2]


@pytest.mark.parametrize(
    "content",
    [
        "[1, 2]",
        {"pacientes": SAMPLE["pacientes"]},
        {**SAMPLE, "citas_medicas": {"a": 1}},
        {**SAMPLE, "pacientes": [{"id_paciente": 1}]},
        {**SAMPLE, "pacientes": []},
    ],
)
def test_document_contract(spark, tmp_path, content):
    with pytest.raises(ValueError):
        readers.read_document(spark, document(tmp_path, content))


ODD_TEXTS = ["}", "{", "]", "[", '"', "\\", '\\"}', "a}{b", "},{", '": [', "}]}", "x\ny", "é字😀", "", "\ttab", '\\\\"']


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("blanks", ["", "\ufeff", " \n" * 3000])
def test_document_is_split(spark, tmp_path, indent, blanks):
    """Texts full of brackets and quotes, nested rows, other keys: the rows that a JSON parser sees,
    read in many pieces."""
    texts = [a + b for a in ODD_TEXTS for b in ODD_TEXTS]
    parents = [{**SAMPLE["pacientes"][0], "id_paciente": i, "nombre": t, "more": {"x": {"y": t}, "z": [{"q": t}, {}]}} for i, t in enumerate(texts)]
    children = [{**SAMPLE["citas_medicas"][0], "id_cita": f"k{i}", "medico": t} for i, t in enumerate(texts)]
    whole = {"version": 3, 'no"te': "a [ { b", "meta": {"a": {"b": 1}, "pacientes": "no"}, "none": [], "flat": [1, "}", [2, 3]], "pacientes": parents, "other": [{"a": [{}]}], "citas_medicas": children, "end": None}
    path = tmp_path / "in.json"
    path.write_text(blanks + json.dumps(whole, ensure_ascii=False, indent=indent) + "\n" * (indent or 0), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert document_source.fragments(spark, str(path)).select("_block").distinct().count() > 10
        tables = readers.read_document(spark, str(path))
        found = {name: df.orderBy("source_row_id").collect() for name, df in tables.items()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r["source_row_id"], r["id_paciente"], r["nombre"], r["more"]["x"]["y"], r["more"]["z"][0]["q"]) for r in found[PARENT_TABLE]] == [(i, i, t, t, t) for i, t in enumerate(texts)]
    assert [(r["source_row_id"], r["medico"]) for r in found[CHILD_TABLE]] == list(enumerate(texts))


@pytest.mark.parametrize("content", ['{"pacientes": [{"a": 1}', '{"a": 1}}', '{"a": 1} {"b": 2}', "", "  ", '{"pacientes": [1, {"a": 1}], "citas_medicas": [{"a": 1}]}', '{"pacientes": [{"a": 1} {"a": 2}], "citas_medicas": [{"a": 1}]}'])
def test_broken_documents(spark, tmp_path, content):
    with pytest.raises(ValueError):
        readers.read_document(spark, document(tmp_path, content))


def test_parquet_rows_keep_their_place(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 4).withColumnRenamed("id", "v").write.parquet(path)
    rows = readers.number_parquet_rows(spark, path).collect()
    assert sorted(r["source_row_id"] for r in rows) == list(range(1000))
    assert all(r["source_row_id"] == r["v"] for r in rows)


def test_whole_run(spark, tmp_path):
    sample = json.loads(json.dumps(SAMPLE))
    sample["citas_medicas"][0]["costo"] = -1
    path, out = document(tmp_path, sample), str(tmp_path / "out")
    first = sorted(map(tuple, run(readers.read_document(spark, path), out, Settings()).collect()))
    second = sorted(map(tuple, run(readers.read_document(spark, path), out, Settings()).collect()))
    assert first == second
    values = {(s, n): v for s, n, v in first}
    assert values[("counts", "before_citas_medicas_rows")] == 6 and values[("counts", "after_citas_medicas_rows")] == 4
    assert values[("rejected_counts", CHILD_TABLE)] == 2 and values[("dwh", "fact_citas")] == 4
    csv = spark.read.csv(f"{out}/processed/pacientes_clean", header=True)
    assert csv.columns == PARENT_EXPORT_COLUMNS and csv.count() == 5
    assert spark.read.csv(f"{out}/processed/citas_medicas_clean", header=True).columns == CHILD_EXPORT_COLUMNS
    rejected = spark.read.csv(f"{out}/processed/citas_medicas_rejected", header=True)
    assert sorted(r["rejection_rule_id"] for r in rejected.collect()) == ["R_COST_NEGATIVE", "R_ORPHAN_CITA"]
    issues = spark.read.csv(f"{out}/processed/data_quality_issues", header=True)
    assert issues.columns == ISSUE_COLUMNS and issues.count() == 3
    summary = spark.read.json(f"{out}/reports/quality_summary_json").first()
    assert summary["severity_by_rule"]["R_ORPHAN_CITA"] == "error"
    assert read_star(spark, f"{out}/star").fact_citas.where(F.col("medico_key") == 1).count() == 4


def test_document_of_one_line_is_read_by_splits(spark, tmp_path):
    """No split reads the line to its end: bytes read stay within a few times the document's."""
    rows = [{**SAMPLE["citas_medicas"][0], "id_cita": f"k{i}", "medico": "x" * 100} for i in range(20_000)]
    content = json.dumps({**SAMPLE, "citas_medicas": rows})
    path = document(tmp_path, content)
    files = spark._jvm.org.apache.hadoop.fs.FileSystem
    bytes_read = lambda: sum(s.getBytesRead() for s in files.getAllStatistics())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        before = bytes_read()
        document_source.split_document(spark, path, [PARENT_TABLE, CHILD_TABLE])
        read = bytes_read() - before
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert read < 10 * len(content), read / len(content)


def test_children_are_judged_while_written(spark, patients, visits, monkeypatch):
    """Children are written once, and no judged table is written beside it."""
    monkeypatch.setattr(integrity, "write_observed", lambda *_, **__: pytest.fail("children written again"))
    kids = visits(visit("a", 1), visit("b", 9), visit("c", 1, cost="-1"), visit("d", 1, state="Rara"))
    done = clean_tables({PARENT_TABLE: patients(GOOD), CHILD_TABLE: kids})
    assert sorted(r["id_cita"] for r in done.children.collect()) == ["a", "d"]
    found = as_dict(done.children_rejected, "id_cita", "rejection_rule_id")
    assert found == {("b",): "R_ORPHAN_CITA", ("c",): "R_COST_NEGATIVE"}
    assert done.after[CHILD_TABLE] == 2 and done.rejected[CHILD_TABLE] == 2
    assert "_verdict" not in done.children.columns + done.children_rejected.columns


def test_counts_write_no_values(spark, patients, visits):
    """Totals and counts are the same when no value of a row is kept for a reader, and those are not written."""
    rows = [GOOD, GOOD, (2, None, "bad", "200", "X", "bad", "1", None), (None, "n", None, None, None, None, None, None)]
    kids = [visit("a", 1), visit("a", 1), visit("b", 9), visit("c", 1, cost="-1"), visit("d", 1, day="2040-01-01"), visit("f", 1), visit("f", 1, kind="Otra")]
    given = {PARENT_TABLE: patients(*rows), CHILD_TABLE: visits(*kids)}
    whole, few = clean_tables(given), clean_tables(given, values=())
    key = lambda df: sorted(map(str, df.collect()))
    assert key(audit.rule_totals(few.totals)) == key(audit.rule_totals(whole.totals))
    assert key(few.issues) == key(whole.issues)
    assert (few.before, few.after, few.rejected) == (whole.before, whole.after, whole.rejected)
    assert {PARENT_TABLE: few.parents_rejected.count(), CHILD_TABLE: few.children_rejected.count()} == whole.rejected
    assert not {"costo", "costo_original", "medico", "_medico"} & set(few.children.columns + few.children_rejected.columns)
    some = clean_tables(given, values=CHILD_EXPORT_COLUMNS)
    assert key(some.children) == key(whole.children.select(some.children.columns)) and set(CHILD_EXPORT_COLUMNS) <= set(some.children.columns)
