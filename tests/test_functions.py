from datetime import date

from pyspark.sql import functions as F

from pulcra import catalogs as k
from pulcra import functions as fn


def d(*parts):
    return date(*parts)


def test_catalogs(evaluate):
    sexes = ["Female", "male", "M", "F", "hombre", "mujer", " M ", "X", None, "", "   "]
    expected = ["F", "M", "M", "F", "M", "F", "M", None, None, None, None]
    assert evaluate(lambda c: fn.normalize_catalog(c, k.SEX_CATALOG), sexes) == expected
    states = ["completada", "CANCELADA", " Reprogramada", "X", None, ""]
    expected = ["Completada", "Cancelada", "Reprogramada", None, None, None]
    assert evaluate(lambda c: fn.normalize_catalog(c, k.STATUS_CATALOG), states) == expected


def test_parse_date(evaluate):
    cases = {
        "2000-01-15": d(2000, 1, 15),
        "2000-1-5": d(2000, 1, 5),
        " 2000-01-15\t": d(2000, 1, 15),
        "2023-01- 5": d(2023, 1, 5),
        "2023-05-01": d(2023, 5, 1),
        "2023-19-01": d(2023, 1, 19),
        "2023- 19 -01": d(2023, 1, 19),
        "2023-32-01": None,
        "2023-31-02": None,
        "2023-02-30": None,
        "1899-19-01": None,
        "0000-01-01": None,
        "2000": None,
        "2000-01": None,
        "2022-02-14T00:00:00": None,
        "07 de ago de 1984": d(1984, 8, 7),
        "7 ago 1984": d(1984, 8, 7),
        "07/ago/1984": d(1984, 8, 7),
        "07-AGO-1984": d(1984, 8, 7),
        "23 de abril de 1996": d(1996, 4, 23),
        "4 setiembre 2013": d(2013, 9, 4),
        "40 de ago de 1984": None,
        "00 ago 1984": None,
        "7 zzz 1984": None,
        "7 ago 1899": None,
        "not-a-date": None,
        "": None,
        None: None,
    }
    assert evaluate(fn.parse_date, list(cases)) == list(cases.values())
    assert evaluate(fn.strict_iso_date, ["2000-01-15", "2023-19-01", None, ""]) == [True, False, False, False]


def test_numbers(evaluate):
    ints = {"5": 5, " +5 ": 5, "-3": -3, "58.0": 58, "1_000": 1000, "58.5": None, "abc": None, "": None, None: None, "12d": None}
    assert evaluate(fn.try_int, list(ints)) == list(ints.values())
    doubles = {"5": 5.0, " .5": 0.5, "5.": 5.0, "1e3": 1000.0, "-5": -5.0, "1_000.5": 1000.5, "12d": None, "1.5f": None,
               "nan": None, "inf": float("inf"), "-Infinity": float("-inf"), "   ": None, None: None, "abc": None}
    assert evaluate(fn.try_double, list(doubles)) == list(doubles.values())


def test_contact(evaluate):
    mails = {" Nora.Paz@Correo.ORG ": "nora.paz@correo.org", "nora paz": None, "nora@correo": None, "": None, "   ": None, None: None, "n@correo.org y": None}
    assert evaluate(fn.email_normalize, list(mails)) == list(mails.values())
    assert evaluate(fn.email_valid, list(mails)) == [v is not None for v in mails.values()]
    phones = {"(60) 555.010-22": "6055501022", "sin": None, "   ": None, None: None, "12": "12"}
    assert evaluate(fn.phone_digits, list(phones)) == list(phones.values())
    gate = lambda c: fn.phone_gate(c, 10, 15)
    assert evaluate(gate, ["1" * 9, "1" * 10, "1" * 15, "1" * 16, None]) == [None, "1" * 10, "1" * 15, None, None]


def test_age(evaluate):
    births = ["2000-02-29", "2000-02-28", None]
    age = lambda c: fn.age_at(c.cast("date"), date(2023, 2, 28))
    assert evaluate(age, births) == [22, 23, None]
    assert evaluate(lambda c: fn.age_bounded(c.cast("int")), ["-1", "0", "120", "121"]) == [None, 0, 120, None]


def test_text_and_keys(evaluate, spark):
    assert evaluate(fn.text_normalize, ["  a\n", "  ", None]) == ["a", None, None]
    assert evaluate(fn.date_key_of_text, ["2022-02-14", "20220214", "", "not-a-date", None]) == [20220214, 20220214, 0, 0, 0]
    long = "x" * 150
    assert evaluate(fn.truncate_text, [None, "a\nb ", long, "y" * 140]) == ["NULL", "a b", "x" * 137 + "...", "y" * 140]
    parts = spark.range(1).select(*[c.alias(n) for n, c in fn.date_key_parts(F.lit(20220204)).items()]).first()
    assert tuple(parts) == ("2022-02-04", 2022, 2, 4)


def test_row_comparison(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("", "ab"), ("ab", None)], "x string, y string")
    signatures = [r[0] for r in df.select(fn.row_signature(["x", "y"])).collect()]
    assert signatures == ["a|b", "ab|", "|ab", "ab|"]
    prints = [tuple(r) for r in df.select(*fn.row_fingerprint(["x", "y"])).collect()]
    assert prints[1] == prints[3] and len(set(prints)) == 3


def test_strip_takes_the_short_way_for_plain_texts_only(evaluate):
    edges = {"a": "a", "~!": "~!", "": "", " ": "", "\u00a0x\u3000": "x", "x\u2003": "x", "\x1cx": "x", "é ": "é", "\x7fx\x85": "\x7fx", "a\U0001f600 ": "a\U0001f600"}
    assert evaluate(lambda c: fn.strip(c), list(edges)) == list(edges.values())
    assert evaluate(lambda c: fn.text_normalize(c), ["\u2003", None, " a "]) == [None, None, "a"]
