from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starwash.functions import dates, numeric, rules, text


def apply(spark, values, f, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


TEXTS = [
    "o'brien 7-eleven abc123DEF", "ÉCOLE ßtraße ǆabc", "ไทย ABC", "a-b c_d e.f 1a2b", "", "ALL CAPS",
    "mc'd  o''n", "cafÉ éa", "x", "#1a", "a#é", "Customer#000000123", "7ELEVEN",
]


def test_title_case_is_pythons(spark):
    assert apply(spark, TEXTS, text.title_case) == [t.title() for t in TEXTS]


def test_strip_and_squeeze_know_all_white_space(spark):
    values = ["  north \t  EAST ", " a b　", "\x1c\x85x\n", "plain", " a  b ", "a\tb", "\n"]
    assert apply(spark, values, text.strip) == [v.strip() for v in values]
    assert apply(spark, values, text.squeeze) == [" ".join(v.split()) for v in values]
    assert text.WHITE_SPACE == "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def test_standard_text(spark):
    assert apply(spark, ["  north \t  EAST ", None], text.standard_text) == ["North East", None]
    assert apply(spark, ["   ", " a  B", None], text.clean_text) == [None, "a B", None]


def test_clean_text_columns_keeps_null_and_blank_apart(spark):
    df = spark.createDataFrame([(" a  b ", "\t"), (None, "x y")], "p string, q string")
    got = text.clean_text_columns(df, {"p": "p", "r": "q"}, title=True).select("p", "r").collect()
    assert [tuple(r) for r in got] == [("A B", ""), (None, "X Y")]
    got = text.clean_text_columns(df, {"r": "q"}, title=True, blank_to_null=True).select("r").collect()
    assert [r[0] for r in got] == [None, "X Y"]


def test_clean_email(spark):
    values = [" Cust1@Example.COM ", "a b@x.org", "no-at.example", "two@@x.org", " q@x.y\t", "ü@x.de", "a@b", None]
    want = ["cust1@example.com", "ab@x.org", None, None, "q@x.y", "ü@x.de", None, None]
    assert apply(spark, values, text.clean_email) == want


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("  ", 2), ("", 3), ("x", 4), ("nan", 5)], "t string, n int")
    assert [r.t for r in text.null_tokens_to_null(df).orderBy("n").collect()] == [None, "  ", None, "x", None]


def test_parse_number(spark):
    values = ["1d", "1,000", " 1.5 ", "1e3", "", "0x1A", "0x1p3", "nan", "1f", "inf", "-Infinity", "5.", ".5", "+7", "1e", None]
    want = [None, None, 1.5, 1000.0, None, None, None, None, None, None, None, 5.0, 0.5, 7.0, None, None]
    assert apply(spark, values, numeric.parse_number) == want


def test_parse_currency(spark):
    values = ["$1,234.50", "THB 99", "-3", "free", "1.2.3", None]
    assert apply(spark, values, numeric.parse_currency) == [1234.5, 99.0, -3.0, None, None, None]


def test_rounding_is_half_even_on_the_binary_value(spark):
    values = [0.125, 0.135, 2.675, 1.005, -0.125] + [i / 1000 + 0.005 for i in range(0, 4000, 10)]
    got = apply(spark, values, numeric.round_half_even, "double")
    assert got == [float(x) for x in np.round(np.array(values), 2)]


def test_net_and_imputed_amount(spark):
    row = spark.range(1).select(
        numeric.net_amount(F.lit(1.0), F.lit(0.125), F.lit(0.0)),
        numeric.impute_amount(F.lit(None).cast("double"), F.lit(3.0), F.lit(1.5)),
        numeric.impute_amount(F.lit(9.0), F.lit(3.0), F.lit(1.5)),
        numeric.impute_amount(F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(1.5)),
    ).first()
    assert tuple(row) == (0.12, 4.5, 9.0, None)


def test_parse_dates(spark):
    day = dt.date(2024, 1, 5)
    values = ["5/1/2024", "05-JAN-2024", "2024-1-5", " 2024-01-05\t", "05-01-24", "31/02/2026", "2024-01-05 10:00",
              "2024", "+2024-1-5", "5-Foo-2024", "2024/01/05", "31-Feb-2024", None]
    want = [day] * 4 + [None] * 9
    assert apply(spark, values, dates.parse_dates) == want


def test_parse_flexible_date(spark):
    day = dt.date(2024, 1, 5)
    values = ["2024/01/05", "5-1-2024", "Jan 5, 2024", "05/01/2024", "2024-01-05", "05-Jan-2024", "Jan 32, 2024", "x"]
    assert apply(spark, values, dates.parse_flexible_date) == [day] * 6 + [None] * 2


def d(text_value):
    return dt.date.fromisoformat(text_value)


AMBIGUOUS = [
    ("2026-06-02", "2026-06-03", "2026-06-02", dates.ISO),
    ("2026/06-02", "2026-06-03", "2026-06-02", dates.ISO),
    ("25/06/2026", "2026-06-03", "2026-06-25", dates.DMY_CERTAIN),
    ("06-25-2026", "2026-06-03", "2026-06-25", dates.MDY_CERTAIN),
    ("02/06/2026", "2026-06-02", "2026-06-02", dates.DMY_BY_LOAD),
    ("02/06/2026", "2026-02-06", "2026-02-06", dates.MDY_BY_LOAD),
    ("02/06/2026", "2026-06-03", "2026-06-02", dates.DMY_ASSUMED),
    ("05/05/2026", "2026-06-03", "2026-05-05", dates.DMY_ASSUMED),
    ("05/05/2026", "2026-05-05", "2026-05-05", dates.DMY_BY_LOAD),
    ("02/06/2026", None, "2026-06-02", dates.DMY_ASSUMED),
    ("31/02/2026", "2026-06-03", None, dates.UNPARSEABLE),
    ("2026-13-05", "2026-06-03", None, dates.UNPARSEABLE),
    ("2026-1-5", "2026-06-03", None, dates.UNPARSEABLE),
    ("not_a_date", "2026-06-03", None, dates.UNPARSEABLE),
    (None, "2026-06-03", None, dates.UNPARSEABLE),
    ("0/5/2026", "2026-06-03", None, dates.UNPARSEABLE),
]


def test_ambiguous_dates(spark):
    rows = [(i, t, d(load) if load else None) for i, (t, load, _, _) in enumerate(AMBIGUOUS)]
    df = spark.createDataFrame(rows, "i int, t string, load date")
    got = dates.resolve_ambiguous_date(df, "t", F.col("load"), "day", "method").orderBy("i").collect()
    assert [(r.day, r.method) for r in got] == [(d(x) if x else None, m) for _, _, x, m in AMBIGUOUS]


@pytest.mark.parametrize("load", ["2026-06-02", "2026-02-06", "2025-12-31"])
def test_ambiguous_dates_against_a_row_by_row_reading(spark, load):
    """All day/month pairs, with the decision written out plainly."""
    loaded = d(load)

    def real(day, month):
        try:
            return dt.date(2026, month, day)
        except ValueError:
            return None

    def expected(a, b):
        dmy, mdy = real(a, b), real(b, a)
        if a > 12 and dmy:
            return dmy, dates.DMY_CERTAIN
        if b > 12 and mdy:
            return mdy, dates.MDY_CERTAIN
        for candidate, label in ((dmy, dates.DMY_BY_LOAD), (mdy, dates.MDY_BY_LOAD)):
            if a <= 12 and b <= 12 and candidate == loaded:
                return candidate, label
        return (dmy, dates.DMY_ASSUMED) if a <= 12 and b <= 12 and dmy else (None, dates.UNPARSEABLE)

    pairs = [(a, b) for a in range(0, 33) for b in range(0, 33)]
    df = spark.createDataFrame([(i, f"{a}/{b}/2026") for i, (a, b) in enumerate(pairs)], "i int, t string")
    out = dates.resolve_ambiguous_date(df, "t", F.lit(loaded), "day", "method").orderBy("i").collect()
    got = [(r.day, r.method) for r in out]
    assert got == [expected(a, b) for a, b in pairs]


def test_load_delay(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "2024-01-02 03:00:00"), ("2024-01-01", "2024-01-02 00:00:00"), ("2024-01-03", "2024-01-02 12:00:00")],
        "a string, b string",
    ).select(dates.hours_between(F.col("a"), F.col("b")).alias("h"))
    got = df.select("h", dates.is_late(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [(27.0, True), (24.0, False), (-12.0, False)]


def test_membership_and_inequality_never_give_null(spark):
    values = [None, "Y", "N"]
    assert apply(spark, values, lambda c: rules.in_set(c, ["Y"])) == [False, True, False]
    assert apply(spark, values, lambda c: rules.not_in_set(c, ["Y"])) == [True, False, True]
    assert apply(spark, values, lambda c: rules.differs_from(c, "Y")) == [True, False, True]


def test_synonyms(spark):
    assert apply(spark, [" MALE ", "f", None, "x"], lambda c: rules.standardize(c, rules.GENDER_RULES)) == [
        "M", "F", "Unknown", "Unknown"
    ]
    assert apply(spark, ["done", "Cancel", "RETURNED", "unknown_status"], lambda c: rules.standardize(c, rules.STATUS_RULES)) == [
        "Completed", "Cancelled", "Returned", "Unknown"
    ]


def test_row_rules(spark):
    email = spark.createDataFrame([(None, "C0103"), (None, None), ("a@b.c", "C1")], "e string, c string").select(
        rules.placeholder_email(F.col("e"), F.col("c"))
    )
    assert [r[0] for r in email.collect()] == ["unknown_C0103@unknown.local", "unknown_@unknown.local", "a@b.c"]
    assert apply(spark, [-3, 0, 1, 20, 99, None], rules.invalid_quantity, "int") == [True, True, False, False, True, True]
    flags = spark.createDataFrame(
        [(10.0, 11.0, "N"), (10.0, 11.5, "N"), (10.0, 50.0, "Y"), (10.0, 50.0, None), (None, 1.0, "N")],
        "a double, e double, p string",
    ).select(rules.amount_mismatch(F.col("a"), F.col("e"), F.col("p")))
    assert [r[0] for r in flags.collect()] == [False, True, False, True, False]


def test_currency_is_one_shape_or_null(spark):
    expected = {
        "$1,234.50": 1234.5, "Rs. 500": 500.0, "(100.50)": -100.5, "-12.50 EUR": -12.5, "+5": 5.0, "$-5": -5.0,
        "-$5": -5.0, "€ 7": 7.0, "THB 1,000": 1000.0, ".5": 0.5, "5.": 5.0, " 8 ": 8.0, "(1,000)": -1000.0,
        "1e3": None, "2 for 100": None, "1.234,50": None, "--5": None, "(-5)": None, "100)": None, "(100": None,
        "": None, "12,34": None, "1000,000": None, "abc": None, "9" * 400: None, "1\n2": None, "-": None,
    }
    rows = spark.createDataFrame([(t,) for t in [*expected, None]], "t string")
    got = {r.t: r.v for r in rows.select("t", numeric.parse_currency(F.col("t")).alias("v")).collect()}
    assert got == {**expected, None: None}


def test_numbers_are_finite(spark):
    rows = spark.createDataFrame([(t,) for t in ("inf", "-Infinity", "1e400", "1e3", "NaN")], "t string")
    got = {r.t: r.v for r in rows.select("t", numeric.parse_number(F.col("t")).alias("v")).collect()}
    assert got == {"inf": None, "-Infinity": None, "1e400": None, "1e3": 1000.0, "NaN": None}


def test_year_zero_is_no_date(spark):
    texts = ["0000-01-05", "05-Jan-0000", "05/01/0000", "Jan 5, 0000", "0001-01-05"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", dates.parse_dates(F.col("t")).alias("a"), dates.parse_flexible_date(F.col("t")).alias("b")
    )
    got = {r.t: (r.a, r.b) for r in rows.collect()}
    day = dt.date(1, 1, 5)
    assert got == {**{t: (None, None) for t in texts[:-1]}, "0001-01-05": (day, day)}


def test_load_delay_ignores_clock_changes(spark):
    rows = spark.createDataFrame([("2024-03-10", "2024-03-11 00:30:00"), ("2024-03-10", "2024-03-09 12:00:00")], "a string, b string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            hours = rows.select(dates.hours_between(F.col("a"), F.col("b")).alias("h"))
            assert [r.h for r in hours.collect()] == [24.5, -12.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
