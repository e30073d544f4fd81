"""Numbers, text, dates, URLs and nested data against plain Python."""

import html
import math
from decimal import Context, Decimal

import pandas as pd
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pledgeflow.functions import dates, nested, numbers, text, urls
from pledgeflow.operators.scale import choose_scale

VALUES = [
    0.0, 1.0, 9.99951, 10.0, 99.9951, 123.456, 999.949, 1000.0, 1234.0, 12345.678, 120000.0, 999949.0, 1e6, 1234567.0,
    2.5e9, 1e12, 0.1, 0.0123456, 0.001, 0.000123456, 1.5e-7, 4e-12, -5.0, -1234567.0,
]


def _apply(spark, values, *columns):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return [tuple(r) for r in df.select("x", *columns).collect()]


def test_engineering_matches_decimal(spark):
    for x, mantissa, exponent in _apply(
        spark,
        VALUES,
        numbers.engineering(numbers.four_digits(F.col("x")))["mantissa"].alias("m"),
        numbers.engineering(numbers.four_digits(F.col("x")))["exponent"].alias("e"),
    ):
        shown = mantissa if exponent == 0 else f"{mantissa}E{exponent:+d}"
        assert shown == Decimal(x).normalize(Context(prec=4)).to_eng_string(), x


def test_grouped_text_matches_decimal(spark):
    for x, shown in _apply(spark, VALUES, numbers.grouped_text(F.col("x")).alias("t")):
        d = Decimal(x).normalize(Context(prec=4))
        assert shown == ("{:,f}".format(d) if 1000000 > d >= 1 else d.to_eng_string()), x


def test_pretty_number_words(spark):
    got = dict(_apply(spark, [0, 1234567, 12, 0.0000005, 5e15], numbers.pretty_number(F.col("x")).alias("t")))
    assert got == {0.0: "0.0", 1234567.0: "1.235 Million", 12.0: "12", 5e-7: "500 Billionths", 5e15: None}


@pytest.mark.parametrize(
    "x,p,want",
    [
        (0, 3, "0.00"), (1234.5, 3, "1.23e+3"), (123.4, 3, "123"), (12.34, 3, "12.3"), (1.0, 3, "1.00"),
        (0.0123, 3, "0.0123"), (0.00123, 3, "1.23e-3"), (-99.96, 3, "-100"), (999.6, 3, "1.00e+3"), (0.5, 2, "0.50"),
    ],
)
def test_to_precision(spark, x, p, want):
    assert _apply(spark, [x], numbers.to_precision(F.col("x"), p).alias("t"))[0][1] == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=1e-6, max_value=1e12), min_size=1, max_size=30))
def test_to_precision_is_close(spark, values):
    for x, shown in _apply(spark, values, numbers.to_precision(F.col("x"), 4).alias("t")):
        assert math.isclose(float(shown), x, rel_tol=1e-3)


def test_sig_figs(spark):
    got = _apply(spark, [0.0, 1234.0, 0.0456, -87.0], numbers.sig_figs(F.col("x"), 2).alias("s"))
    assert [round(s, 6) for _, s in got] == [0.0, 1200.0, 0.046, -87.0]


def test_parsing_rejects_instead_of_guessing(spark):
    df = spark.createDataFrame([("$1,234.50",), ("0",), ("12",), ("$x",), (None,)], "s string")
    got = [r[0] for r in df.select(numbers.money(F.col("s"))).collect()]
    assert got == [1234.5, 0.0, None, None, None]
    got = [r[0] for r in df.select(numbers.digits_only(F.col("s"))).collect()]
    assert got == [1234, 0, 12, None, None]


def test_axis_helpers(spark):
    df = spark.range(1).select(numbers.axis_ticks(0, 10, 5).alias("t"), numbers.log_edges(2, 1).alias("e"))
    assert df.collect()[0] == ([0.0, 2.0, 4.0, 6.0, 8.0, 10.0], [1.0, 10.0, 100.0])


def test_scale_prefers_the_smaller_on_ties(spark):
    df = spark.createDataFrame([("a", "mean", 5000.0), ("a", "max", 9e6), ("b", "mean", 7.0), ("c", "mean", 0.0)], "variable string, stat string, value double")
    got = {(r.variable, r.stat): (r.unit, r.text) for r in choose_scale(df, ["variable"]).collect()}
    assert got[("b", "mean")] == (None, "7")
    assert got[("a", "mean")] == ("1000s", "5")
    assert got[("c", "mean")][0] is None


def test_script_fields(spark):
    script = "var a = {'k': 'v', flag: Y, off:N; none_key: none, k: \"w\", url: http://x, say: 'it\\'s'}"
    df = spark.createDataFrame([(script,)], "s string")
    fields, conflict = df.select(nested.script_fields(F.col("s")), nested.script_fields_conflict(F.col("s"))).collect()[0]
    assert fields == {"k": "w", "flag": "true", "off": "false", "none_key": None, "say": "it's"}
    assert conflict


def test_split_location_keeps_of_parts(spark):
    df = spark.createDataFrame([("Town, Korea, Republic of",), ("A, B",), ("X",)], "s string")
    assert [r[0] for r in df.select(text.split_location(F.col("s"))).collect()] == [
        ["Town", "Korea, Republic of"], ["A", "B"], ["X"],
    ]


def test_script_literal(spark):
    df = spark.createDataFrame([(r"aé\n&quot;\\x&amp;\x41\101",), (None,)], "s string")
    assert [r[0] for r in df.select(text.script_literal(F.col("s"))).collect()] == ['aé\n"\\x&AA', None]


LITERALS = [
    r"plain", r"a\u00e9\n\"q\" \\u0041 \x41\t\q\/", r"\ud83d\ude00!", r"\ud83d alone", r"x\ude00", r"\ud83d\ud83d\ude00", r"\101\7", r"\N{BULLET}",
    r"\U0001f600", r"\u12", r"\x4", "end\\", "two\\\\", r"&amp;lt; &quot;&#39;&#x27; &amp;amp;", r"&eacute;&#233;", r"a & b &", r"AT&T", r"\u0026amp;", r"&#X41;",
    r"\\N{BULLET}", "line\\\nnext", "", "\\", r"\u0041\u0042\x43", "\U0001f642\\n",
]


def test_common_literals_stay_in_the_jvm(spark, monkeypatch):
    """All forms equal the Python decoding, and Python is handed nothing but the rare ones."""
    df = spark.createDataFrame([(t,) for t in LITERALS], "s string")
    want = [html.unescape(text._unescaped(t)) for t in LITERALS]
    assert [r[0] for r in df.select(text.script_literal(F.col("s"))).collect()] == want

    @F.pandas_udf("string")
    def marked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else "python")

    monkeypatch.setattr(text, "_literal", marked)
    got = {t: r[0] for t, r in zip(LITERALS, df.select(text.script_literal(F.col("s"))).collect())}
    assert all(got[t] != "python" for t in (LITERALS[0], LITERALS[1], LITERALS[2], LITERALS[13], "end\\", r"\u0041\u0042\x43", r"a & b &"))
    assert got[r"\N{BULLET}"] == got[r"&eacute;&#233;"] == got[r"\ud83d alone"] == "python"


def test_redecode_drops_bad_bytes(spark):
    good, bad = "é€".encode().decode("latin1"), "é€".encode().decode("latin1") + "\xe9"
    df = spark.createDataFrame([(good,), (bad,)], "s string")
    got = df.select(text.redecode(F.col("s")), text.decodes(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [("é€", True), ("é€", False)]


def test_dates(spark):
    df = spark.createDataFrame([("2014-01-02T03:04:05Z",), ("2014-01-02T03:04:05",), ("junk",), (None,)], "s string")
    got = [str(r[0]) for r in df.select(dates.iso_timestamp(F.col("s"))).collect()]
    assert got == ["2014-01-02 03:04:05"] * 2 + ["None"] * 2
    df = spark.createDataFrame([("Jun 05, 2015",), ("Jun 5, 2015 14:30",), ("5 o'clock",)], "s string")
    assert [str(r[0]) for r in df.select(dates.long_date(F.col("s"))).collect()] == ["2015-06-05", "2015-06-05", "None"]


def test_absolute_links(spark):
    base = "https://a.example/x/y?q=1#f"
    cases = {
        "/p": "https://a.example/p", "p": "https://a.example/x/p", "http://o/z": "http://o/z", "//c/d": "https://c/d",
        "?k=2": "https://a.example/x/y?k=2", "#top": "https://a.example/x/y#top", "mailto:m@x": "mailto:m@x",
    }
    df = spark.createDataFrame(list(cases.items()), "href string, want string")
    for href, want, got in df.select("href", "want", urls.absolute(F.col("href"), F.lit(base))).collect():
        assert got == want, href


def test_split_zip_cuts_to_shortest(spark):
    df = spark.createDataFrame([(1, "a, b ,c", "x,y"), (2, None, "z")], "id long, t string, n string")
    assert rows(nested.split_zip(df, ["id"], ["t", "n"])) == [(1, "a", "x"), (1, "b", "y")]


def test_flatten_rejects_contradicting_names(spark):
    df = spark.createDataFrame([(((1,), 1),), (((2,), 2),)], "d struct<a: struct<b: int>, a_b: int>")
    assert rows(nested.flatten(df, "d")) == [(1,), (2,)]
    bad = spark.createDataFrame([(((1,), 2),)], "d struct<a: struct<b: int>, a_b: int>")
    with pytest.raises(Exception, match="values of a_b differ"):
        nested.flatten(bad, "d").collect()


def test_null_arrays_give_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a"])], "id long, l array<string>")
    assert rows(nested.explode_scalars(df, {"id": "loan"}, "l", "lender")) == [(3, "a")]
