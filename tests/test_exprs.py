from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from measurekit.functions import exprs
from measurekit.functions.student_t import t_quantile


def evaluate(spark, expression, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r["out"] for r in rows.select("i", expression.alias("out")).orderBy("i").collect()]


def test_number_accepts_plain_decimals_only(spark):
    values = ["5", " 5.5 ", "-.5", "1e1", "5d", "nan", "1_000", "", None, "inf", "5.", "+3"]
    assert evaluate(spark, exprs.number("c"), values) == [5.0, 5.5, -0.5, 10.0, None, None, None, None, None, None, 5.0, 3.0]


def test_integer_is_strict(spark):
    assert evaluate(spark, exprs.integer("c"), ["8", "8.7", " 9 ", "abc", "", None, "99999999999"]) == [8, None, 9, None, None, None, None]


def test_domain_spellings(spark):
    values = ["ml", "MACHINE  LEARNING", " web dev ", "Web", "Biology", None]
    assert evaluate(spark, exprs.canonical("c"), values) == ["ML", "ML", "Web", "Web", "Biology", None]


def test_percent_range(spark):
    assert evaluate(spark, exprs.percent("c"), ["92%", "0", "100", "105%", "-10", "n/a", None]) == [92.0, 0.0, 100.0, None, None, None, None]


def test_number_words_have_no_range_check(spark):
    assert evaluate(spark, exprs.word_number("c"), ["nine", " TEN ", "-3", "eleven", "7.5", None]) == [9.0, 10.0, -3.0, None, 7.5, None]


def test_lengths(spark):
    values = ["170 cm", "1.62 m", "1.55m", "171", "abc cm", "5 ft", None]
    assert evaluate(spark, exprs.length_cm("c"), values) == [170.0, 162.0, 155.0, 171.0, None, None, None]


def test_masses(spark):
    assert evaluate(spark, exprs.mass_kg("c"), ["65 kg", "55KG", "70", "x kg", None]) == [65.0, 55.0, 70.0, None, None]


def test_yes_no(spark):
    assert evaluate(spark, exprs.yes_no("c"), [" YES ", "y", "1", "true", "0", "maybe", None]) == ["yes"] * 4 + ["no"] * 3


def test_ratio_and_error_never_divide_by_zero(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    out = rows.select(exprs.safe_ratio("a", "b").alias("r"), exprs.percent_error("a", "b").alias("e")).collect()
    assert [r["r"] for r in out] == [0.5, None, None, None]
    assert [r["e"] for r in out] == [-50.0, None, None, None]


def test_stability_limits_are_inclusive(spark):
    assert evaluate(spark, exprs.stability("c"), [0.05, 0.0501, 0.15, 0.2, None], "double") == [
        "stable", "moderate", "moderate", "unstable", "unknown",
    ]


def test_bracket_midpoint(spark):
    assert evaluate(spark, exprs.bracket_midpoint("c"), ["$10-$20", " 0-5", "101+", "$101+", "x"]) == [15.0, 2.5, 110.0, 110.0, None]


def test_null_tokens(spark):
    assert evaluate(spark, exprs.null_tokens("c"), ["NA", "null", " x ", "", "None", "n/a"]) == [None, None, "x", None, None, None]


def test_sigmoid_is_clipped(spark):
    out = evaluate(spark, exprs.sigmoid(F.col("c")), [0.0, 1e9, -1e9], "double")
    assert out[0] == 0.5 and out[1] == 1.0 and 0.0 < out[2] < 1e-200


# Published two-sided 95% critical values (standard statistical tables).
PUBLISHED = {1: 12.7062, 2: 4.3027, 3: 3.1824, 4: 2.7764, 5: 2.5706, 9: 2.2622, 10: 2.2281, 20: 2.0860, 30: 2.0423, 60: 2.0003, 120: 1.9799, 1000: 1.9623}


def test_t_quantile_against_published_table(spark):
    rows = spark.createDataFrame([(n,) for n in PUBLISHED], "n long")
    for r in rows.select("n", t_quantile(F.col("n")).alias("t")).collect():
        assert r["t"] == pytest.approx(PUBLISHED[r["n"]], abs=6e-5)


def test_t_quantile_below_one_degree(spark):
    assert evaluate(spark, t_quantile(F.col("c")), [0, -1, None], "int") == [None, None, None]


def test_t_quantile_is_continuous_at_the_table_end(spark):
    low, high = evaluate(spark, t_quantile(F.col("c")), [60, 61], "int")
    assert 0 < low - high < 0.001
