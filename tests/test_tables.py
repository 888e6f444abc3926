"""Cleaning, profiling, summaries."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from measurekit.operators import clean, profile, summary
from measurekit.plans.students import student_plan, student_rules
from measurekit.sources import records
from tests.fixtures import STUDENTS, STUDENTS_CLEANED, SUBMISSIONS
from tests.helpers import assert_rows


@pytest.fixture
def students(spark, write):
    return records.read_students(spark, write(STUDENTS))


def test_cleaned_students_match(students):
    assert_rows(clean.run(students, student_plan()).collect(), STUDENTS_CLEANED, ("student_id",))


def test_cleaning_edge_rows(spark, write):
    extra = (
        ",NoId,ML,50,1,1,170,60,yes\nS100,,ML,50,1,1,170,60,yes\nS101,NoDomain,,0,-3,5d,abc cm,N/A,maybe\n"
        "S102,Ties,web,100,ten,1_000,171,70kg,1\n"
    )
    out = {r["student_id"]: r for r in clean.run(records.read_students(spark, write(STUDENTS + extra)), student_plan()).collect()}
    assert None not in out and "S100" not in out
    assert out["S101"]["domain"] == "ML"  # most frequent
    assert out["S101"]["attendance_percent"] == 0.0 and out["S101"]["score"] == -3.0 and out["S101"]["submitted"] == "no"
    assert out["S102"]["attendance_percent"] == 100.0 and out["S102"]["height_cm"] == 171.0
    assert out["S101"]["study_hours"] == out["S102"]["study_hours"]  # both filled with the median


def test_profile_before(students):
    facts = {(r["fact"], r["column"]): r["value"] for r in profile.profile(students).collect()}
    assert facts == {
        ("total_rows", ""): 11, ("total_columns", ""): 9, ("missing_values", "attendance_percent"): 1,
        ("missing_values", "score"): 1, ("missing_values", "weight"): 1, ("duplicate_rows", ""): 1,
    }


def test_distinct_in_first_seen_order(students):
    rows = profile.distinct_values(students, ["submitted"]).orderBy("first_row").collect()
    assert [r["value"] for r in rows] == ["yes", "Yes", "no", "Y", "N"]


def test_validation_passes_after_cleaning(students):
    table = profile.validate(clean.run(students, student_plan()), student_rules(), ["student_id"]).collect()
    assert len(table) == 17 and all(r["passed"] for r in table)


def test_validation_counts_failures(spark):
    rows = spark.createDataFrame([("a", 5.0, "yes"), ("a", -1.0, "maybe"), ("b", None, None)], "id string, score double, submitted string")
    rules = [profile.number_rule("score", 0), profile.member_rule("submitted", ("yes", "no"))]
    table = {r["rule"]: r["invalid"] for r in profile.validate(rows, rules, ["id"]).collect()}
    assert table == {"score >= 0": 2, "submitted is known": 2, "id is unique": 1}
    assert {(r["value"], r["n"]) for r in profile.offending_values(rows, "submitted", ("yes", "no")).collect()} == {("maybe", 1), (None, 1)}


def test_dedupe_keeps_first_and_null_equals_null(spark):
    rows = spark.createDataFrame([(3, None, 1), (1, None, 1), (2, "a", None), (9, "a", None)], "_rid long, a string, b int")
    assert sorted(r["_rid"] for r in clean.dedupe(rows).collect()) == [1, 2]
    assert {(r["a"], r["_rid"]) for r in clean.dedupe(rows, ["a"]).collect()} == {(None, 1), ("a", 2)}


def test_mode_takes_the_smallest_on_a_tie(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert clean.mode_row(rows, "c").first()["c"] == "a"


def test_median_of_an_even_count_is_the_midpoint(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert sorted(r["x"] for r in clean.fill(rows, {"x": "median"}).collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]


def test_fill_without_any_value_stays_null(spark):
    rows = spark.createDataFrame([(None, None)], "x double, c string")
    assert clean.fill(rows, {"x": "median", "c": "mode"}).first().asDict() == {"x": None, "c": None}


def test_empty_columns_are_dropped(spark):
    rows = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert clean.drop_empty_columns(rows).columns == ["a"]


def test_sentinel(spark):
    rows = spark.createDataFrame([(-200.0, "x", -200), (1.5, "y", 3)], "a double, t string, n int")
    out = clean.sentinel_to_null(rows, -200).collect()
    assert [tuple(r) for r in out] == [(None, "x", None), (1.5, "y", 3)]


@pytest.fixture
def submissions(spark, write):
    return records.read_submissions(spark, write(SUBMISSIONS))[0]


def test_summary_document(submissions):
    found = json.loads(summary.document(submissions).toJSON().first())
    assert found == {
        "total_students": 7, "submitted_count": 5, "missing_count": 2, "average_score": 4.86,
        "highest_scorer": {"name": "Isha", "domain": "Electronics", "score": 9},
        "lowest_scorer_submitted": {"name": "Rohan", "domain": "Web", "score": 4},
        "domain_wise_average": {"ML": 5.0, "Web": 5.0, "Electronics": 9.0, "Mechanical": 0.0},
        "missing_submissions": ["Kabir", "Dev"], "students_below_5": ["Kabir", "Rohan", "Dev"],
    }


def test_summary_ties_and_missing_flags(spark):
    rows = spark.createDataFrame([(0, "a", "d", 5, False), (1, "b", "d", 5, False)], "_rid long, name string, domain string, score int, submitted boolean")
    row = summary.summarize(rows).first()
    assert row["highest_scorer"]["name"] == "a" and row["lowest_scorer_submitted"] is None
    assert summary.summarize(rows.limit(0)).collect() == []


def test_summary_tables(submissions):
    found = summary.tables(submissions)
    assert {r["domain"]: r["mean"] for r in found["domain_wise_average"].collect()} == {"ML": 5.0, "Web": 5.0, "Electronics": 9.0, "Mechanical": 0.0}
    assert [r["name"] for r in found["missing_submissions"].orderBy("_rid").collect()] == ["Kabir", "Dev"]
    assert [r["name"] for r in found["students_below_5"].orderBy("_rid").collect()] == ["Kabir", "Rohan", "Dev"]
    assert found["summary"].first()["total_students"] == 7


def test_diff_and_multiset(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("only", 3.0)], "k string, v double")
    b = spark.createDataFrame([("x", 1.0), ("y", 2.5), ("new", None)], "k string, v double")
    assert {(r["k"], r["a"], r["b"]) for r in summary.diff(a, b, ["k"], ["v"]).collect()} == {("y", "2.0", "2.5"), ("only", "3.0", None)}
    left = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    right = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    assert tuple(summary.multiset_diff(left, right).first()) == (1, 2)


def test_describe_matches_pandas(spark):
    values = [float(v * v % 37) for v in range(101)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    import pandas as pd

    expected = pd.Series(values).describe()
    row = profile.describe(rows, ["x"]).first()
    for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}.items():
        assert row[ours] == pytest.approx(expected[theirs])
