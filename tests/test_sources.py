from __future__ import annotations

import pytest

from measurekit.sources import records, sinks
from tests.fixtures import SUBMISSIONS

EDGE = SUBMISSIONS + "Bad,ML,Task2,abc,yes\nBlank,ML,Task2,,yes\nHalf,ML,Task2,8.7, YES \n\nShort,ML\nLong,ML,Task2,5,yes,extra\n"


def names(df):
    return [r["name"] for r in df.orderBy("_rid").collect()]


def test_skip_rejects_bad_scores(spark, write):
    valid, rejected = records.read_submissions(spark, write(EDGE), "skip", strict_width=True)
    assert names(valid) == ["Aarav", "Meera", "Kabir", "Isha", "Rohan", "Tara", "Dev"]
    lines = [r["line"] for r in rejected.orderBy("_rid").collect()]
    assert lines == ["invalid score: abc", "invalid score: missing", "invalid score: 8.7", "Short,ML", "Long,ML,Task2,5,yes,extra"]


def test_zero_coerces_and_truncates(spark, write):
    valid, _ = records.read_submissions(spark, write(EDGE), "zero", strict_width=True)
    scores = {r["name"]: r["score"] for r in valid.collect()}
    assert (scores["Bad"], scores["Blank"], scores["Half"]) == (0, 0, 8)


def test_flag_is_trimmed_and_lowered(spark, write):
    valid, _ = records.read_submissions(spark, write(EDGE), "null", strict_width=True)
    flags = {r["name"]: (r["score"], r["submitted"]) for r in valid.collect()}
    assert flags["Half"] == (None, True) and flags["Kabir"] == (0, False)


def test_empty_input_is_an_error(spark, write):
    valid, _ = records.read_submissions(spark, write("name,domain,task,score,submitted\n"))
    with pytest.raises(ValueError):
        records.require_rows(valid, "input")


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing"):
        records.require_columns(spark.range(1), ["id", "missing"])


def test_european_table(spark, write):
    text = (
        "Date;Time;CO(GT);PT08.S1(CO);T;Empty;;\n"
        "10/03/2004;18.00.00;2,6;1360;13,6;;;\n10/03/2004;19.00.00;-200;1292;13,3;;;\n;;;;;;;\n"
    )
    columns = ("Date", "Time", "CO(GT)", "PT08.S1(CO)", "T", "Empty", "x", "y")
    rows = records.read_european(spark, write(text), columns)
    assert rows.columns == ["_rid", "Date", "Time", "CO_GT", "PT08_S1_CO", "T"]
    assert [(r["CO_GT"], r["PT08_S1_CO"], r["T"]) for r in rows.orderBy("_rid").collect()] == [(2.6, 1360.0, 13.6), (-200.0, 1292.0, 13.3)]


def test_scoring_input(spark, write):
    path = write("N,P,other\n1,2,x\n3,oops,y\n")
    rows = records.read_scoring_input(spark, path, ["N", "P"]).collect()
    assert sorted((r["N"], r["P"]) for r in rows)[0] == (1.0, 2.0)
    with pytest.raises(ValueError, match="rainfall"):
        records.read_scoring_input(spark, path, ["N", "rainfall"])


def test_table_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", 2.5)], "id int, name string, x double")
    for fmt in ("parquet", "json", "csv"):
        path = str(tmp_path / fmt)
        sinks.write_table(rows, path, fmt)
        reader = spark.read.schema(rows.schema).option("header", True)
        assert sorted(map(tuple, reader.format(fmt).load(path).select("id", "name", "x").collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(ValueError):
        sinks.write_table(rows, str(tmp_path / "x"), "xml")


def test_columns_follow_the_header(spark, write):
    text = "domain,name,extra,task,submitted,score\nML,Aarav,x,Task1,yes,7\nWeb,Meera,x,Task1,no,4\n"
    valid, rejected = records.read_submissions(spark, write(text))
    assert [(r["name"], r["domain"], r["score"], r["submitted"]) for r in valid.orderBy("_rid").collect()] == [("Aarav", "ML", 7, True), ("Meera", "Web", 4, False)]
    assert rejected.collect() == []
    with pytest.raises(ValueError, match="score"):
        records.read_submissions(spark, write("name,domain,task,submitted\na,b,c,yes\n", "short.csv"))


def test_doubled_quotes_and_line_breaks(spark, write):
    head = "name,domain,task,score,submitted\n"
    valid, _ = records.read_submissions(spark, write(head + '"Aa ""x"", v",ML,T,5,yes\n'))
    assert names(valid) == ['Aa "x", v']
    broken = write(head + '"Aa\nv",ML,T,5,yes\nBe,ML,T,6,yes\n', "broken.csv")
    valid, rejected = records.read_submissions(spark, broken)
    assert names(valid) == ["Be"] and rejected.count() == 2
    whole, _ = records.read_text_table(spark, broken, records.SUBMISSION_COLUMNS, null_tokens=(), multiline=True)
    assert names(whole) == ["Aa\nv", "Be"]


def test_huge_numbers_do_not_fail(spark, write):
    text = "name,domain,task,score,submitted\na,ML,T,1e12,yes\nb,ML,T,-3.9,yes\nc,ML,T,99999999999,no\n"
    valid, _ = records.read_submissions(spark, write(text), "zero")
    assert [r["score"] for r in valid.orderBy("_rid").collect()] == [0, -3, 0]
    assert records.read_submissions(spark, write(text))[0].count() == 0


def test_quotes_survive_a_written_table(spark, tmp_path):
    rows = spark.createDataFrame([('a "b", c',), ("back\\slash",)], "name string")
    sinks.write_table(rows, str(tmp_path / "q"), "csv")
    assert sorted(r["name"] for r in records.read_plain(spark, str(tmp_path / "q")).collect()) == sorted(r["name"] for r in rows.collect())
