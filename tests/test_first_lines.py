"""Headers are found without sorting the first blocks of the files."""

from __future__ import annotations

from measurekit.sources import delimited


def test_first_lines_hold_one_number_a_file(spark, tmp_path):
    for name, text in {"a.csv": "\n  \nx,y\n1,2\nx,y\n", "b.csv": "y,x\n3,4\n", "c.csv": "\n"}.items():
        (tmp_path / name).write_text(text)
    found = delimited.first_lines(delimited.numbered(spark, str(tmp_path)))
    assert sorted(r[delimited.LINE] for r in found.collect()) == ["x,y", "y,x"]
    assert {r["file"].rsplit("/", 1)[1] for r in found.collect()} == {"a.csv", "b.csv"}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
