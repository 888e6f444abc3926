"""Headers by file and place, and quoted line breaks across blocks, against the csv module."""

from __future__ import annotations

import csv
import io
import random

import pytest

from measurekit.sources import delimited, records


@pytest.fixture
def blocks(spark):
    """Blocks of so many bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    old = {k: spark.conf.get(k) for k in keys}

    def make(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield make
    for k, v in old.items():
        spark.conf.set(k, v)


def folder(tmp_path, **texts):
    path = tmp_path / "table"
    path.mkdir()
    for name, text in texts.items():
        (path / f"{name}.csv").write_text(text, newline="")
    return str(path)


def test_a_row_like_the_header_stays(spark, write):
    rows, rejected = records.read_text_table(spark, write("name\nA\nname\nB\nname\n"), ["name"])
    assert [r["name"] for r in rows.orderBy("_rid").collect()] == ["A", "name", "B", "name"] and rejected.isEmpty()


def test_every_file_has_its_own_order(spark, tmp_path):
    path = folder(tmp_path, a="name,domain\nAa,ML\ndomain,name\n", b="domain,name\nWeb,Be\nname,domain\n", c="\n\nname,domain\nCe,ML\n", d="")
    for multiline in (False, True):
        rows, rejected = records.read_text_table(spark, path, ["name", "domain"], multiline=multiline)
        assert sorted((r["name"], r["domain"]) for r in rows.collect()) == [("Aa", "ML"), ("Be", "Web"), ("Ce", "ML"), ("domain", "name"), ("domain", "name")]
        assert rejected.isEmpty() and rows.select("_rid").distinct().count() == 5


def test_other_names_are_an_error(spark, tmp_path):
    path = folder(tmp_path, a="name,domain\nAa,ML\n", b="name,task\nBe,T\n")
    with pytest.raises(ValueError, match="differing columns"):
        records.read_text_table(spark, path, ["name"])
    with pytest.raises(ValueError, match="missing columns"):
        records.read_text_table(spark, folder(tmp_path / "x", a="") if (tmp_path / "x").mkdir() is None else "", ["name"])


def test_file_names_with_blanks(spark, tmp_path):
    path = folder(tmp_path, **{"one file": "a,b\n1,2\n", "50% é+x": "b,a\n4,3\n"})
    rows, _ = records.read_text_table(spark, path, ["a", "b"])
    assert sorted((r["a"], r["b"]) for r in rows.collect()) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("size", [64, 500, 100_000])
def test_line_breaks_across_blocks(spark, tmp_path, blocks, size):
    rng = random.Random(size)
    want, texts = [], {}
    for name in "abc":
        order = rng.sample(["key", "text", "more"], 3)
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(order)
        for i in range(40):
            row = {"key": f"{name}{i}", "text": "".join(rng.choice(['"', "\n", ",", "x", "yy", "\n\n", " z "]) for _ in range(rng.randrange(9))), "more": "key,text,more\n" * rng.randrange(2)}
            writer.writerow([row[c] for c in order])
            want.append((row["key"], row["text"].strip(), row["more"].strip()))
        texts[name] = out.getvalue()
    blocks(size)
    path = folder(tmp_path, **texts)
    rows, rejected = records.read_text_table(spark, path, ["key", "text", "more"], null_tokens=("",), multiline=True)
    got = sorted((r["key"], (r["text"] or "").strip(), (r["more"] or "").strip()) for r in rows.collect())
    assert got == sorted(want) and rejected.isEmpty()
    if size == 64:
        assert delimited.numbered(spark, path).select("file", "block").distinct().count() > 40


def test_records_in_order_of_the_file(spark, write, blocks):
    blocks(10)
    rows, _ = records.read_text_table(spark, write('k,v\n1,"a\n\nb"\n\n2,c\n3,"d\n"\n'), ["k", "v"], multiline=True)
    assert [(r["k"], r["v"]) for r in rows.orderBy("k").collect()] == [("1", "a\n\nb"), ("2", "c"), ("3", "d\n")]


def test_a_lost_quote_is_no_unbounded_record(spark, tmp_path):
    path = folder(tmp_path, a='k,v\n1,a\n2,"open\n' + "".join(f"{i},x\n" for i in range(50)))
    whole, lost = delimited.whole_records(spark, path, max_lines=20)
    assert whole.count() == 2 and lost.count() == 51
    whole, lost = delimited.whole_records(spark, path, max_lines=51)
    assert whole.count() == 3 and lost.isEmpty()


def test_without_header_and_plain_reading(spark, tmp_path):
    path = folder(tmp_path, a='1,"a ""b"""\n2\n3,c,d\n', b='4," e "\n')
    rows, rejected = records.read_text_table(spark, path, ["k", "v"], null_tokens=(), strict_width=True, header=False)
    assert sorted((r["k"], r["v"]) for r in rows.collect()) == [("1", 'a "b"'), ("4", "e")]
    assert sorted(r["line"] for r in rejected.collect()) == ["2", "3,c,d"]
    plain = records.read_plain(spark, folder(tmp_path / "y", a="k,,k\n1, x ,\n2\n") if (tmp_path / "y").mkdir() is None else "")
    assert plain.columns == ["k", "_c1", "k2"] and sorted(map(tuple, plain.collect())) == [("1", " x ", None), ("2", None, None)]
