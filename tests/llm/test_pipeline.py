"""The registered queries against SQL, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from measurekit.llm import quality, queries
from tests.llm.test_near_duplicates import brute as groups_of, gram_set, roots as roots_of
from tests.llm.test_pages_and_talks import brute as windows_of

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    result = connection.execute(queries.ORACLE[name])
    columns = sorted(d[0] for d in result.description)
    expected = sorted(str([row[[d[0] for d in result.description].index(c)] for c in columns]) for row in result.fetchall())
    frame = queries.QUERIES[name](spark, FOLDER)
    assert sorted(frame.columns) == columns
    assert sorted(str([row[c] for c in columns]) for row in frame.collect()) == expected


def test_entry_registers_all_operators():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE) <= set(contract.oracle_sql())


def test_near_duplicate_queries_equal_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    sizes, roots = groups_of([t for _, t in docs])
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.QUERIES["op3_ngram_join"](spark, FOLDER).collect()}
    assert found == {docs[i][0]: (sizes[i], docs[roots[i]][0]) for i in range(len(docs))}


def test_token_queries_agree_with_the_library(spark):
    import hashlib
    import zlib

    import numpy as np

    library = Tokenizer.from_file(queries.vocabulary_path())
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    one = {r["doc_id"]: r for r in queries.QUERIES["op1_bpe"](spark, FOLDER).collect()}
    six = {r["doc_id"]: r for r in queries.QUERIES["op6_token_file"](spark, FOLDER).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    at = 0
    for doc, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (one[doc]["n_tokens"], one[doc]["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
        assert one[doc]["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))
        ids.append(1)
        assert (six[doc]["start"], six[doc]["n_tokens"], six[doc]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # rows that nothing is known about, and repeated ones
    odd = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "123 456", None, "s", 7), (None, "the and of that with is", "en", "s", 20)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(3))
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k == 4:
            break
        after = [tuple(r) for r in docs.collect()]
        assert docs.columns == columns and set(after) <= set(before), name
        gone = [r for r in before if r not in set(after)]
        if k == 0:
            assert 0 < len(gone) < 0.35 * len(before)
        if k == 1:
            assert {r[0] for r in gone} <= {9001, 9002, 9003}
        if k == 2:
            named = sorted({r[0]: r for r in before if r[0] is not None}.items())
            _, roots = groups_of([r[1] for _, r in named])
            assert sorted(r[0] for r in after if r[0] is not None) == [named[i][0] for i in range(len(named)) if roots[i] == i]
            assert len([r for r in after if r[0] is None]) == len([r for r in before if r[0] is None])
        if k == 3:
            clean = [r[0] for r in windows_of([(r[0], r[1]) for r in before], benchmark) if not r[4]]
            assert sorted(map(str, clean)) == sorted(str(r[0]) for r in after)
    library = Tokenizer.from_file(queries.vocabulary_path())
    texts = {r[0]: r[1] for r in after}
    rows = docs.collect()
    assert len(rows) == len(after)
    for row in rows[:40]:
        assert row["ids"] == library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids and row["n_tokens"] == len(row["ids"])


def near_copies_of(texts, n, percent):
    sets = [gram_set(t, n) for t in texts]
    close = lambda a, b: a and 100 * len(a & b) >= percent * len(a | b)
    return roots_of(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if close(sets[i], sets[j])])


def test_near_duplicate_stage_takes_five_words_and_eighty_percent(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words))]
    for k in range(1, 8):  # k words of the first text exchanged, far from each other
        rows.append((k + 1, " ".join(f"x{k}" if i % 20 == 10 and i // 20 < k else w for i, w in enumerate(words))))
    expected = near_copies_of([t for _, t in rows], 5, 80)
    assert expected != near_copies_of([t for _, t in rows], 4, 85)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"] for r in corpus_pipeline.first_of_group(spark, docs, FOLDER).collect()}
    assert found == {rows[i][0] for i in range(len(rows)) if expected[i] == i}


def test_quality_stage_keeps_documents_labelled_good(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r["doc_id"] for r in corpus_pipeline.good_quality(spark, docs, FOLDER).select("doc_id").collect()}
    good = [r["doc_id"] for r in labels.where("quality = 1").collect()]
    assert sum(d in kept for d in good) > 0.95 * len(good)
    assert quality.fit(docs, labels.limit(0)).share == 0.5


def test_stages_that_learned_nothing_keep_all(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, "one two three", None, "s", 13), (2, "", None, "s", 0), (3, None, None, "s", None)], schema)
    spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for stage in (corpus_pipeline.good_quality, corpus_pipeline.one_language):
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == docs.columns and sorted(r["doc_id"] for r in found.collect()) == [1, 2, 3]


def test_near_duplicate_stage_decides_on_rows(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, one), (1, two), (1, two), (2, one + " more"), (None, two + " more"), (None, three), (None, three + " more"), (5, three), (4, None), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = [(r["doc_id"], r["text"]) for r in corpus_pipeline.first_of_group(spark, docs, FOLDER).collect()]
    assert sorted(found, key=str) == sorted([(1, one), (1, two), (5, three), (4, None), (None, None), (None, None)], key=str)


def tables(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_run_on_a_table_with_more_columns(spark, tmp_path):
    """Columns called like outputs of the operators, and one that has no order, come through all filtering stages."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(120)
    more = docs.selectExpr("doc_id AS score", "concat('t', doc_id) AS component_id", "text", "doc_id", "lang", "map('k', doc_id) AS n_hit", "lang AS lang_pred", "n_chars AS row", "source AS contaminated", "1 AS ids")
    folder = tables(spark, tmp_path, more)
    kept = {tuple(map(str, r)) for r in more.collect()}
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, now, folder).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert now.columns == more.columns and {tuple(map(str, r)) for r in now.collect()} <= kept
    ended = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in ended.collect()} == {r["doc_id"] for r in now.collect()} and ended.columns[0] == "doc_id"


def test_run_on_empty_and_narrow_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    (tmp_path / "a").mkdir()
    assert corpus_pipeline.run(spark, tables(spark, tmp_path / "a", docs.limit(0))).collect() == []
    (tmp_path / "b").mkdir()
    narrow = corpus_pipeline.run(spark, tables(spark, tmp_path / "b", docs.select("text", "doc_id").limit(40))).collect()
    assert 0 < len(narrow) <= 40 and all(r["n_tokens"] == len(r["ids"]) for r in narrow)
