"""Ops 1 and 6: ids against the tokenizers library, round trips of the bit-packed files."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from measurekit.llm import bpe, token_file

EDGES = [
    None, "", "   ", "it's we'll 42 a-b", "a" * 3000, "$" * 5000 + "x", "Ünïcödé ǅ İstanbul ΣΊΣΥΦΟΣ ﬁ", "日本語 テキスト 😀👍🏽", "<|endoftext|> end <|startoftext|>x",
    "tab\tnew\nline\x1c\x85 sp", "same", "same", "<|not special|>",
]


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


def test_ids_and_decoding_equal_the_library(spark, docs, vocabulary, library):
    frame = docs(EDGES).withColumnRenamed("source", "ids")  # a clashing name is replaced
    rows = bpe.decode(bpe.encode(frame, vocabulary), vocabulary).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == list(range(len(EDGES)))
    for row, text in zip(rows, EDGES):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert row["ids"] == expected
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False)
    both = bpe.round_trip(frame, vocabulary).orderBy("doc_id").collect()
    assert [(r["ids"], r["decoded"]) for r in both] == [(r["ids"], r["decoded"]) for r in rows]


def test_empty_table_and_foreign_ids(spark, docs, vocabulary):
    assert bpe.encode(docs([]), vocabulary).collect() == []
    odd = spark.createDataFrame([([49406, 99999, -1, 320],), (None,)], "ids array<int>")
    assert {r["decoded"] for r in bpe.decode(odd, vocabulary).collect()} == {"<|startoftext|> a</w>", ""}


def test_random_words_equal_the_library(vocabulary, library):
    encoder, rng = bpe.Encoder(vocabulary), random.Random(5)
    for _ in range(150):
        text = "".join(rng.choice("aeinorstlh") for _ in range(rng.randint(1, 120))) + rng.choice(["", "'s", "!!", "é7"])
        assert np.frombuffer(encoder.encode([text])[0], "<i4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(text):
    from measurekit.llm.queries import vocabulary_path

    kept = test_any_text_equals_the_library.__dict__.setdefault("kept", [])
    if not kept:
        path = vocabulary_path()
        kept += [Tokenizer.from_file(path), bpe.Encoder(path), token_file.WordEncoder(path)]
    expected = kept[0].encode(text, add_special_tokens=False).ids
    assert np.frombuffer(kept[1].encode([text])[0], "<i4").tolist() == expected
    assert np.frombuffer(kept[2].encode(text), "<i4").tolist() == expected


def test_encoder_survives_full_caches(vocabulary, monkeypatch):
    fresh = bpe.Encoder(vocabulary)
    texts = ["some words here", "other words there", "some words here"]
    expected = fresh.encode(texts)
    monkeypatch.setattr(bpe, "WORD_CACHE", 1)
    monkeypatch.setattr(bpe, "PAIR_CACHE", 2)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 1)
    assert bpe.Encoder(vocabulary).encode(texts) == expected


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 5003).astype(np.uint32)
    packed = token_file.pack(ids, bits)
    assert len(packed) == -(-5003 * bits // 8)
    assert (token_file.unpack(packed, bits, 13, 4000) == ids[13:4013]).all()


def test_files_hold_all_documents_in_order(spark, vocabulary, library, monkeypatch):
    rows = [(i, t, 1) for i, t in enumerate(EDGES)] + [(3, "again three", 2), (None, "no id", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(4)
    archive = token_file.write(frame, vocabulary, end_id=1)
    found = token_file.read(spark, archive).collect()
    assert len(found) == len(rows)
    ordered = sorted(found, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in ordered]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    at = 0
    wanted = {}
    for i, t, _ in rows:
        wanted.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [1])
    for row in ordered:
        assert (row["start"], row["n_tokens"]) == (at, len(row["ids"]))
        assert row["ids"] in wanted[row["doc_id"]]
        at += row["n_tokens"]
    sums = {(r["start"], r["ids_crc32"]) for r in token_file.read(spark, archive, ("start", "ids_crc32")).collect()}
    assert sums == {(r["start"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in ordered}
    uri = token_file.manifest(spark, archive).first()["uri"]
    reader = token_file.Reader(uri)
    assert (reader.ids(0, reader.n_ids) == np.concatenate([reader.document(i) for i in range(reader.n_docs)])).all()


def test_random_access_across_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK_IDS", 64)
    monkeypatch.setattr(token_file, "READ_IDS", 100)
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 8000, n).astype(np.uint32) for n in (0, 5, 700, 1, 64, 333)]
    writer = token_file.Writer(f"file://{tmp_path}/x.tok", 13)
    for i, ids in enumerate(parts):
        writer.add(None if i == 3 else i, ids)
    assert writer.close() == (6, sum(map(len, parts)))
    reader = token_file.Reader(f"file://{tmp_path}/x.tok")
    for i, ids in enumerate(parts):
        assert (reader.document(i) == ids).all()
    assert (np.concatenate([ids for _, _, ids in token_file._documents(reader)]) == np.concatenate(parts)).all()
    assert (reader.ids(60, 777) == np.concatenate(parts)[60:777]).all()


def test_empty_archive_and_bad_end_id(spark, docs, vocabulary):
    assert token_file.read(spark, token_file.write(docs([]), vocabulary)).collect() == []
    with pytest.raises(Exception, match="end id"):
        token_file.write(docs(["x"]), vocabulary, end_id=1 << 20)
