"""Token ids in bit-packed files with random access.

A file holds documents in ascending id order. Every id takes ``bits`` bits, the fewest that hold the largest id of the
vocabulary. Ids are packed in blocks of ``BLOCK_IDS``; the offset of every block and the start of every
document are stored at the end, so a reader fetches any range of ids by one seek and unpacks it with
numpy. Layout, little-endian: magic (8), blocks, block offsets (u64 each), document ids (i64 each),
their validity (u8 each), document starts (u64, one more than documents), footer (six u64: bits, ids a block,
documents, ids, position of the block offsets, position of the document ids), magic (8).

Defined results: a null or empty text is the end id alone (or nothing without end id); null document ids
come first; rows with equal document ids stand in the order of a hash of their text, and all of them
are written; other columns are ignored; an empty table gives an archive without files. A task writes a
file under a fresh name and reports it in the manifest; files of lost or repeated tasks are never read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import WORD_CACHE, Splitter
from .common import fresh_folder, ship
from .storage import make_folder, place

MAGIC = b"MKTOKEN1"
BLOCK_IDS = 1 << 16
#: Ids that a reader holds at once (one document at least).
READ_IDS = 1 << 21
FOOTER = struct.Struct("<6Q")


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian bit string of ``ids``, padded to whole bytes."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, skip: int, count: int) -> np.ndarray:
    """``count`` ids of a bit string that starts ``skip`` ids before them."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=skip + count)[skip:].astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=(skip + count) * bits, bitorder="little")
    planes = planes.reshape(-1, bits)[skip:].astype(np.uint32)
    return planes @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class WordEncoder:
    """Texts to ids through the library's model; each word is encoded once while it is remembered."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.splitter = Splitter(path)
        self.model = self.splitter.library.model
        self.size = self.splitter.library.get_vocab_size(with_added_tokens=True)
        letters = {byte: letter for letter, byte in self.splitter._bytes.items()}
        self.letters = [letters[b] for b in range(256)]
        self.fixed = {t: np.array([i], dtype="<u4").tobytes() for t, i in self.splitter.special.items()}
        self.cache = dict(self.fixed)

    def word(self, word: str) -> bytes:
        spelled = word if word.isascii() and word.isprintable() else "".join(self.letters[b] for b in word.encode())
        return np.array([t.id for t in self.model.tokenize(spelled)], dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        words = self.splitter.words(text) if text else []
        cache = self.cache
        try:
            return b"".join(map(cache.__getitem__, words))
        except KeyError:
            if len(cache) > WORD_CACHE:
                cache = self.cache = dict(self.fixed)
            for word in set(words).difference(cache):
                cache[word] = self.word(word)
            return b"".join(map(cache.__getitem__, words))


class Writer:
    """One file; ids are packed and written as blocks fill up."""

    def __init__(self, uri: str, bits: int) -> None:
        system, path = place(uri)
        self.out = system.open_output_stream(path, compression=None)
        self.bits, self.pending, self.waiting = bits, [], 0
        self.offsets: list[int] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.at = self.out.write(MAGIC)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.sizes.append(len(ids))
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 16 * BLOCK_IDS:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, dtype=np.uint32)
        whole = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        for start in range(0, whole, BLOCK_IDS):
            data = pack(ids[start : min(start + BLOCK_IDS, whole)], self.bits)
            self.offsets.append(self.at)
            self.at += self.out.write(data)
        self.pending, self.waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> tuple[int, int]:
        self._flush(last=True)
        starts = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)]).astype("<u8")
        blocks_at = self.at
        self.at += self.out.write(np.array(self.offsets, dtype="<u8").tobytes())
        docs_at = self.at
        self.out.write(np.array([0 if d is None else d for d in self.docs], dtype="<i8").tobytes())
        self.out.write(np.array([d is not None for d in self.docs], dtype="u1").tobytes())
        self.out.write(starts.tobytes())
        self.out.write(FOOTER.pack(self.bits, BLOCK_IDS, len(self.docs), int(starts[-1]), blocks_at, docs_at))
        self.out.write(MAGIC)
        self.out.close()
        return len(self.docs), int(starts[-1])


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str) -> None:
        system, path = place(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self._range(size - FOOTER.size - 8, size)
        if tail[-8:] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        self.bits, self.block, self.n_docs, self.n_ids, blocks_at, docs_at = FOOTER.unpack(tail[:-8])
        self.blocks = np.frombuffer(self._range(blocks_at, docs_at), dtype="<u8")
        table = self._range(docs_at, size - FOOTER.size - 8)
        n = self.n_docs
        self.docs = np.frombuffer(table, dtype="<i8", count=n)
        self.valid = np.frombuffer(table, dtype="u1", count=n, offset=8 * n).astype(bool)
        self.starts = np.frombuffer(table, dtype="<u8", count=n + 1, offset=9 * n).astype(np.int64)

    def _range(self, begin: int, end: int) -> bytes:
        self.file.seek(begin)
        return self.file.read(end - begin)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` (exclusive) of the file."""
        if begin >= end:
            return np.zeros(0, dtype=np.uint32)
        first, last = begin // self.block, (end - 1) // self.block
        stop = int(self.blocks[last]) + ((end - last * self.block) * self.bits + 7) // 8
        # every block but the last is full, and a full block is a whole number of bytes
        return unpack(self._range(int(self.blocks[first]), stop), self.bits, begin - first * self.block, end - begin)

    def document(self, row: int) -> np.ndarray:
        return self.ids(int(self.starts[row]), int(self.starts[row + 1]))


def write(
    df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int | None = None, folder: str | None = None
) -> str:
    """Write the ids of ``df`` under ``folder`` (a fresh shared one by default) and return it.

    The rows are dealt by ranges of the document id, so that files follow one another; each task encodes
    and writes one file. ``manifest`` under the folder lists the files in order.
    """
    spark = df.sparkSession
    ship(spark)
    folder = folder or fresh_folder(spark, "tokens")
    make_folder(folder)
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    tie = F.xxhash64("text")
    ranged = rows.repartitionByRange(F.col("doc"), tie).sortWithinPartitions("doc", tie, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        if end_id is not None and not 0 <= end_id < encoder.size:
            raise ValueError("the end id is outside the vocabulary")
        end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
        uri, writer = f"{folder}/part-{uuid.uuid4().hex}.tok", None
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                writer = writer or Writer(uri, width(encoder.size))
                writer.add(doc, np.frombuffer(encoder.encode(value.as_py()) + end, dtype="<u4"))
        if writer is not None:
            n_docs, n_ids = writer.close()
            part = TaskContext.get().partitionId()
            columns = [pa.array([x]) for x in (part, uri, n_docs, n_ids)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "uri", "n_docs", "n_ids"])

    ranged.mapInArrow(run, "part long, uri string, n_docs long, n_ids long").write.parquet(f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order with ``base``, the ids of all files before. One row a file, so one window over it is small."""
    files = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _documents(reader: Reader) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of documents of about ``READ_IDS`` ids: first and last row, and their ids."""
    row = 0
    while row < reader.n_docs:
        last = int(np.searchsorted(reader.starts, reader.starts[row] + READ_IDS, side="right")) - 1
        last = min(max(last, row + 1), reader.n_docs)
        yield row, last, reader.ids(int(reader.starts[row]), int(reader.starts[last]))
        row = last


def read(spark: SparkSession, folder: str, columns: Sequence[str] = ("doc_id", "start", "n_tokens", "ids")) -> DataFrame:
    """The documents of an archive: ``doc_id, start, n_tokens`` and ``ids array<long>`` or ``ids_crc32`` as asked for."""
    ship(spark)
    kinds = {"doc_id": "long", "start": "long", "n_tokens": "long", "ids": "array<long>", "ids_crc32": "long"}
    files = manifest(spark, folder).select("uri", "base")
    tasks = max(1, spark.read.parquet(f"{folder}/manifest").count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = Reader(uri)
                for first, last, ids in _documents(reader):
                    local = reader.starts[first : last + 1] - reader.starts[first]
                    found = {
                        "doc_id": pa.array(reader.docs[first:last], mask=~reader.valid[first:last]),
                        "start": pa.array(reader.starts[first:last] + base),
                        "n_tokens": pa.array(np.diff(local)),
                    }
                    if "ids" in columns:
                        found["ids"] = pa.ListArray.from_arrays(pa.array(local.astype(np.int32)), pa.array(ids.astype(np.int64)))
                    if "ids_crc32" in columns:
                        raw = memoryview(ids.astype("<u4").tobytes())
                        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(local.tolist(), local[1:].tolist())]
                        found["ids_crc32"] = pa.array(sums, type=pa.int64())
                    yield pa.RecordBatch.from_arrays([found[c] for c in columns], names=list(columns))

    return files.repartition(tasks).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))
