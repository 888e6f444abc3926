"""Records of delimited text files: a header for every file, taken away by its place, and quoted line breaks found block by block.

A file is read in the blocks that Spark cuts it into, by as many tasks. Its header is its first record, wherever else the
same text stands. Files with the same header are parsed together by its names, so files may order their columns differently.

With ``multiline`` a record may hold line breaks inside quotes. Whether a line starts a record depends on the number of quotes before it in the file. Every
block counts its quotes and, for either way it may begin, the records that start in it; a prefix sum over the blocks of
each file (one row a block) then tells how each really begins and the number of its first record. Records of one line are parsed where they
are read; only the lines of longer ones are shuffled, by file and record number.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import shared_folder

#: Records of more lines are rejected line by line: most likely a quote is missing, and no task should hold the rest of a file.
MAX_LINES = 10_000
#: Headers that the files of one table may have.
MAX_HEADERS = 100
LINE = "__line"


@dataclass(frozen=True)
class Header:
    """Column names as they stand, and the files that begin with them (None: all)."""

    names: tuple[str, ...]
    files: tuple[str, ...] | None


def numbered(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All lines with ``id`` (rising inside a block), ``file`` and ``block`` (its offset in the file)."""
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    return lines.select(
        F.monotonically_increasing_id().alias("id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias(LINE)
    )


def names_of(header: str, sep: str) -> tuple[str, ...]:
    """The names of a header record; empty ones and repeated ones are told apart by their place."""
    cells = next(csv.reader([header.lstrip("﻿")], delimiter=sep, strict=False), [])
    seen: set[str] = set()
    names = []
    for i, cell in enumerate(cells):
        name = cell.strip().lstrip("﻿").strip() or f"_c{i}"
        if name.lower() in seen:
            name = f"{name}{i}"
        seen.add(name.lower())
        names.append(name)
    return tuple(names)


def headers(spark: SparkSession, first: DataFrame, sep: str) -> list[Header]:
    """The headers of a table of ``file`` and first record. Files with other names than the rest are an error."""
    kinds = first.groupBy(LINE).agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file")).orderBy(F.desc("n"), LINE).limit(MAX_HEADERS + 1).collect()
    if len(kinds) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers")
    found = [(names_of(k[LINE], sep), k) for k in kinds]
    for names, k in found[1:]:
        if set(names) != set(found[0][0]):
            raise ValueError(f"differing columns: {list(names)} in {k['file']}, {list(found[0][0])} in {found[0][1]['file']}")
    if len(found) <= 1:
        return [Header(names, None) for names, _ in found]
    # file names, as the reader itself holds them
    files = {k[LINE]: tuple(r["file"] for r in first.where(F.col(LINE) == k[LINE]).select("file").toLocalIterator()) for _, k in found}
    return [Header(names, tuple(sorted(unquote(f) for f in files[k[LINE]]))) for names, k in found]


def first_lines(lines: DataFrame) -> DataFrame:
    """The first line of every file that is not blank.

    Its number is found first, by an aggregation that holds one number a file: kept along with the text, all lines of a file's first block would be sorted.
    """
    start = lines.where((F.col("block") == 0) & (F.trim(LINE) != ""))
    found = start.groupBy("file").agg(F.min("id").alias("id"))
    return start.join(F.broadcast(found), ["file", "id"]).select("file", LINE)  # one row a file


def plain(spark: SparkSession, path: str | Sequence[str], sep: str, header: bool) -> list[tuple[Header | None, DataFrame]]:
    """Lines (``id`` and text) of every group of files with the same header, without that header and blank lines."""
    if not header:
        return [(None, numbered(spark, path).where(F.trim(LINE) != "").select("id", LINE))]
    found = []
    first = first_lines(numbered(spark, path))
    for kind in headers(spark, first, sep):
        lines = numbered(spark, path if kind.files is None else kind.files).where(F.trim(LINE) != "")
        # only lines of a file's first block that read like a header are ordered: the first is the header, others are rows
        alike = F.coalesce(F.col(LINE).isin(*header_texts(first, kind, sep)) & (F.col("block") == 0), F.lit(False))
        place = F.row_number().over(Window.partitionBy("file").orderBy("id"))
        rows = lines.where(alike).withColumn("__place", place).where("__place > 1").select("id", LINE)
        found.append((kind, lines.where(~alike).select("id", LINE).union(rows)))
    return found


def header_texts(first: DataFrame, kind: Header, sep: str) -> list[str]:
    return [r[LINE] for r in first.select(LINE).distinct().limit(MAX_HEADERS).collect() if names_of(r[LINE], sep) == kind.names]


BLOCKS = "file string, block bigint, quotes bigint, starts_even bigint, starts_odd bigint"
LINES = f"id bigint, file string, block bigint, {LINE} string, inside int, odd int, even_start bigint, odd_start bigint"


def counter():
    """The function that workers count with, by value: they need not have this package."""

    def counted(batches):
        """Each stretch of lines of one block, with running counts: quotes before the line, in it, and records started so far for either beginning."""
        file, block, quotes, starts = None, -1, 0, [0, 0]
        for batch in batches:
            files, offsets = batch.column(1).dictionary_encode().indices.to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(offsets) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                now = part.column(1)[0].as_py(), int(offsets[a])
                if now != (file, block):
                    (file, block), quotes, starts = now, 0, [0, 0]
                own = pc.count_substring(part.column(3), '"').to_numpy(zero_copy_only=False).astype(np.int64)
                before = quotes + np.cumsum(own) - own
                filled = pc.not_equal(pc.utf8_trim(part.column(3), " "), "").to_numpy(zero_copy_only=False)
                even, odd = starts[0] + np.cumsum((before % 2 == 0) & filled), starts[1] + np.cumsum((before % 2 == 1) & filled)
                quotes, starts = quotes + int(own.sum()), [int(even[-1]), int(odd[-1])]
                yield part, file, block, {"inside": before % 2, "odd": own % 2, "even_start": even, "odd_start": odd, "quotes": before + own}

    return counted


def block_table(lines: DataFrame) -> DataFrame:
    """How every block begins: ``begins`` (1: inside quotes) and ``base``, the records that start before it in its file."""
    stretches = counter()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_block = None
        done = []
        for _, file, block, counts in stretches(batches):
            if open_block is not None and open_block[:2] != (file, block):
                done.append(open_block)
            open_block = (file, block, int(counts["quotes"][-1]), int(counts["even_start"][-1]), int(counts["odd_start"][-1]))
        if open_block is not None:
            done.append(open_block)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "block", "quotes", "starts_even", "starts_odd"])

    spark = lines.sparkSession
    folder = shared_folder(spark, "blocks")
    lines.mapInArrow(run, BLOCKS).write.parquet(folder)  # stored: small, and its size is known to the join
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = spark.read.parquet(folder).withColumn("begins", F.coalesce(F.sum("quotes").over(order), F.lit(0)) % 2)
    starts = F.when(F.col("begins") == 0, F.col("starts_even")).otherwise(F.col("starts_odd"))
    return blocks.withColumn("base", F.coalesce(F.sum(starts).over(order), F.lit(0))).select("file", "block", "begins", "base")


def whole_records(spark: SparkSession, path: str | Sequence[str], max_lines: int = MAX_LINES) -> tuple[DataFrame, DataFrame]:
    """(records, lines of records with too many lines); records have ``id``, ``file``, ``place`` (their number in the file) and text."""
    lines = numbered(spark, path)
    stretches = counter()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _, counts in stretches(batches):
            more = [pa.array(counts["inside"], pa.int32()), pa.array(counts["odd"], pa.int32()), pa.array(counts["even_start"], pa.int64()), pa.array(counts["odd_start"], pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns, *more], names=["id", "file", "block", "__line", "inside", "odd", "even_start", "odd_start"])

    placed = lines.mapInArrow(run, LINES).join(block_table(lines), ["file", "block"])
    inside = (F.col("inside") + F.col("begins")) % 2 == 1
    place = F.col("base") + F.when(F.col("begins") == 0, F.col("even_start")).otherwise(F.col("odd_start")) - 1
    placed = placed.select("id", "file", "block", LINE, place.alias("place"), inside.alias("inside"), (F.col("odd") == 1).alias("odd"))
    placed = placed.where("inside OR trim(__line) <> ''")
    single = placed.where("NOT inside AND NOT odd").select("id", "file", "place", LINE)
    parts = placed.where("inside OR odd")
    sizes = parts.groupBy("file", "place").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > max_lines).select("file", "place")
    fits = parts.join(large, ["file", "place"], "left_anti")
    ordered = F.sort_array(F.collect_list(F.struct("block", "id", F.col(LINE).alias("text"))))
    joined = fits.groupBy("file", "place").agg(ordered.alias("p"))
    text = F.array_join(F.transform("p", lambda p: F.coalesce(p["text"], F.lit(""))), "\n")
    longer = joined.select(F.col("p")[0]["id"].alias("id"), "file", "place", text.alias(LINE))
    return single.union(longer), parts.join(large, ["file", "place"], "left_semi").select("id", LINE)


def multiline(spark: SparkSession, path: str | Sequence[str], sep: str, header: bool) -> tuple[list[tuple[Header | None, DataFrame]], DataFrame]:
    """Records by header, as ``plain``, and the lines of records that are too long."""
    records, lost = whole_records(spark, path)
    if not header:
        return [(None, records.select("id", LINE))], lost.select("id", LINE)
    found = []
    first = records.where("place = 0").select("file", LINE)
    for kind in headers(spark, first, sep):
        rows = records if kind.files is None else whole_records(spark, kind.files)[0]
        found.append((kind, rows.where("place > 0").select("id", LINE)))
    return found, lost.select("id", LINE)
