"""Runs of repeating words: stretches of a text that go on with one smallest period.

The periods fall into octaves (1 to 7, 8 to 15, 16 to 31, ...). For every octave the text is cut at boundaries a step apart that is
no longer than any stretch of matches of that octave, so each stretch touches one. The tile of a boundary holds the words a step
to its left and a step and a period to its right; tiles of neighbouring boundaries overlap and are dealt out together in blocks of bounded size, by text,
octave and place, whatever text they come from. A task solves each tile by itself: two Z-functions, to the right and (reversed) to the
left of the boundary, give for every period of the octave how far the words match those a period later. These fragments are
shuffled by text and period and stitched where they touch. Stretches that reach the least length are runs; of those with the same ends the
smallest period is the run's.

A stretch of matches holds at least 6 words that occur again a period later as the same 6 words, so only tiles with enough such words in a row are
dealt out. Texts without any are done in place, and only the others meet their runs again by a join, for which the texts are known by a digest of id and words.

Words are runs of anything but ASCII white space. Defined results: null and empty texts have no words, no runs and the
empty collapsed text; a text of any length is cut into blocks of ``BLOCK_WORDS`` (one tile, at most four periods, where that
is more) that many tasks solve; repeated rows each keep their row and are solved once; a null id is an id like any other; other columns stay, those
called like an output column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import map_columns, ship, stored

#: Runs have at least so many words, and two periods.
LEAST_WORDS = 12
#: Words that match in a row in any run: the least length less one period, or one period.
GRAM = LEAST_WORDS // 2
#: The first octave ends below this period.
FIRST_OCTAVE = 8
BLOCK_WORDS = 1 << 15
#: Fixed odd constant of the gram hash.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

Edit = Callable[[list[bytes], object], list[bytes]]
OUTS = ["n_words", "runs", "collapsed"]
RUN = "struct<start: bigint, length: bigint, period: bigint>"
TILES = "key binary, low int, first bigint, boundaries int, offset bigint, codes array<int>"
FRAGMENTS = "key binary, period bigint, start bigint, stop bigint"


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """Lowest period, the one behind the highest, and the step of every octave of a text of ``n`` words."""
    low, high, step = 1, FIRST_OCTAVE, GRAM
    while low <= n // 2:
        yield low, min(high, n // 2 + 1), step
        low, step, high = high, high, 2 * high


def codes(words: list[bytes]) -> np.ndarray:
    """A number for every distinct word."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def next_places(numbers: np.ndarray) -> np.ndarray | None:
    """Distance from every gram to the next one like it (by hash, so at times to one that only looks alike); None without any."""
    count = len(numbers) - GRAM + 1
    if count < 2:
        return None
    hashes = np.zeros(count, dtype=np.uint64)
    mixed = (numbers.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    mixed ^= mixed >> np.uint64(29)
    for j in range(GRAM):
        hashes = hashes * MULTIPLIER + mixed[j : j + count]
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    if not len(same):
        return None
    distances = np.full(count, len(numbers), dtype=np.int64)
    distances[order[same]] = order[same + 1] - order[same]
    return distances


def boundaries(distances: np.ndarray, n: int, high: int, step: int) -> np.ndarray:
    """The boundaries of an octave whose tiles can hold a fragment: enough grams in a row that occur again within the octave."""
    need = max(step - GRAM + 1, 1)
    near = np.concatenate([[False], distances < high, [False]])
    edges = np.flatnonzero(near[1:] != near[:-1])
    starts, stops = edges[::2], edges[1::2]
    long = stops - starts >= need
    first = np.maximum(-(-(starts[long] + need - step) // step), 0)
    last = np.minimum((stops[long] + step - need) // step, n // step)
    if not len(first):
        return first
    marks = np.zeros(n // step + 2, dtype=np.int64)
    np.add.at(marks, first, 1)
    np.add.at(marks, np.maximum(last + 1, first), -1)
    return np.flatnonzero(np.cumsum(marks)[:-1] > 0) * step


def blocks(numbers: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(lowest period, first boundary, number of boundaries, offset, words) of the blocks of tiles a text has to solve."""
    n = len(numbers)
    distances = next_places(numbers) if n >= LEAST_WORDS else None
    if distances is None:
        return
    for low, high, step in octaves(n):
        found = boundaries(distances, n, high, step)
        if not len(found):
            continue
        most = max(BLOCK_WORDS // step, 1)
        for part in np.split(found, np.flatnonzero(np.diff(found) > step) + 1):
            for i in range(0, len(part), most):
                first, last = int(part[i]), int(part[min(i + most, len(part)) - 1])
                offset = max(first - step, 0)
                yield low, first, (last - first) // step + 1, offset, numbers[offset : last + step + high]


def z_lengths(pattern: list[int], text: list[int]) -> list[int]:
    """How far the pattern matches the text from each of its places (the Z-function of both, one behind the other)."""
    whole = [*pattern, -1, *text, -2]
    lengths = [0] * len(whole)
    left = right = 0
    for i in range(1, len(whole) - 1):
        k = 0
        if i < right:
            k = lengths[i - left]
            if k < right - i:
                lengths[i] = k
                continue
            k = right - i
        while whole[k] == whole[i + k]:
            k += 1
        lengths[i] = k
        left, right = i, i + k
    return lengths[len(pattern) + 1 : -1]


def solve(low: int, first: int, count: int, offset: int, words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(period, start, stop) of the matches around the boundaries of a block; what touches is joined.

    A match at i says that word i is word i + period. Matches reach at most a step from a boundary; shorter ones than a step are
    another boundary's, or none of a run.
    """
    high, step = (FIRST_OCTAVE, GRAM) if low == 1 else (2 * low, low)
    size = len(words)
    open_at: dict[int, list[int]] = {}
    for boundary in range(first, first + count * step, step):
        at = boundary - offset
        top = min(high, size - at + 1)  # periods from here on leave the words
        if top <= low:
            continue
        ahead = z_lengths(words[at : at + step], words[at + low : at + top - 1 + step])
        behind = words[max(at - step, 0) : at][::-1]
        back = z_lengths(behind, words[max(at + low - step, 0) : at + top - 1][::-1])
        for period in range(low, top):
            right = ahead[period - low] if period - low < len(ahead) else 0
            left = back[top - 1 - period] if behind else 0
            if left + right < step:
                continue
            start, stop = boundary - left, boundary + right
            now = open_at.get(period)
            if now is None:
                open_at[period] = [start, stop]
            elif start <= now[1]:
                now[1] = max(now[1], stop)
            else:
                yield period, now[0], now[1]
                open_at[period] = [start, stop]
    for period, (start, stop) in open_at.items():
        yield period, start, stop


def read_words(column: pa.Array, edit: Edit | None) -> Iterator[tuple[object, list[bytes]]]:
    """Id and words of each row of a struct of id and text."""
    ids, texts = column.field(0).to_pylist(), column.field(1).cast(pa.binary())
    for key, text in zip(ids, texts):
        words = (text.as_py() or b"").split()
        yield key, (edit(words, key) if edit is not None and words else words)


def digest(key: object, words: list[bytes]) -> bytes:
    return hashlib.blake2b(repr(key).encode() + b"\n" + b" ".join(words), digest_size=16).digest()


def tiles(rows: DataFrame, edit: Edit | None) -> DataFrame:
    """Blocks of tiles of all texts of the struct column ``pair``, dealt out by text, octave and place; equal ones once."""
    names = [c.split()[0] for c in TILES.split(", ")]
    kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for key, words in read_words(batch.column(0), edit):
                if len(words) < LEAST_WORDS:
                    continue
                known = None
                for low, first, count, offset, part in blocks(codes(words)):
                    known = known or digest(key, words)
                    out.append((known, low, first, count, offset, part.astype(np.int32)))
                    held += len(part)
                    if held > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.select("pair").mapInArrow(run, TILES).dropDuplicates(["key", "low", "first"])


def fragments(blocks_of_tiles: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lows, firsts, counts, offsets = (batch.column(i).to_pylist() for i in range(5))
            out: list[tuple] = []
            for i, key in enumerate(keys):
                words = batch.column(5)[i].values.to_pylist()
                out += [(key, *found) for found in solve(lows[i], firsts[i], counts[i], offsets[i], words)]
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out), [pa.binary(), pa.int64(), pa.int64(), pa.int64()])]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "period", "start", "stop"])

    return blocks_of_tiles.mapInArrow(run, FRAGMENTS)


def stitched(found: DataFrame) -> DataFrame:
    """Runs of each text, ordered by start and period, from fragments of matches."""
    order = Window.partitionBy("key", "period").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
    marked = marked.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = marked.groupBy("key", "period", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    whole = whole.select("key", "start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"), "period")
    long = whole.where((F.col("length") >= LEAST_WORDS) & (F.col("length") >= 2 * F.col("period")))
    least = long.groupBy("key", "start", "length").agg(F.min("period").alias("period"))
    listed = least.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    return listed.select("key", F.expr("transform(runs, r -> named_struct('start', r.start, 'length', r.length, 'period', r.period))").alias("runs"))


def collapse(words: list[bytes], runs: list[dict] | None) -> list[bytes]:
    """The words that no run repeats: of each run its first period stays, unless another run repeats that."""
    if not runs:
        return words
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    for run in runs:
        marks[run["start"] + run["period"]] += 1
        marks[run["start"] + run["length"]] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(marks)[:-1] == 0).tolist()]


def joined(lists: list[list[bytes]]) -> pa.Array:
    return pa.array([b" ".join(w) for w in lists], pa.binary()).cast(pa.string())


def find(docs: DataFrame, id_column: str = "doc_id", text: str = "text", edit: Edit | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period, by start and period) and ``collapsed`` (the text without repeated words).

    ``edit`` may change the words of a text, given its id. The stretches found are stored once; the texts are read twice more, those
    with and those without candidates apart, so that only the former are shuffled.
    """
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c not in OUTS]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.struct(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text")).alias("measurekit_pair"))
    found = stored(stitched(fragments(tiles(rows.select(F.col("measurekit_pair").alias("pair")), edit))))

    def mark():
        def work(column: pa.Array) -> list[pa.Array]:
            counts, keys, lists = [], [], []
            for key, words in read_words(column, edit):
                counts.append(len(words))
                lists.append(words)
                some = len(words) >= LEAST_WORDS and next(blocks(codes(words)), None) is not None
                keys.append(digest(key, words) if some else None)
            return [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), joined(lists)]

        return work

    marked = map_columns(rows, "measurekit_pair", {"n_words": "bigint", "measurekit_key": "binary", "collapsed": "string"}, mark, keep=kept)
    names = [F.col(f"`{c}`") for c in [*kept, "n_words"]]
    plain = marked.where("measurekit_key IS NULL").select(*names, F.expr(f"CAST(array() AS array<{RUN}>)").alias("runs"), "collapsed")
    # one small row a text on the right: a hash table a task, and the texts need no sort
    known = found.select(F.col("key").alias("measurekit_key"), F.col("runs").alias("measurekit_runs")).hint("shuffle_hash")
    other = marked.where("measurekit_key IS NOT NULL").join(known, "measurekit_key", "left")
    other = other.withColumn("measurekit_pair", F.struct("collapsed", "measurekit_runs"))

    def shorten():
        def work(column: pa.Array) -> list[pa.Array]:
            texts, runs = column.field(0).cast(pa.binary()).to_pylist(), column.field(1).to_pylist()
            return [joined([collapse(t.split(), r) for t, r in zip(texts, runs)])]

        return work

    other = map_columns(other, "measurekit_pair", {"collapsed": "string"}, shorten, keep=[*kept, "n_words", "measurekit_runs"])
    runs = F.expr(f"coalesce(measurekit_runs, CAST(array() AS array<{RUN}>))").alias("runs")
    return plain.union(other.select(*names, runs, "collapsed"))
