"""Set-similarity join of word n-grams by a prefix tree.

1. Every text becomes the set of hashes of its word n-grams; texts with one set form a class and go on once.
2. A count sketch of fixed size finds frequent n-grams, another one the frequency of words. The global order is rare first (count band, then
   the frequencies of the words, then hash): two sets that reach the similarity share an n-gram among the first few of either, so only
   those prefixes are shuffled, and common passages stand at the end of the order. N-grams of common words, which meet by chance in large
   tables long before the first sketch tells them from the rest, stand behind those with rare words.
3. Classes that share enough prefix n-grams form candidate groups. A group's texts travel once, in blocks of bounded size; a task
   stores a block's sets in a prefix tree, frequent n-grams first, and walks the tree with each
   set of the other block. Sets with a common beginning share their overlap so far; a subtree is left as soon as the overlap and
   what remains of either side cannot reach the similarity, and when all of it is linked already.
4. Links inside blocks and groups are joined into components.

Counts decide only the order, and any order gives the same links. A set is known by 64-bit hashes of its
n-grams, so a wrong link needs many equal hashes in one pair of sets.

Defined results: null, empty and wordless texts have an empty set and no link; a text with fewer words than ``n`` has all of them as its
one n-gram; texts of any length are read whole; equal texts are linked; rows with an equal id share its component and show its
largest set; rows with a null id take no part and have null results; other columns stay, those called like an output
column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import release, ship, stored
from .components import components
from .hashing import lower_table, mix, ngram_hashes, space_classes, word_hashes

#: Counters of the sketch: 16 MB in a task, at most one byte each in the order that is handed to the tasks.
SLOTS = 1 << 22
#: Bits of the filter that spares the texts of other documents a shuffle: 2 MB, whatever the number of documents.
FILTER_BITS = 1 << 24
COUNTER_BLOCKS = 64
#: Counters of words (1 MB in the order that is handed to the tasks), and steps of a doubling of their counts.
WORD_SLOTS = 1 << 20
STEPS = 8
#: Bytes of text hashed at once (one text at least).
HASH_BYTES = 1 << 20
#: N-grams of a block of sets (one set at least), about 32 MB.
BLOCK_GRAMS = 2_000_000
#: Classes that hold an n-gram and are still compared in pairs; beyond it they hang on one of them.
SMALL_GROUP = 128
#: N-grams of a tree node.
RUN = 16


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``HASH_BYTES``."""
    start, size = 0, 0
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for i, length in enumerate(lengths):
        if i > start and size + length > HASH_BYTES:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(lengths):
        yield start, len(lengths)


def gram_sets(texts: pa.Array, n: int, counters: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of every text; the words are added to ``counters`` if given."""
    for grams, _ in weighted_sets(texts, n, None, counters):
        yield grams


def weighted_sets(texts: pa.Array, n: int, levels: np.ndarray | None, counters: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """The sorted distinct n-gram hashes of every text, and of each the sum of the ``levels`` of its words."""
    classes, lower = space_classes(), lower_table()
    for a, b in slices(texts):
        words, offsets = word_hashes(texts.slice(a, b - a), classes, lower)
        grams = ngram_hashes(words, n)
        if counters is not None:
            counters += np.bincount(slots_of(words, WORD_SLOTS), minlength=WORD_SLOTS)
        if levels is not None:
            level = levels[slots_of(words, WORD_SLOTS)].astype(np.int32)
            sums = level[: len(grams)].copy()
            for i in range(1, n):
                sums += level[i : i + len(grams)]
        for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if j - i >= n:
                found = grams[i : j - n + 1]
                if levels is None:
                    found = np.sort(found)
                    yield found[np.append(True, found[1:] != found[:-1])], None
                else:
                    order = np.argsort(found)
                    found = found[order]
                    first = np.append(True, found[1:] != found[:-1])
                    yield found[first], sums[i : j - n + 1][order[first]]
            elif j > i:
                h = words[i : i + 1] + np.uint64(j - i)
                for k in range(i + 1, j):
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + 1])
                yield h, None if levels is None else level[i:j].sum(keepdims=True)
            else:
                yield np.zeros(0, dtype=np.uint64), None if levels is None else np.zeros(0, dtype=np.int32)


def slots_of(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    return (hashes >> np.uint64(64 - (slots - 1).bit_length())).astype(np.int64)


def frequencies(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """What the order goes by: the band of every counter of n-grams and the level of every counter of words.

    A band is the rounded logarithm of a count that stands out from the mean load, 0 for the rest; a level the logarithm of a count in ``STEPS``
    of a doubling. A task counts into ``SLOTS`` small counters and ``WORD_SLOTS`` ones for words and hands them on in blocks; a block is
    summed where it meets its like. Everything is bounded by these numbers for each task, and what reaches the driver and goes back to
    the tasks by them at all.
    """
    size = SLOTS // COUNTER_BLOCKS
    blocks = COUNTER_BLOCKS + WORD_SLOTS // size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, words = np.zeros(SLOTS, dtype=np.uint32), np.zeros(WORD_SLOTS, dtype=np.int64)
        for batch in batches:
            for grams in gram_sets(batch.column(0), n, words):
                counters[slots_of(grams)] += 1  # a set hits a counter once even where its n-grams collide
        small = np.minimum(counters, 255).astype(np.uint8).tobytes() + np.minimum(words, 2**32 - 1).astype("<u4").tobytes()
        begins = [*range(0, SLOTS, size), *range(SLOTS, SLOTS + 4 * WORD_SLOTS, 4 * size), SLOTS + 4 * WORD_SLOTS]
        found = [small[a:b] for a, b in zip(begins, begins[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(range(blocks), pa.int32()), pa.array(found, pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = sums.setdefault(block, np.zeros(size, dtype=np.int64))
                found += np.frombuffer(counts.as_py(), dtype=np.uint8 if block < COUNTER_BLOCKS else "<u4")
        for block, found in sums.items():
            if block < COUNTER_BLOCKS:
                mean = found.mean()
                bands = np.where(found > mean + 6 * np.sqrt(mean) + 2, np.log2(np.maximum(found, 1)), 0).astype(np.uint8)
            else:
                bands = np.minimum(STEPS * np.log2(np.maximum(found, 1)), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bands.tobytes()], pa.binary())], names=["block", "bands"])

    parts = docs.select("text").mapInArrow(count, "block int, counts binary").repartition("block").mapInArrow(add, "block int, bands binary")
    found = np.zeros(blocks * size, dtype=np.uint8)
    for row in parts.collect():  # a byte a counter
        found[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["bands"], dtype=np.uint8)
    return found[:SLOTS], found[SLOTS:]


def ordered(grams: np.ndarray, sums: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """The set in the global order: count band, then the sum of the levels of the words, then hash."""
    place = bands[slots_of(grams)].astype(np.uint16) * np.uint16(2048) + np.minimum(sums, 2047).astype(np.uint16)
    return grams[np.argsort(place, kind="stable")]


class Tree:
    """Prefix tree of sets, a node holding up to ``RUN`` n-grams (as codes in tree order); walked by levels."""

    def __init__(self, sets: list[np.ndarray], groups: np.ndarray | None = None) -> None:
        index: dict[tuple, int] = {}
        runs: list[np.ndarray] = []
        parents: list[int] = []
        depths: list[int] = []
        self.ends = np.full(len(sets), -1, dtype=np.int64)
        for row, codes in enumerate(sets):
            node = -1
            for at in range(0, len(codes), RUN):
                run = codes[at : at + RUN]
                key = (node, run.tobytes())
                child = index.get(key)
                if child is None:
                    child = index[key] = len(runs)
                    runs.append(run)
                    parents.append(node)
                    depths.append(at + len(run))
                node = child
            self.ends[row] = node
        size = len(runs)
        self.parents, self.depths = np.array(parents, dtype=np.int64), np.array(depths, dtype=np.int64)
        self.lengths = np.array([len(r) for r in runs], dtype=np.int64)
        self.codes = np.concatenate(runs) if runs else np.zeros(0, dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.int64)
        self.last = self.codes[self.begins + self.lengths - 1] if size else self.codes
        # sizes of the sets below each node; children have larger numbers than their parents
        least, most = np.full(size, 1 << 40, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for row, codes in enumerate(sets):
            if len(codes):
                node = self.ends[row]
                least[node], most[node] = min(least[node], len(codes)), max(most[node], len(codes))
        for node in range(size - 1, -1, -1):
            parent = parents[node]
            if parent >= 0:
                least[parent], most[parent] = min(least[parent], least[node]), max(most[parent], most[node])
        self.least, self.most = least, most
        order = np.argsort(self.parents, kind="stable")
        self.children = order
        self.first = np.searchsorted(self.parents[order], np.arange(-1, size), side="left")
        self.after = np.searchsorted(self.parents[order], np.arange(-1, size), side="right")
        self.rows_at: dict[int, list[int]] = {}
        for row, node in enumerate(self.ends.tolist()):
            self.rows_at.setdefault(node, []).append(row)
        self.final = np.zeros(size, dtype=bool)
        self.final[[node for node in self.rows_at if node >= 0]] = True

    def similar(self, codes: np.ndarray, mark: np.ndarray, percent: int) -> list[int]:
        """Rows whose similarity with the set ``codes`` reaches ``percent``; ``mark`` is a zeroed array over all codes."""
        size = len(codes)
        mark[codes] = 1
        found: list[int] = []
        level = self.children[self.first[0] : self.after[0]]
        overlap = np.zeros(len(level), dtype=np.int64)
        while len(level):
            lengths = self.lengths[level]
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            places = np.arange(bounds[-1]) + np.repeat(self.begins[level] - bounds[:-1], lengths)
            overlap = overlap + np.add.reduceat(mark[self.codes[places]], bounds[:-1])
            passed = np.searchsorted(codes, self.last[level], side="right")
            left = np.minimum(self.most[level] - self.depths[level], size - passed)
            alive = (100 + percent) * (overlap + left) >= percent * (self.least[level] + size)
            level, overlap = level[alive], overlap[alive]
            for node, have in zip(level[self.final[level]].tolist(), overlap[self.final[level]].tolist()):
                if (100 + percent) * have >= percent * (int(self.depths[node]) + size):
                    found += self.rows_at[node]
            counts = self.after[level + 1] - self.first[level + 1]
            total = np.concatenate([[0], np.cumsum(counts)])
            level, overlap = (
                self.children[np.arange(total[-1]) + np.repeat(self.first[level + 1] - total[:-1], counts)],
                np.repeat(overlap, counts),
            )
        mark[codes] = 0
        return found


def block_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks of sets (or inside one); rows of ``right`` count on after ``left``."""
    sets = left + (right or [])
    grams, counts = np.unique(np.concatenate(sets), return_counts=True)
    # tree order: frequent n-grams first, so that near copies share their way
    code = np.empty(len(grams), dtype=np.int64)
    code[np.argsort(-counts, kind="stable")] = np.arange(len(grams))
    coded = [np.sort(code[np.searchsorted(grams, s)]) for s in sets]
    tree = Tree(coded[: len(left)])
    mark = np.zeros(len(grams), dtype=np.int64)
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links: list[tuple[int, int]] = []
    for row in range(0 if right is None else len(left), len(sets)):
        for other in tree.similar(coded[row], mark, percent):
            a, b = root(row), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((row, other))
    return links


def prefixes_of(docs: DataFrame, n: int, percent: int, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``(id, size, digest, prefix array<long>)``: size and digest of each set and the beginning of it that must meet a similar set."""
    kind = pa.list_(pa.int64())
    bands, levels = order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sizes, digests, prefixes = [], [], []
                for grams, sums in weighted_sets(part.column(1), n, levels):
                    size = len(grams)
                    sizes.append(size)
                    digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if size else None)
                    # the overlap with any similar set is at least percent of this set
                    length = size + (percent * size) // -100 + 1 if size else 0
                    prefixes.append(ordered(grams, sums, bands)[:length].view(np.int64))
                columns = [part.column(0), pa.array(sizes, type=pa.int32()), pa.array(digests, type=pa.binary()), pa.array(prefixes, type=kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "size", "digest", "prefix"])

    return docs.select("id", "text").mapInArrow(run, "id long, size int, digest binary, prefix array<long>")


def candidate_groups(classes: DataFrame, percent: int) -> DataFrame:
    """``(node, component)`` of the classes ``(rep, size, prefix)`` that may be similar to another.

    Members of an n-gram held by up to ``SMALL_GROUP`` classes are compared in pairs: similar sets hold so many n-grams of
    their prefixes in common that the rest of either can make up for what is missing. Members of a more frequent n-gram all hang
    on one of them, which is linear and keeps every pair together.
    """
    entries = classes.select("rep", "size", F.explode("prefix").alias("gram"))
    counted = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = stored(entries.join(counted, "gram"))
    release(classes.sparkSession)  # the largest shuffles
    wide = shared.where(F.col("held") > SMALL_GROUP)
    pivots = wide.groupBy("gram").agg(F.min("rep").alias("pivot"))
    stars = wide.join(pivots, "gram").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    small = shared.where(F.col("held") <= SMALL_GROUP).select("gram", "rep", "size")
    other = small.select("gram", F.col("rep").alias("other_rep"), F.col("size").alias("other_size"))
    sizes = (100 * F.col("size") >= percent * F.col("other_size")) & (100 * F.col("other_size") >= percent * F.col("size"))
    met = small.join(other, "gram").where((F.col("rep") < F.col("other_rep")) & sizes)
    pairs = met.groupBy("rep", "size", "other_rep", "other_size").agg(F.count(F.lit(1)).alias("both"))
    # what stands behind the prefix of a set: one n-gram less than it needs in common with any similar set
    behind = lambda size: F.ceil(F.lit(percent) * size / F.lit(100)) - 1
    rest = F.greatest(behind(F.col("size")), behind(F.col("other_size")))
    enough = (100 + percent) * (F.col("both") + rest) >= percent * (F.col("size") + F.col("other_size"))
    return components(pairs.where(enough).select(F.col("rep").alias("a"), F.col("other_rep").alias("b")).union(stars))


def id_filter(ids: DataFrame, column: str) -> bytes:
    """Bits of the hashes of the ids: a document without its bit is none of them. Bounded by ``FILTER_BITS``."""
    slots = ids.select(F.pmod(F.hash(column), F.lit(FILTER_BITS)).alias("slot"))
    words = slots.selectExpr("slot DIV 32 AS word", "shiftleft(1, slot % 32) AS bit")
    bits = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.int32).view(np.uint32)
    return zlib.compress(bits.tobytes(), 1)


def texts_of(docs: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """``(id, text)`` of the documents that may be among ``ids``; the caller joins with those. A text is smaller than the hashes of its n-grams."""
    packed = id_filter(ids, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(zlib.decompress(packed), dtype=np.uint32)
        for batch in batches:
            slot = batch.column(2).to_numpy()
            yield batch.filter(pa.array((bits[slot // 32] >> (slot % 32).astype(np.uint32)) & 1 == 1)).select([0, 1])

    slot = F.pmod(F.hash("id"), F.lit(FILTER_BITS)).alias("slot")
    return docs.select("id", "text", slot).mapInArrow(run, "id long, text string")


def linked(docs: DataFrame, groups: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges ``(a, b)`` that connect what is similar inside the candidate groups ``(node, component, size)``."""
    totals = groups.groupBy("component").agg(F.ceil(F.sum("size") / BLOCK_GRAMS).cast("int").alias("blocks"))
    cut = stored(groups.join(totals, "component").select("node", "component", F.col("blocks"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")))
    placed = texts_of(docs, cut, "node").join(cut, F.col("id") == F.col("node"))
    # every pair of blocks of a group meets in one tile; a text goes to as many tiles as its group has blocks
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiled = placed.select("id", "component", "text", "block", other).select(
        "id", "component", "text", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )

    def tile(rows: list[tuple]) -> pa.RecordBatch:
        low, high = rows[0][1], rows[0][2]
        left, right = [r for r in rows if r[3] == low], [r for r in rows if r[3] != low]
        found = []
        if low == high or (left and right):
            sets = list(gram_sets(pa.array([r[5] for r in left + right], pa.large_string()), n))
            found = block_links(sets[: len(left)], None if low == high else sets[len(left) :], percent)
        ids = [r[4] for r in left + right]
        columns = [pa.array([ids[i] for i, _ in found], pa.int64()), pa.array([ids[j] for _, j in found], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if rows and rows[0][:3] != row[:3]:
                    yield tile(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield tile(rows)

    keys = ["component", "low", "high"]
    dealt = tiled.select(*keys, "block", "id", "text").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long")


def join(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with ``n_shingles`` (size of the set) and ``component_id`` (smallest id linked directly or through others)."""
    ship(df.sparkSession)
    kept = [c for c in df.columns if c not in ("n_shingles", "component_id")]
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("id IS NOT NULL")
    sets = stored(prefixes_of(docs, n, percent, frequencies(docs, n)))
    classes = stored(
        sets.where("size > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    )
    release(df.sparkSession)
    sizes = classes.groupBy("rep").agg(F.max("size").alias("size"))
    groups = stored(candidate_groups(classes, percent).join(sizes, F.col("node") == F.col("rep")).select("node", "component", "size"))
    release(df.sparkSession)
    found = components(linked(docs, groups, n, percent))
    labelled = classes.select("digest", "rep").join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("digest").alias("of"), F.coalesce("component", "rep").alias("label")
    )
    rows = sets.join(labelled, F.col("digest") == F.col("of"), "left").select("id", "size", F.coalesce("label", "id").alias("label"))
    # rows with an equal id: one line a distinct id, with the smallest component
    answer = rows.groupBy(F.col("id").alias("measurekit_id")).agg(F.max("size").cast("long").alias("n_shingles"), F.min("label").alias("component_id"))
    return df.select(*[F.col(f"`{c}`") for c in kept]).join(answer, F.col(f"`{doc_id}`").cast("long") == F.col("measurekit_id"), "left").drop("measurekit_id")
