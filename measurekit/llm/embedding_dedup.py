"""Near-duplicate vectors by int8 tile products with error bounds.

1. Equal vectors form a class and go on once, with their number.
2. Pivots cut the directions into cells; the angle between two pivots and the radii of their cells exclude pairs
   of cells that hold no similar vectors. Large cells are cut into blocks, so a tile (a pair of blocks) is bounded.
3. In a tile every unit vector is quantised to int8 with a scale of its own. The products of the codes are exact integers; with the
   norms of codes and errors they bound the cosine from both sides. Pairs surely above or below the threshold are settled
   by that, only the others are computed in double precision.
4. A tile returns the number of links of each vector and one edge to its smallest linked neighbour for every member of a linked part, never the pairs.
   Components are joined from those edges.

Pivots decide only which tiles are skipped, and every bound is conservative, so the result does not depend on them.

Defined results: null vectors, vectors without components, with null or non-finite components or of length zero have no links and
are components of their own; vectors of different dimension never link; rows with an equal id count as vectors of
their own but share component and the sum of their links; a vector without id links and joins components like any other, but its row gets null results and
its component the smallest id that it has; other columns stay, those called like an output column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship, stored
from .components import components

#: Directions that cut the space, drawn from the vectors by the smallest hash: so many of each dimension, and of all dimensions together
#: (but one of each); bounds what is handed to the tasks.
PIVOTS, ALL_PIVOTS = 256, 4_096
#: Vectors of a block: with 64 components a tile takes about 8 MB of vectors.
BLOCK = 8_192
#: Rows of a tile multiplied at once.
STRIP = 256
#: Components whose products of codes a single-precision sum holds exactly, in whatever order: 1,040 * 127 * 127 < 2^24.
EXACT = 1_040
#: Relative error of a scaled product (scale and product are rounded to 24 bits each), and of the sums in double precision a component.
ROUNDED, DOUBLED = 3.0 * 2.0**-24, 8.0 * 2.0**-53
ANGLE_SLACK = 1e-6


def unit_rows(batch: pa.Array) -> np.ndarray:
    """The vectors of a list array (all of one length) as unit rows in double precision."""
    x = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (int8 values as float32), scale, length of the coded vector and of its error."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None])
    coded = codes * scale[:, None]
    return codes.astype(np.float32), scale, np.sqrt((coded * coded).sum(axis=1)), np.sqrt(((x - coded) ** 2).sum(axis=1))


def products(codes_a: np.ndarray, codes_b: np.ndarray) -> np.ndarray:
    """Exact products of codes: slices of components that single precision holds, summed in double precision where there are several."""
    if codes_a.shape[1] <= EXACT:
        return codes_a @ codes_b
    total = np.zeros((len(codes_a), codes_b.shape[1]))
    for at in range(0, codes_a.shape[1], EXACT):
        total += codes_a[:, at : at + EXACT] @ codes_b[at : at + EXACT]
    return total


def links(left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> np.ndarray:
    """Boolean matrix of the pairs with cosine >= threshold.

    With codes c, errors e and vectors x = c + e, a product differs from that of the codes by at most
    (|ca| + |ea|)(|cb| + |eb|) - |ca||cb|; roundings of the scaled product add ``ROUNDED`` of |ca||cb|, those of norms and sums ``DOUBLED`` a component.
    """
    codes_a, scale_a, norm_a, error_a = quantised(left)
    codes_b, scale_b, norm_b, error_b = quantised(right)
    out = np.zeros((len(left), len(right)), dtype=bool)
    reach_a, reach_b = norm_a + error_a, norm_b + error_b
    widest, least = reach_b.max(), norm_b.min()
    double = DOUBLED * left.shape[1] * max(1.0, reach_a.max() * widest)
    transposed, scales = np.ascontiguousarray(codes_b.T), scale_b.astype(np.float32)
    for begin in range(0, len(left), STRIP):
        end = min(begin + STRIP, len(left))
        rough = products(codes_a[begin:end], transposed) * scales
        loose = reach_a[begin:end] * widest - norm_a[begin:end] * least + ROUNDED * norm_a[begin:end] * widest + double
        floor = np.nextafter(((threshold - loose) / scale_a[begin:end]).astype(np.float32), np.float32(-np.inf))
        rows, cols = np.nonzero(rough >= floor[:, None])
        if same:
            apart = rows + begin != cols
            rows, cols = rows[apart], cols[apart]
        near = rough[rows, cols].astype(np.float64) * scale_a[begin + rows]
        both = norm_a[begin + rows] * norm_b[cols]
        bound = reach_a[begin + rows] * reach_b[cols] - both + ROUNDED * both + double
        sure = near - bound >= threshold
        open_ = ~sure & (near + bound >= threshold)
        out[begin + rows[sure], cols[sure]] = True
        rows, cols = rows[open_], cols[open_]
        for at in range(0, len(rows), 1 << 17):
            r, c = rows[at : at + (1 << 17)], cols[at : at + (1 << 17)]
            exact = np.einsum("ij,ij->i", left[begin + r], right[c])
            hit = exact >= threshold
            out[begin + r[hit], c[hit]] = True
    return out


def spread(found: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what a tile's links connect: each member of a part with one member of it."""
    edges: list[tuple[int, int]] = []
    columns = np.ascontiguousarray(found.T)
    open_rows, open_cols = found.any(axis=1), found.any(axis=0)
    while open_rows.any():
        seed = int(np.argmax(open_rows))
        rows, anchor = np.array([seed]), int(ids_a[seed])
        open_rows[seed] = False
        while len(rows):
            cols = np.flatnonzero(found[rows].any(axis=0) & open_cols)
            open_cols[cols] = False
            edges += [(anchor, int(i)) for i in ids_b[cols]]
            rows = np.flatnonzero(columns[cols].any(axis=0) & open_rows) if len(cols) else cols
            open_rows[rows] = False
            edges += [(anchor, int(i)) for i in ids_a[rows]]
    return edges


def usable(vector: str) -> F.Column:
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~wrong & F.exists(vector, lambda x: x != 0)


def _in_cells(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``cell`` (nearest pivot of the dimension) and the ``angle`` to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, angles = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows)
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                cosine = unit_rows(batch.column("vector").take(pa.array(rows))) @ pivots[int(dim)].T
                cells[rows] = cosine.argmax(axis=1)
                angles[rows] = np.arccos(np.clip(cosine.max(axis=1), -1.0, 1.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(angles)], names=[*batch.schema.names, "cell", "angle"])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(run, f"vector {kind}, n long, dim int, key long, cell int, angle double")


def _pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors of each dimension, those with the smallest hash: a bounded draw that does not depend on the order of rows.

    Only vectors whose hash lies below a share are ordered, about four times the draw, so no task or driver merges a draw of every partition.
    """
    sizes = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("rows"))
    known = sizes.agg(F.count(F.lit(1))).first()[0]
    each = max(1, min(PIVOTS, ALL_PIVOTS // max(known, 1)))
    share = F.least(F.lit(1.0), F.lit(4.0 * each + 64.0) / F.col("rows"))
    hashed = classes.select("dim", "vector", F.xxhash64("vector").alias("hash")).join(sizes, "dim")
    few = hashed.where(F.pmod(F.col("hash"), F.lit(1 << 30)) <= share * float(1 << 30))
    place = F.row_number().over(Window.partitionBy("dim").orderBy("hash", "vector"))
    out: dict[int, list] = {}
    for row in few.withColumn("place", place).where(F.col("place") <= each).select("dim", "vector").collect():
        out.setdefault(row["dim"], []).append(row["vector"])
    return {dim: unit_rows(pa.array(drawn, type=pa.list_(pa.float64()))) for dim, drawn in sorted(out.items())}


def _chain(centres: np.ndarray) -> list[int]:
    """The pivots in an order in which neighbours are close."""
    left, order = set(range(1, len(centres))), [0]
    while left:
        rest = np.array(sorted(left))
        order.append(int(rest[np.argmax(centres[rest] @ centres[order[-1]])]))
        left.discard(order[-1])
    return order


def _packs(sizes: list, pivots: dict[int, np.ndarray], threshold: float) -> tuple[list[tuple], list[tuple]]:
    """``(dim, cell, pack, blocks)``, and the pairs of packs ``(pack, other, other_blocks)`` that may hold similar vectors.

    Small neighbouring cells share a pack of up to ``BLOCK`` vectors; a larger cell is a pack of several blocks.
    """
    reach = np.arccos(min(1.0, threshold)) + ANGLE_SLACK
    cells, near_packs, blocks = [], set(), {}
    pack = -1
    for dim, centres in pivots.items():
        rows = {r["cell"]: (r["rows"], r["radius"]) for r in sizes if r["dim"] == dim}
        order = [c for c in _chain(centres) if c in rows]
        room, of = 0, {}
        for c in order:
            if rows[c][0] > room:
                pack, room = pack + 1, BLOCK
            room -= rows[c][0]
            of[c] = pack
            blocks[pack] = max(1, -(-rows[c][0] // BLOCK))
        known = np.array(order)
        radius = np.array([rows[c][1] for c in order])
        angle = np.arccos(np.clip(centres[known] @ centres[known].T, -1.0, 1.0))
        for i, j in zip(*np.nonzero(angle - radius[:, None] - radius[None, :] <= reach)):
            near_packs.add((of[order[i]], of[order[j]]))
        cells += [(int(dim), int(c), of[c], blocks[of[c]]) for c in order]
    return cells, [(a, b, blocks[b]) for a, b in sorted(near_packs)]


def tile_results(rows: list[tuple], threshold: float) -> pa.RecordBatch:
    """``(key, other, links)`` of a tile whose rows are ``(low, high, side, key, n, vector)``: numbers of links, and edges without one."""
    low, high = rows[0][:2]
    left, right = [r for r in rows if r[2] == low], [r for r in rows if r[2] != low]
    out: list[list] = [[], [], []]
    if low == high:
        right = left
    if left and right:
        a = unit_rows(pa.array([r[5] for r in left]))
        b = a if low == high else unit_rows(pa.array([r[5] for r in right]))
        found = links(a, b, threshold, low == high)
        weight_a, weight_b = np.array([r[4] for r in left], dtype=np.int64), np.array([r[4] for r in right], dtype=np.int64)
        totals = [(left, [int(weight_b[row].sum()) for row in found])]
        if low != high:
            totals.append((right, [int(weight_a[column].sum()) for column in found.T]))
        for side, counts in totals:
            for r, count in zip(side, counts):
                if count:
                    for values, x in zip(out, (r[3], None, count)):
                        values.append(x)
        for x, y in spread(found, np.array([r[3] for r in left]), np.array([r[3] for r in right])):
            for values, v in zip(out, (x, y, None)):
                values.append(v)
    return pa.RecordBatch.from_arrays([pa.array(v, type=pa.int64()) for v in out], names=["key", "other", "links"])


def tiled(placed: DataFrame, cells: list[tuple], near: list[tuple], threshold: float) -> DataFrame:
    """``(key, other, links)``: numbers of links of classes, and edges between classes."""
    spark = placed.sparkSession
    # both tables are bounded by the number of pivots
    where = F.broadcast(spark.createDataFrame(cells, "dim int, cell int, pack int, blocks int"))
    pairs = F.broadcast(spark.createDataFrame(near, "pack int, other int, other_blocks int"))
    side = F.col("pack") * F.lit(1 << 32) + F.pmod(F.xxhash64("key"), F.col("blocks"))
    rows = placed.join(where, ["dim", "cell"]).withColumn("side", side).join(pairs, "pack")
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)))
    facing = F.col("other") * F.lit(1 << 32) + F.col("block")
    rows = rows.select(F.least("side", facing).alias("low"), F.greatest("side", facing).alias("high"), "side", "key", "n", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(5)))
            for key, vector in zip(keys, batch.column(5)):
                if held and held[0][:2] != key[:2]:
                    yield tile_results(held, threshold)
                    held = []
                held.append((*key, vector.values.to_numpy(zero_copy_only=False).copy()))
        if held:
            yield tile_results(held, threshold)

    dealt = rows.repartition("low", "high").sortWithinPartitions("low", "high")
    return dealt.mapInArrow(run, "key long, other long, links long")


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """``df`` with ``n_links``, ``component_id`` and ``kept``; links are pairs with cosine >= ``threshold``, which is above 0."""
    ship(df.sparkSession)
    outputs = ("n_links", "component_id", "kept")
    kept = [c for c in df.columns if c not in outputs]
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast(kind).alias("vector"))
    good = rows.where(usable("vector"))
    # a class is known by its key; it has the smallest id of its rows, or none
    classes = good.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes.select("vector", "rep", "n", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("key")))
    pivots = _pivots(classes)
    placed = stored(_in_cells(classes.drop("rep"), pivots))
    sizes = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("rows"), F.max("angle").alias("radius")).collect()
    cells, near = _packs(sizes, pivots, threshold)
    found = stored(tiled(placed, cells, near, threshold))
    counted = found.where("links IS NOT NULL").groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(found.where("links IS NULL").select("key", "other"), "key", "other").withColumnRenamed("node", "key")
    # components are named by the smallest id in them
    joined = stored(classes.select("key", "rep").join(joined, "key"))
    labels = joined.groupBy("component").agg(F.min("rep").alias("label"))
    labelled = joined.select("key", "component").join(labels, "component").select("key", "label")
    named = (
        classes.where("rep IS NOT NULL")
        .join(counted, "key", "left")
        .join(labelled, "key", "left")
        .select(F.col("vector").alias("of"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("label", "rep").alias("label"))
    )
    marked = rows.where("id IS NOT NULL").withColumn("ok", F.coalesce(usable("vector"), F.lit(False)))
    answers = marked.where("ok").join(named, F.col("vector") == F.col("of")).select("id", "links", "label").union(
        marked.where("NOT ok").select("id", F.lit(0).cast("long"), "id")
    )
    answer = answers.groupBy(F.col("id").alias("measurekit_id")).agg(F.sum("links").alias("n_links"), F.min("label").alias("component_id"))
    return (
        df.select(*[F.col(f"`{c}`") for c in kept])
        .join(answer, F.col(f"`{vec_id}`").cast("long") == F.col("measurekit_id"), "left")
        .withColumn("kept", F.col("component_id") == F.col(f"`{vec_id}`"))
        .drop("measurekit_id")
    )
