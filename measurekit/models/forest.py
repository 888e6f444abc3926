"""Decision trees and forests of Spark ML's estimators, grown without a histogram for every small node.

Spark ML keeps room for all bins of a node's features however few rows the node has, and looks at all rows again for every group of
nodes: a forest of full trees has about as many nodes as rows and trees together. Here nodes with many rows are split from histograms,
one aggregation a level, and a node whose rows fit a task is handed over with its rows, and its subtree is grown there. Splits, impurities,
pruning and parameters are those of the estimators, and the result is their own model, written in its storage format by
the tasks and loaded. Bootstraps and drawn features come from the seed, in another order than Spark's.

Spark ML holds a loaded model in the driver. A model of more than ``DRIVER_BYTES`` stays in the shared folder as packed subtrees instead
(``StoredModel``): a task takes many rows at once through one subtree after the other. Its columns are those of Spark's model.

The rows travel as packed blocks of bin numbers. Through the driver go the thresholds and the nodes above the subtrees.
"""

from __future__ import annotations

import io
import json
import sys
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage, shared_folder

# Workers get the small helpers below with the job, also where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a node that one task takes, and numbers (classes or features times rows) it holds for them at most.
TASK_ROWS = 1 << 17
TASK_NUMBERS = 1 << 24
#: Numbers of all histograms of a pass; more nodes are split in several passes.
PASS_NUMBERS = 1 << 25
#: Rows of a partition of the packed rows.
PART_ROWS = 50_000
#: Bytes of a model, as Spark ML holds it, up to which it is loaded into the driver, and those of a node without its statistics.
DRIVER_BYTES = 1 << 27
NODE_BYTES = 200
#: Rows that a task takes through the trees of a stored model at once.
SCORED_ROWS = 1 << 16
#: A gain below this share of the impurity is rounding (regression).
ROUNDING = 1e-13
EPSILON = 2.0**-52

MODELS = {
    DecisionTreeClassifier: DecisionTreeClassificationModel,
    RandomForestClassifier: RandomForestClassificationModel,
    DecisionTreeRegressor: DecisionTreeRegressionModel,
    RandomForestRegressor: RandomForestRegressionModel,
}
PACKED = "start bigint, rows int, bins binary, y binary"
NODES = "tree int, root int, id int, prediction double, impurity double, stats array<double>, gain double, left int, right int, feature int, bin int, packed binary"


def supported(estimator) -> bool:
    """Does ``grow`` cover all parameters of the estimator?"""
    if type(estimator) not in MODELS or estimator.getMinInstancesPerNode() != 1 or estimator.getMinInfoGain() != 0.0:
        return False
    if estimator.getMinWeightFractionPerNode() != 0.0 or estimator.isSet("weightCol") or estimator.getImpurity() not in ("gini", "variance"):
        return False
    forest = hasattr(estimator, "getNumTrees")
    return not forest or (estimator.getSubsamplingRate() == 1.0 and estimator.getFeatureSubsetStrategy() in ("auto", "all"))


# ---- gains ----------------------------------------------------------------------------------------------------------


def gini(stats: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Class by class, in the order in which Spark subtracts."""
    out = np.ones(total.shape)
    for c in range(stats.shape[-1]):
        share = stats[..., c] / total
        out -= share * share
    return out


def gains(left: np.ndarray, all_: np.ndarray, impurity: np.ndarray, classes: int) -> np.ndarray:
    """Gain of splitting off ``left``; -1 where a side has no rows. Statistics are class counts, or rows, sum and sum of squares."""
    with np.errstate(all="ignore"):
        right = all_ - left
        if classes:
            a, b = left.sum(axis=-1), right.sum(axis=-1)
            n = a + b
            found = impurity - a / n * gini(left, a) - b / n * gini(right, b)
        else:
            a, b, n = left[..., 0], right[..., 0], all_[..., 0]
            found = (left[..., 1] ** 2 / a + right[..., 1] ** 2 / b - all_[..., 1] ** 2 / n) / n
            found = np.where(found > ROUNDING * impurity, found, 0.0)
        return np.where((a >= 1) & (b >= 1), found, -1.0)


def impurities(stats: np.ndarray, classes: int) -> np.ndarray:
    if classes:
        return gini(stats, stats.sum(axis=-1))
    return np.maximum(stats[..., 2] - stats[..., 1] ** 2 / stats[..., 0], 0.0) / stats[..., 0]


def predictions(stats: np.ndarray, classes: int, mean: float) -> np.ndarray:
    return stats.argmax(axis=-1).astype(np.float64) if classes else stats[..., 1] / stats[..., 0] + mean


def row_stats(y: np.ndarray, w: np.ndarray, classes: int) -> np.ndarray:
    """The statistics that each row adds."""
    if not classes:
        return np.stack([w, w * y, w * y * y], axis=1)
    out = np.zeros((len(y), classes))
    out[np.arange(len(y)), y.astype(np.int64)] = w
    return out


# ---- subtrees inside a task -------------------------------------------------------------------------------------------


def subtree(bins: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, depth: int, subset: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """The nodes below one node, level by level: all nodes of a level are split together. Children come after their parents.

    The rows of a level are sorted by node and bin for every drawn feature; running sums give the statistics left of each cut.
    """
    features = bins.shape[1]
    per_row = row_stats(y, w, classes)
    rows, node = np.arange(len(y)), np.zeros(len(y), dtype=np.int64)
    stats = per_row.sum(axis=0, keepdims=True)
    levels, first = [], 0
    while True:
        count = len(stats)
        impurity = impurities(stats, classes)
        level = {"stats": stats, "impurity": impurity, "gain": np.full(count, -1.0), "left": np.full(count, -1), "right": np.full(count, -1), "feature": np.full(count, -1), "bin": np.full(count, -1)}
        levels.append(level)
        if len(levels) > depth:
            break
        if classes:
            mixed = impurity > EPSILON
        else:
            low, high = np.full(count, np.inf), np.full(count, -np.inf)
            np.minimum.at(low, node, y[rows])
            np.maximum.at(high, node, y[rows])
            mixed = high > low
        # only rows of nodes that may be split go on
        some = mixed[node]
        rows, node = rows[some], node[some]
        if not len(rows):
            break
        named = np.flatnonzero(mixed)
        own = np.cumsum(mixed)[node] - 1
        total, parent = stats[named], impurity[named]
        if subset < features:
            drawn = np.argpartition(rng.random((len(named), features)), subset - 1, axis=1)[:, :subset]
        best, at, which = np.zeros(len(named)), np.full(len(named), -1), np.full(len(named), -1)
        for slot in range(subset):
            feature = drawn[:, slot] if subset < features else np.full(len(named), slot)
            place = bins[rows, feature[own]].astype(np.int64)
            order = np.argsort(own * 65_536 + place, kind="stable")
            o, p = own[order], place[order]
            cut = np.flatnonzero((o[1:] == o[:-1]) & (p[1:] != p[:-1]))
            if not len(cut):
                continue
            running = np.cumsum(per_row[rows[order]], axis=0)
            begins = np.searchsorted(o, np.arange(len(named)))
            before = np.where((begins > 0)[:, None], running[begins - 1], 0.0)
            owner = o[cut]
            found = gains(running[cut] - before[owner], total[owner], parent[owner], classes)
            edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            most = np.maximum.reduceat(found, edges)
            hit = np.flatnonzero(found == np.repeat(most, np.diff(np.r_[edges, len(owner)])))
            nodes, where = np.unique(owner[hit], return_index=True)  # the first of equal gains
            better = most > best[nodes]
            nodes, where = nodes[better], cut[hit[where[better]]]
            best[nodes], at[nodes], which[nodes] = most[better], p[where], feature[nodes]
        split = best > 0
        if not split.any():
            break
        first += count
        child = np.cumsum(split) - 1
        level["gain"][named[split]], level["feature"][named[split]], level["bin"][named[split]] = best[split], which[split], at[split]
        level["left"][named[split]] = first + 2 * child[split]
        level["right"][named[split]] = first + 2 * child[split] + 1
        some = split[own]
        rows, own = rows[some], own[some]
        node = 2 * child[own] + (bins[rows, which[own]] > at[own])
        size = 2 * int(split.sum())
        stats = np.stack([np.bincount(node, per_row[rows, c], size) for c in range(per_row.shape[1])], axis=1)
    return {k: np.concatenate([level[k] for level in levels]) for k in levels[0]}


def pruned(nodes: dict[str, np.ndarray], prediction: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Two leaves with the same prediction are their parent's; the rest is numbered anew, children after parents."""
    left, right = nodes["left"].copy(), nodes["right"].copy()
    prediction = prediction.copy()
    for i in np.flatnonzero(left >= 0)[::-1].tolist():
        a, b = left[i], right[i]
        if left[a] < 0 and left[b] < 0 and prediction[a] == prediction[b]:
            left[i] = right[i] = -1
            prediction[i] = prediction[a]
    keep = np.zeros(len(left), dtype=bool)
    keep[0] = True
    for i in np.flatnonzero(left >= 0).tolist():
        if keep[i]:
            keep[left[i]] = keep[right[i]] = True
    number = np.cumsum(keep) - 1
    out = {k: v[keep] for k, v in nodes.items()}
    inner = left[keep] >= 0
    for k, v in (("left", left), ("right", right)):
        out[k] = np.where(inner, number[v[keep]], -1)
    for k in ("gain", "feature", "bin"):
        out[k] = np.where(inner, out[k], -1)
    return out, prediction[keep]


# ---- rows ---------------------------------------------------------------------------------------------------------------


def cut_points(values: np.ndarray, splits: int, total: float) -> np.ndarray:
    """Thresholds of one feature, as Spark chooses them: all midpoints, or those that cut off about equal numbers of rows."""
    value, counts = np.unique(values, return_counts=True)
    if len(value) - 1 <= splits:
        return (value[:-1] + value[1:]) / 2.0
    stride = total / (splits + 1)
    upto, target, out = np.cumsum(counts).tolist(), stride, []
    for i in range(1, len(upto)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append((value[i - 1] + value[i]) / 2.0)
            target += stride
    return np.array(out)


def thresholds(rows: DataFrame, features: int, n: int, max_bins: int, seed: int) -> list[np.ndarray]:
    """The thresholds of every feature, from as many rows as Spark takes; one task a feature."""
    needed, bins = max(max_bins * max_bins, 10_000), min(max_bins, n)
    share = min(1.0, needed / n)
    some = rows if share == 1.0 else rows.sample(False, share, seed)

    def columns(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame["x"].to_numpy())
                yield pd.DataFrame({"feature": range(features), "v": [x[:, f].tobytes() for f in range(features)]})

    def cuts(part: pd.DataFrame) -> pd.DataFrame:
        found = cut_points(np.frombuffer(b"".join(part["v"])), bins - 1, n * share)
        return pd.DataFrame({"feature": part["feature"].iloc[:1], "v": [found.tobytes()]})

    schema = "feature int, v binary"
    found = some.mapInPandas(columns, schema).groupBy("feature").applyInPandas(cuts, schema).collect()  # one row a feature
    out = [np.zeros(0)] * features
    for r in found:
        out[r["feature"]] = np.frombuffer(r["v"])
    return out


def packed(rows: DataFrame, cuts: list[np.ndarray], kind: str, mean: float) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame["x"].to_numpy())
                bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(kind)
                y = frame["y"].to_numpy(dtype=np.float64) - mean
                yield pd.DataFrame({"start": frame["id"].iloc[:1].to_numpy(), "rows": [len(frame)], "bins": [bins.tobytes()], "y": [y.tobytes()]})

    return rows.withColumn("id", F.monotonically_increasing_id()).mapInPandas(run, PACKED)


class Top:
    """The nodes above the subtrees of one tree: they are open (to be split), closed (leaves) or handed to a task."""

    def __init__(self) -> None:
        self.left, self.right, self.feature, self.bin, self.gain, self.depth = [-1], [-1], [-1], [-1], [-1.0], [0]
        self.stats: list[np.ndarray | None] = [None]
        self.open, self.tasks = [], [0]

    def route(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), dtype=np.int64)
        left, right, feature, cut = (np.array(v) for v in (self.left, self.right, self.feature, self.bin))
        while True:
            rows = np.flatnonzero(left[node] >= 0)
            if not len(rows):
                return node
            at = node[rows]
            node[rows] = np.where(bins[rows, feature[at]] <= cut[at], left[at], right[at])

    def place(self, node: int, limit: int, most: int, classes: int) -> None:
        """What becomes of a node whose statistics are known."""
        stats = self.stats[node]
        size = stats.sum() if classes else stats[0]
        if self.depth[node] >= most or impurities(stats, classes) <= EPSILON:
            return
        (self.tasks if size <= limit else self.open).append(node)

    def split(self, node: int, feature: int, cut: int, gain: float, left: np.ndarray, right: np.ndarray) -> tuple[int, int]:
        a = len(self.left)
        self.left[node], self.right[node], self.feature[node], self.bin[node], self.gain[node] = a, a + 1, feature, cut, gain
        for side in (left, right):
            for values in (self.left, self.right, self.feature, self.bin):
                values.append(-1)
            self.gain.append(-1.0)
            self.depth.append(self.depth[node] + 1)
            self.stats.append(side)
        return a, a + 1


def weights(seed: int, tree: int, start: int, rows: int, bagged: bool) -> np.ndarray:
    """How often the rows of a block occur in a tree."""
    return np.random.default_rng([seed, tree, start]).poisson(1.0, rows) if bagged else np.ones(rows, dtype=np.int64)


def drawn_features(seed: int, tree: int, node: int, features: int, subset: int) -> np.ndarray:
    return np.arange(features) if subset == features else np.random.default_rng([seed, tree, node, 1]).permutation(features)[:subset]


def blocks(frames: Iterator[pd.DataFrame], kind: str, features: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for frame in frames:
        for start, bins, y in zip(frame["start"], frame["bins"], frame["y"]):
            yield int(start), np.frombuffer(bins, dtype=kind).reshape(-1, features), np.frombuffer(y)


def grow(estimator, frame: DataFrame):
    """The fitted model of a supported estimator."""
    spark = frame.sparkSession
    label = estimator.getLabelCol()
    classify = estimator.getImpurity() == "gini"
    rows = cut_lineage(frame.select(vector_to_array(estimator.getFeaturesCol()).alias("x"), F.col(label).cast("double").alias("y")))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y").isNull() | F.isnan("y")).alias("bad"), F.avg("y").alias("mean"), F.max("y").alias("top"), F.max(F.size("x")).alias("d")).first()
    if not facts["n"] or facts["bad"]:
        return estimator.fit(frame)  # says what is wrong
    n, features = facts["n"], facts["d"]
    names = frame.schema[label].metadata.get("ml_attr", {}).get("vals")
    classes = (len(names) if names else int(facts["top"]) + 1) if classify else 0
    mean = 0.0 if classify else float(facts["mean"])
    forest = hasattr(estimator, "getNumTrees")
    trees = estimator.getNumTrees() if forest else 1
    bagged = forest and estimator.getBootstrap()
    seed, most = estimator.getSeed() & 0x7FFFFFFF, estimator.getMaxDepth()
    subset = features
    if forest and trees > 1 and estimator.getFeatureSubsetStrategy() == "auto":
        subset = int(np.ceil(np.sqrt(features))) if classify else max(1, int(np.ceil(features / 3.0)))
    cuts = thresholds(rows, features, n, estimator.getMaxBins(), seed)
    width = max(len(c) for c in cuts) + 1
    kind = "uint8" if width <= 256 else "uint16"
    parts = max(1, -(-n // PART_ROWS))
    spread = rows.repartition(parts) if rows.rdd.getNumPartitions() < parts else rows
    store = cut_lineage(packed(spread, cuts, kind, mean))
    limit = max(64, min(TASK_ROWS, TASK_NUMBERS // max(classes, features)))
    tops = {t: Top() for t in range(trees)}
    if n > limit:
        _split_large(store, tops, kind, features, subset, width, classes, most, limit, seed, bagged)
    return _finish(spark, estimator, store, tops, kind, features, subset, classes, most, seed, bagged, mean, cuts)


def _split_large(store, tops, kind, features, subset, width, classes, most, limit, seed, bagged) -> None:
    """Split every node of more than ``limit`` rows: one aggregation for the nodes of a level, or several if their histograms are too large."""
    size = classes or 3
    for top in tops.values():
        top.open, top.tasks = [0], []
    schema = "tree int, node int, sums binary"

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        sums = np.sum([np.frombuffer(s) for s in part["sums"]], axis=0).reshape(subset, width, size)
        total = sums[0].sum(axis=0)
        upto = np.cumsum(sums, axis=1)[:, :-1]
        found = gains(upto, total, impurities(total, classes), classes) if width > 1 else np.full((subset, 0), -1.0)
        best = int(found.argmax()) if found.size else 0
        slot, cut = divmod(best, max(width - 1, 1))
        gain = float(found[slot, cut]) if found.size else -1.0
        left = upto[slot, cut] if gain > 0 else total * 0
        return pd.DataFrame({"tree": part["tree"].iloc[:1], "node": part["node"].iloc[:1], "slot": [slot], "cut": [cut], "gain": [gain], "total": [total.tobytes()], "left": [left.tobytes()]})

    group = max(1, PASS_NUMBERS // (subset * width * size))
    while True:
        wanted = [(t, node) for t, top in tops.items() for node in top.open][:group]
        if not wanted:
            return
        asked: dict[int, dict[int, np.ndarray]] = {}
        for t, node in wanted:
            asked.setdefault(t, {})[node] = drawn_features(seed, t, node, features, subset)
        routes = {t: tops[t] for t in asked}

        def histograms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for start, bins, y in blocks(frames, kind, features):
                for t, nodes in asked.items():
                    w = weights(seed, t, start, len(bins), bagged).astype(np.float64)
                    at = routes[t].route(bins)
                    for node, drawn in nodes.items():
                        mine = np.flatnonzero((at == node) & (w > 0))
                        if not len(mine):
                            continue
                        sums = held.setdefault((t, node), np.zeros((subset, width, size)))
                        own, values = bins[mine], w[mine]
                        for slot, f in enumerate(drawn):
                            place = own[:, f].astype(np.int64)
                            if classes:
                                sums[slot] += np.bincount(place * classes + y[mine].astype(np.int64), values, width * classes).reshape(width, classes)
                            else:
                                for c, v in enumerate((values, values * y[mine], values * y[mine] ** 2)):
                                    sums[slot, :, c] += np.bincount(place, v, width)
            for (t, node), sums in held.items():
                yield pd.DataFrame({"tree": [t], "node": [node], "sums": [sums.tobytes()]})

        partial = store.mapInPandas(histograms, schema).repartition(min(len(wanted), 512), "tree", "node")
        found = partial.groupBy("tree", "node").applyInPandas(choose, "tree int, node int, slot int, cut int, gain double, total binary, left binary").collect()  # one row a node
        for r in found:
            top, node = tops[r["tree"]], r["node"]
            top.open.remove(node)
            total, left = np.frombuffer(r["total"]), np.frombuffer(r["left"])
            top.stats[node] = total
            if r["gain"] > 0:
                for child in top.split(node, int(asked[r["tree"]][node][r["slot"]]), r["cut"], r["gain"], left, total - left):
                    top.place(child, limit, most, classes)
        if not found:
            raise ValueError("no rows for the nodes to split")


def _finish(spark: SparkSession, estimator, store, tops, kind, features, subset, classes, most, seed, bagged, mean, cuts):
    """Grow the subtrees, number all nodes, write the model and load it."""
    forest = hasattr(estimator, "getNumTrees")
    jobs = sum(len(top.tasks) for top in tops.values())
    routes = {t: top for t, top in tops.items() if top.tasks}
    depths = {(t, node): most - top.depth[node] for t, top in tops.items() for node in top.tasks}

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for start, bins, y in blocks(frames, kind, features):
            for t, top in routes.items():
                w = weights(seed, t, start, len(bins), bagged)
                at = top.route(bins) if len(top.left) > 1 else np.zeros(len(bins), dtype=np.int64)
                parts = [(node, np.flatnonzero((at == node) & (w > 0))) for node in top.tasks]
                yield pd.DataFrame([
                    {"tree": t, "root": node, "start": start, "bins": bins[mine].tobytes(), "y": y[mine].tobytes(), "w": w[mine].astype("<i4").tobytes()}
                    for node, mine in parts if len(mine)
                ], columns=["tree", "root", "start", "bins", "y", "w"])

    def build(part: pa.Table) -> pa.Table:
        part = part.sort_by("start")
        join = lambda c: b"".join(part[c].to_pylist())
        tree, root = part["tree"][0].as_py(), part["root"][0].as_py()
        bins = np.frombuffer(join("bins"), dtype=kind).reshape(-1, features)
        y, w = np.frombuffer(join("y")), np.frombuffer(join("w"), dtype="<i4").astype(np.float64)
        nodes = subtree(bins, y, w, classes, depths[tree, root], subset, np.random.default_rng([seed, tree, root, 2]))
        nodes, prediction = pruned(nodes, predictions(nodes["stats"], classes, mean))
        count, stats = len(prediction), nodes["stats"]
        whole = lambda v: pa.array(np.asarray(v).astype(np.int32))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32)), pa.array(stats.ravel()))
        return pa.table({
            "tree": whole(np.full(count, tree)), "root": whole(np.full(count, root)), "id": whole(np.arange(count)), "prediction": pa.array(prediction), "impurity": pa.array(nodes["impurity"]),
            "stats": lists, "gain": pa.array(nodes["gain"]), "left": whole(nodes["left"]), "right": whole(nodes["right"]), "feature": whole(nodes["feature"]), "bin": whole(nodes["bin"]),
            "packed": pa.array([piece(nodes, ballots(stats, prediction, classes, forest))] + [None] * (count - 1), pa.binary()),
        })

    dealt = store.mapInPandas(deal, "tree int, root int, start bigint, bins binary, y binary, w binary").repartition(min(max(jobs, 1), 512), "tree", "root")
    folder = shared_folder(spark, "trees")
    dealt.groupBy("tree", "root").applyInArrow(build, NODES).write.parquet(folder)
    grown = spark.read.schema(NODES).parquet(folder)
    # one row a subtree
    sizes = {(r["tree"], r["root"]): r for r in grown.groupBy("tree", "root").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("id") == 0, F.col("prediction"))).alias("p")).collect()}
    above, offsets = [], []
    for t, top in tops.items():
        if top.tasks == [0]:
            if (t, 0) in sizes:
                offsets.append((t, 0, 0, 1))
            else:  # the bootstrap of a tiny table may be empty
                above.append((t, 0, 0.0 if classes else mean, 0.0, [0.0] * (classes or 3), -1.0, -1, -1, -1, -1))
            continue
        rows, offset = _numbered(t, top, sizes, classes, mean)
        above += rows
        offsets += offset
    total = len(above) + sum(r["n"] for r in sizes.values())
    if total * (NODE_BYTES + 8 * (classes or 3)) > DRIVER_BYTES:
        return _kept(spark, estimator, grown, above, offsets, classes, features, len(tops), cuts)
    table = spark.createDataFrame(offsets, "tree int, root int, place int, offset int") if offsets else None
    number = lambda c: F.when(F.col(c) < 0, -1).when(F.col(c) == 0, F.col("place")).otherwise(F.col("offset") + F.col(c) - 1)
    columns = ["tree", "id", "prediction", "impurity", "stats", "gain", "left", "right", "feature", "bin"]
    schema = "tree int, id int, prediction double, impurity double, stats array<double>, gain double, left int, right int, feature int, bin int"
    nodes = spark.createDataFrame(above, schema)
    if table is not None:
        below = grown.join(F.broadcast(table), ["tree", "root"])  # one row a subtree
        nodes = nodes.unionByName(below.select([number(c).cast("int").alias(c) if c in ("id", "left", "right") else F.col(c) for c in columns]))
    return _loaded(spark, estimator, nodes, classes, mean, features, len(tops), cuts)


def _numbered(t: int, top: Top, sizes: dict, classes: int, mean: float) -> tuple[list[tuple], list[tuple]]:
    """The nodes above the subtrees of a tree, pruned as those, and where the subtrees' nodes go."""
    count = len(top.left)
    tasks = {node for node in top.tasks if (t, node) in sizes}
    left, right = top.left[:], top.right[:]
    leaf = [left[i] < 0 and (i not in tasks or sizes[t, i]["n"] == 1) for i in range(count)]
    prediction = [sizes[t, i]["p"] if i in tasks else float(predictions(top.stats[i], classes, mean)) for i in range(count)]
    for i in range(count - 1, -1, -1):
        a, b = left[i], right[i]
        if a >= 0 and leaf[a] and leaf[b] and prediction[a] == prediction[b]:
            left[i] = right[i] = -1
            leaf[i], prediction[i] = True, prediction[a]
    keep = [0]
    for i in keep:  # grows while it is read: parents before children
        if left[i] >= 0:
            keep += [left[i], right[i]]
    number = {node: i for i, node in enumerate(keep)}
    offset, rows, offsets = len(keep), [], []
    for node in keep:
        if node in tasks:
            offsets.append((t, node, number[node], offset))
            offset += sizes[t, node]["n"] - 1
            continue
        inner = left[node] >= 0
        stats = top.stats[node]
        rows.append((
            t, number[node], prediction[node], float(impurities(stats, classes)), stats.tolist(), float(top.gain[node]) if inner else -1.0,
            number[left[node]] if inner else -1, number[right[node]] if inner else -1, int(top.feature[node]) if inner else -1, int(top.bin[node]) if inner else -1,
        ))
    return rows, offsets


# ---- models that stay in the shared folder --------------------------------------------------------------------------------


def ballots(stats: np.ndarray, prediction: np.ndarray, classes: int, forest: bool) -> np.ndarray:
    """What each node adds to the raw prediction of a row that ends there: shares of the classes in a forest, their counts in a tree, or a number."""
    if not classes:
        return prediction[:, None]
    total = stats.sum(axis=1, keepdims=True)
    return np.divide(stats, total, out=np.zeros(stats.shape), where=total > 0) if forest else stats


def piece(nodes: dict[str, np.ndarray], votes: np.ndarray) -> bytes:
    """A packed subtree; a leaf has -1 to its left and its place among the distinct votes to its right."""
    leaf = nodes["left"] < 0
    distinct, which = np.unique(votes[leaf], axis=0, return_inverse=True)
    right = nodes["right"].astype(np.int32)
    right[leaf] = which.ravel()
    out = io.BytesIO()
    np.savez(out, left=nodes["left"].astype(np.int32), right=right, feature=nodes["feature"].astype(np.int32), bin=nodes["bin"].astype(np.int32), votes=distinct)
    return out.getvalue()


def pieces(folder: str, tree: int) -> Iterator[tuple[int, bytes]]:
    """The packed subtrees of a tree, one after the other."""
    system, path = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    for name in sorted(i.path for i in system.get_file_info(fs.FileSelector(f"{path}/tree={tree}")) if i.path.endswith(".parquet")):
        with system.open_input_file(name) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=1, columns=["root", "packed"]):
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def descend(nodes, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The leaf in which each of the ``rows`` ends."""
    left, right, feature, cut = (nodes[k] for k in ("left", "right", "feature", "bin"))
    node, open_ = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
    while True:
        open_ = open_[left[node[open_]] >= 0]
        if not len(open_):
            return node
        at = node[open_]
        node[open_] = np.where(bins[rows[open_], feature[at]] <= cut[at], left[at], right[at])


def raw_predictions(bins: np.ndarray, state: dict[str, np.ndarray], trees: int, folder: str, width: int) -> np.ndarray:
    """The sums of the votes, tree by tree as Spark adds them."""
    out, every = np.zeros((len(bins), width)), np.arange(len(bins))
    for t in range(trees):
        top = {k: state[f"{k}-{t}"] for k in ("left", "right", "feature", "bin", "root", "votes")}
        node = descend(top, bins, every)
        root = top["root"][node]
        out[root < 0] += top["votes"][node[root < 0]]
        wanted = set(root[root >= 0].tolist())
        for at, packed in pieces(folder, t) if wanted else ():
            if at in wanted:
                nodes, rows = np.load(io.BytesIO(packed)), np.flatnonzero(root == at)
                nodes = {k: nodes[k] for k in nodes.files}
                out[rows] += nodes["votes"][nodes["right"][descend(nodes, bins, rows)]]
    return out


class StoredModel(Model, MLReadable, MLWritable):
    """A tree or forest whose subtrees stay in a shared folder. Its columns are those of Spark's model of the same nodes.

    ``state`` has the thresholds and, of each tree, the nodes above its subtrees; ``facts`` names columns, classes and trees.
    """

    def __init__(self, folder: str, state: dict[str, np.ndarray], facts: dict) -> None:
        super().__init__()
        self.folder, self.state, self.facts = folder, state, facts

    def _transform(self, dataset: DataFrame) -> DataFrame:
        facts, state, folder = self.facts, self.state, self.folder
        trees, classes, features = facts["trees"], facts["classes"], facts["features"]

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held: list[np.ndarray] = []

            def scored() -> Iterator[pd.Series]:
                if held:
                    raw, at = raw_predictions(np.concatenate(held), state, trees, folder, classes or 1), 0
                    for part in held:
                        yield pd.Series(list(raw[at : at + len(part)]))
                        at += len(part)
                held.clear()

            for batch in batches:
                x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, features))
                held.append(np.stack([np.searchsorted(state[f"cuts-{f}"], x[:, f], side="left") for f in range(features)], axis=1).astype(np.uint16))
                if sum(map(len, held)) >= SCORED_ROWS:
                    yield from scored()
            yield from scored()

        raw, prediction = F.pandas_udf(run, "array<double>")(vector_to_array(facts["featuresCol"])), facts["predictionCol"]
        if not classes:
            return dataset.withColumn(prediction, raw[0] / F.lit(trees))
        votes = "measurekit_votes"
        share = F.aggregate(votes, F.lit(0.0), lambda a, b: a + b)
        out = dataset.withColumn(votes, raw).withColumn("measurekit_sum", share)
        return out.withColumns({
            facts["rawPredictionCol"]: array_to_vector(votes),
            facts["probabilityCol"]: array_to_vector(F.transform(votes, lambda v: F.when(F.col("measurekit_sum") != 0, v / F.col("measurekit_sum")).otherwise(v))),
            prediction: (F.array_position(votes, F.array_max(votes)) - 1).cast("double"),
        }).drop(votes, "measurekit_sum")

    def write(self) -> MLWriter:
        return _StoredWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StoredReader()


class _StoredWriter(MLWriter):
    def __init__(self, model: StoredModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, out = self.sparkSession, io.BytesIO()
        np.savez(out, **self.model.state)
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={"facts": self.model.facts})
        spark.createDataFrame([(out.getvalue(),)], "state binary").coalesce(1).write.parquet(f"{path}/state")
        _write_pieces(spark.read.parquet(self.model.folder), f"{path}/pieces", self.model.facts["trees"])


class _StoredReader(MLReader):
    def load(self, path: str) -> StoredModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        with np.load(io.BytesIO(spark.read.parquet(f"{path}/state").first()["state"])) as found:
            state = {k: found[k] for k in found.files}
        return StoredModel(f"{path}/pieces", state, metadata["facts"])._resetUid(metadata["uid"])


def _write_pieces(rows: DataFrame, folder: str, trees: int) -> None:
    rows.select("tree", "root", "packed").repartition(min(trees, 512), "tree").write.partitionBy("tree").parquet(folder)


def _kept(spark: SparkSession, estimator, grown: DataFrame, above: list[tuple], offsets: list[tuple], classes: int, features: int, trees: int, cuts: list[np.ndarray]) -> StoredModel:
    folder = shared_folder(spark, "pieces")
    _write_pieces(grown.where("packed IS NOT NULL"), folder, trees)
    forest = hasattr(estimator, "getNumTrees")
    state = {f"cuts-{f}": c for f, c in enumerate(cuts)}
    by_tree: dict[int, tuple[list, list]] = {t: ([], []) for t in range(trees)}
    for row in above:
        by_tree[row[0]][0].append(row)
    for row in offsets:
        by_tree[row[0]][1].append(row)
    for t, (nodes, roots) in by_tree.items():
        size = len(nodes) + len(roots)
        whole = {k: np.full(size, -1, dtype=np.int64) for k in ("left", "right", "feature", "bin", "root")}
        votes = np.zeros((size, classes or 1))
        for _, i, prediction, _, stats, _, left, right, feature, cut in nodes:
            whole["left"][i], whole["right"][i], whole["feature"][i], whole["bin"][i] = left, right, feature, cut
            votes[i] = ballots(np.array([stats]), np.array([prediction]), classes, forest)[0]
        for _, root, place, _ in roots:
            whole["root"][place] = root
        state |= {f"{k}-{t}": v for k, v in whole.items()} | {f"votes-{t}": votes}
    facts = {"trees": trees, "classes": classes, "features": features, "featuresCol": estimator.getFeaturesCol(), "predictionCol": estimator.getPredictionCol()}
    if classes:
        facts |= {"rawPredictionCol": estimator.getRawPredictionCol(), "probabilityCol": estimator.getProbabilityCol()}
    return StoredModel(folder, state, facts)


# ---- Spark ML's storage format ------------------------------------------------------------------------------------------


def _metadata(spark: SparkSession, kind: str, uid: str, estimator, dropped: tuple[str, ...] = (), **more) -> str:
    plain = lambda params: {p.name: v for p, v in params.items() if p.name not in dropped}
    return json.dumps({
        "class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
        "paramMap": plain(estimator._paramMap), "defaultParamMap": plain(estimator._defaultParamMap), **more,
    })


def _loaded(spark: SparkSession, estimator, nodes: DataFrame, classes: int, mean: float, features: int, trees: int, cuts: list[np.ndarray]):
    model = MODELS[type(estimator)]
    forest = hasattr(estimator, "getNumTrees")
    values = [(f, b, float(v)) for f, c in enumerate(cuts) for b, v in enumerate(c)]
    limits = spark.createDataFrame(values, "feature int, bin int, threshold double")
    found = nodes.join(F.broadcast(limits), ["feature", "bin"], "left")  # at most bins times features rows
    size, total, squares = (F.col("stats")[i] for i in range(3)) if not classes else (None, None, None)
    # sums were taken about the mean of the table
    stats = F.col("stats") if classes else F.array(size, total + size * mean, squares + 2 * mean * total + size * mean * mean)
    count = F.aggregate("stats", F.lit(0.0), lambda a, b: a + b) if classes else size
    threshold = F.when(F.col("threshold").isNull(), F.array().cast("array<double>")).otherwise(F.array("threshold"))
    data = found.select("tree", F.struct(
        F.col("id"), F.col("prediction"), F.col("impurity"), stats.alias("impurityStats"), count.cast("long").alias("rawCount"), F.col("gain"), F.col("left").alias("leftChild"), F.col("right").alias("rightChild"),
        F.struct(F.col("feature").alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")).alias("split"),
    ).alias("nodeData"))
    path = shared_folder(spark, "model")
    package = "classification" if classes else "regression"
    more = {"numFeatures": features} | ({"numClasses": classes} if classes else {}) | ({"numTrees": trees} if forest else {})
    text = _metadata(spark, f"{package}.{model.__name__}", estimator.uid, estimator, **more)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    if forest:
        part = f"{package}.{'DecisionTreeClassificationModel' if classes else 'DecisionTreeRegressionModel'}"
        dropped = ("numTrees", "bootstrap", "subsamplingRate", "featureSubsetStrategy")
        each = [(t, _metadata(spark, part, f"{estimator.uid}_{t}", estimator, dropped), 1.0) for t in range(trees)]
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        data.withColumnRenamed("tree", "treeID").write.parquet(f"{path}/data")
    else:
        data.select("nodeData.*").write.parquet(f"{path}/data")
    return model.load(path)
