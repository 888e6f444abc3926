"""Text quality by hashed word n-grams and logistic regression with follow-the-regularised-leader updates.

A text is a sparse vector: hashed words and word pairs (runs of letters, digits or other marks, case kept), each with 1 + log of
its count, scaled to length one, and a constant. The labelled texts are a bounded draw: up to ``SAMPLE`` of them by
the smallest hash of their id. They are dealt to ``SHARDS``; in a round every shard goes through its texts
with the per-coordinate updates, starting from the common state, and the states are averaged by the number of texts. The state is two
arrays of ``FEATURES`` numbers, so what is handed out and gathered does not grow with the data. A score is one
sparse dot product.

Labels are read only for the rows given as labelled; ids decide the draw and the shard, never a feature.

Defined results: null and empty texts have the constant alone and get its score; texts of any length are read whole, a slice of texts at a time; labels other than 0 and 1 are left out; a text labelled
twice counts twice; without labelled texts of both kinds every score is the share of label 1 (0.5 without any); other columns
stay, those called like an output column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_column, ship, stored
from .hashing import mix, ngram_hashes, word_hashes
from .ngram_join import slices

FEATURES = 1 << 18
SAMPLE = 20_000
SHARDS, ROUNDS = 8, 4
#: Learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.0
#: Letters (and all bytes beyond ASCII), digits, white space; the rest are marks.
MARK, LETTER, DIGIT = 1, 2, 3


def classes() -> np.ndarray:
    table = np.full(256, MARK, dtype=np.uint8)
    table[list(b" \t\n\x0b\x0c\r")] = 0
    table[65:91] = table[97:123] = table[128:] = LETTER
    table[48:58] = DIGIT
    return table


def folded_digits() -> np.ndarray:
    """All digits count as 0: a number's length is known, not its value."""
    table = np.arange(256, dtype=np.uint8)
    table[48:58] = 48
    return table


def vectors(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices and values of every text; index 0 is the constant."""
    kinds, digits, shift = classes(), folded_digits(), np.uint64(64 - (FEATURES - 1).bit_length())
    one = np.zeros(1, dtype=np.int64), np.ones(1)
    for a, b in slices(texts):
        words, offsets = word_hashes(texts.slice(a, b - a), kinds, digits)
        pairs = ngram_hashes(words, 2)
        singles = (mix(words) >> shift).astype(np.int64)
        pairs = (pairs >> shift).astype(np.int64)
        for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if i == j:
                yield one
                continue
            found, counts = np.unique(np.concatenate([singles[i:j], pairs[i : max(i, j - 1)]]), return_counts=True)
            values = 1.0 + np.log(counts)
            if found[0] == 0:
                found, values = found[1:], values[1:]
            length = np.sqrt(values @ values) or 1.0
            yield np.append(found, 0), np.append(values / length * 4.0, 1.0)


@dataclass
class Model:
    """State of the updates and the weights they stand for."""

    z: np.ndarray
    n: np.ndarray
    share: float | None = None

    def weights(self) -> np.ndarray:
        return weights(self.z, self.n)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def update(z: np.ndarray, n: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> None:
    """One pass of follow-the-regularised-leader updates over the texts, in place."""
    for (index, value), label in zip(rows, labels):
        zi, ni = z[index], n[index]
        w = weights(zi, ni)
        gradient = (1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        squared = gradient * gradient
        z[index] = zi + gradient - (np.sqrt(ni + squared) - np.sqrt(ni)) / ALPHA * w
        n[index] = ni + squared


def draw(labelled: DataFrame, doc_id: str, label: str, sample: int = SAMPLE) -> DataFrame:
    """``(id, label)`` of the labelled ids with the smallest hashes, at most ``sample`` of them.

    They are counted first; only ids below a share of the hashes that holds about one and a half times the draw are ordered, so what meets
    in one task does not grow with the number of partitions.
    """
    rows = labelled.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    rows = rows.where("id IS NOT NULL AND label IN (0, 1)")
    count = rows.count()
    if count > sample:
        # far more than enough by chance; ids that repeat count once for the share, so many copies of few ids take the plain way
        few = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, (1.5 * sample + 1000) / count)))
        rows = few if few.count() >= sample else rows
    return rows.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 40)), "id", "label").limit(sample)


def fit(docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from the texts of ``docs`` whose id is in ``labelled`` (id and label)."""
    ship(docs.sparkSession)
    drawn = stored(draw(labelled, doc_id, label, sample).withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(SHARDS)).cast("int")))
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    # at most ``sample`` ids of 16 bytes are handed out
    rows = texts.join(F.broadcast(drawn), F.col("doc") == F.col("id")).select("shard", "id", "label", "text")
    rows = stored(rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", F.xxhash64("id", F.lit(11)), "text"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    model = Model(np.zeros(FEATURES), np.zeros(FEATURES))
    if len(sizes) < 2:
        model.share = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
        return model
    for _ in range(ROUNDS):
        model = _round(rows, model)
    return model


def _round(rows: DataFrame, model: Model) -> Model:
    start_z, start_n = model.z.astype(np.float32), model.n.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n, seen = start_z.astype(np.float64), start_n.astype(np.float64), 0
        for batch in batches:
            update(z, n, list(vectors(batch.column(1))), batch.column(0).to_pylist())
            seen += batch.num_rows
        if seen:
            columns = [pa.array([seen]), pa.array([z.astype("<f4").tobytes()]), pa.array([n.astype("<f4").tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names=["seen", "z", "n"])

    dealt = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", F.xxhash64("id", F.lit(11)), "text").select("label", "text")
    states = dealt.mapInArrow(run, "seen long, z binary, n binary").collect()  # at most SHARDS states
    total = sum(s["seen"] for s in states)
    mean = lambda name: sum(np.frombuffer(s[name], dtype="<f4").astype(np.float64) * (s["seen"] / total) for s in sorted(states, key=lambda s: bytes(s["z"])))
    return Model(mean("z"), mean("n"))


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with ``out``: how likely label 1 is, from 0 to 1."""
    table, share = model.weights().astype(np.float32), model.share

    def make():
        def work(texts: pa.Array) -> pa.Array:
            if share is not None:
                return pa.array(np.full(len(texts), share))
            sums = np.array([float(table[index] @ value) for index, value in vectors(texts)])
            return pa.array(1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35))))

        return work

    return map_column(df, text, out, "double", make)
