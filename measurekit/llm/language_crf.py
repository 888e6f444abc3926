"""Language of words and texts by a linear-chain conditional random field.

A word (a run of letters, lower-cased) is described by itself, its beginnings and endings, its character n-grams and the lexicons
that hold it; transitions between neighbouring words are learned with it. Forward-backward passes give every word a
distribution over the languages, so a text may switch between them; the language of a text is the one with the largest mean.

Training takes a bounded draw of labelled texts, up to about ``PER_LANGUAGE`` of each language by a hash of the id, all
words of each. Their runs of words are chained across texts, which shows the model where languages
switch. Shards learn from the common state, and the states are averaged; a state has ``FEATURES`` rows and a column a language, of which there
are at most ``MAX_LANGUAGES``, those with the most texts (ties: alphabetical order).

``label_words`` gives the language of every word and how likely it is; ``predict`` the language of every text.

Defined results: a text that is null, empty or without letters is ``und`` with score 0, as is every text if nothing labelled was given;
texts of any length are labelled whole, their words in one chain; labels that are null are left out; ids decide the draw only, never a prediction; equal texts get equal
results; ties go to the first language in alphabetical order; other columns stay, those called like an output column are
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship, stored

UNKNOWN = "und"
FEATURES = 1 << 16
PER_LANGUAGE = 1_000
LEXICON = 300
MAX_LANGUAGES = 256
SHARDS, ROUNDS = 6, 2
#: Words of a run, runs of a training chain, chains of a step.
RUN_WORDS, CHAIN_RUNS, STEP_CHAINS = 48, 4, 48
RATE, DECAY = 0.25, 1e-6
#: Words whose scores a worker remembers, and words of texts scored together (one text at least).
WORD_CACHE, GROUP_WORDS = 250_000, 1_000_000


@functools.lru_cache(maxsize=1)
def _letters():
    import regex

    return regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    return _letters().findall(text.lower()) if text else []


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed features of a word; n-grams that touch an edge are its affixes."""
    framed = f"^{word}$"
    found = {framed, framed[:4], framed[:5], framed[-4:], framed[-5:]}
    for n in (2, 3):
        found.update(framed[i : i + n] for i in range(len(framed) - n + 1))
    mask = FEATURES - 1
    out = [zlib.crc32(f.encode()) & mask for f in found]
    out.append(zlib.crc32(b"lexicon") + lexicon.get(word, -1) + 1 & mask)
    return out


class Emissions:
    """Scores of distinct words, one row each, computed when a word is first seen."""

    def __init__(self, weights: np.ndarray, lexicon: dict[str, int]) -> None:
        self.weights, self.lexicon = weights, lexicon
        self.reset()

    def reset(self) -> None:
        self.rows: dict[str, int] = {}
        self.known: list[str] = []
        self.table = np.zeros((1024, self.weights.shape[1]), dtype=np.float32)
        self.ready = 0

    def index(self, words: Sequence[str]) -> np.ndarray:
        rows = self.rows
        try:
            return np.fromiter(map(rows.__getitem__, words), dtype=np.int64, count=len(words))
        except KeyError:
            for word in words:
                if word not in rows:
                    rows[word] = len(rows)
                    self.known.append(word)
            return np.fromiter(map(rows.__getitem__, words), dtype=np.int64, count=len(words))

    def scores(self) -> np.ndarray:
        fresh = self.known[self.ready :]
        if fresh:
            need = len(self.known)
            if need > len(self.table):
                grown = np.zeros((2 * need, self.table.shape[1]), dtype=np.float32)
                grown[: self.ready] = self.table[: self.ready]
                self.table = grown
            flat, begins = flat_features(fresh, self.lexicon)
            self.table[self.ready : need] = np.add.reduceat(self.weights[flat], begins, axis=0)
            self.ready = need
        return self.table


def flat_features(words: Sequence[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    lists = [features(w, lexicon) for w in words]
    begins = np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]]).astype(np.int64)
    return np.fromiter((f for x in lists for f in x), dtype=np.int64), begins


class Chains:
    """Sequences of emission scores laid out by time, the longest first, for passes over all of them at once."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        ordered = lengths[self.order]
        self.steps = int(ordered[0]) if len(ordered) else 0
        # active[t]: sequences with more than t words
        self.active = np.searchsorted(-ordered, -np.arange(self.steps), side="left")
        self.begins = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        rank = np.empty(len(lengths), dtype=np.int64)
        rank[self.order] = np.arange(len(lengths))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        time = np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
        #: Place of every word, in the order of the sequences, in the layout by time.
        self.places = self.begins[time] + np.repeat(rank, lengths)

    def forward(self, scores: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled emissions and forward probabilities, by time."""
        emitted = np.empty_like(scores)
        emitted[self.places] = np.exp(scores - scores.max(axis=1, keepdims=True))
        alpha = np.empty_like(emitted)
        before = None
        for t in range(self.steps):
            part = slice(self.begins[t], self.begins[t + 1])
            now = emitted[part] * (start if before is None else before[: self.active[t]] @ moves)
            now /= now.sum(axis=1, keepdims=True)
            alpha[part] = before = now
        return emitted, alpha

    def backward(self, emitted: np.ndarray, alpha: np.ndarray, moves: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """From the last step to the first: step, beta of the next step times its emissions (or None), marginals."""
        ahead = None
        for t in range(self.steps - 1, -1, -1):
            n = self.active[t]
            beta = np.ones((n, alpha.shape[1]), dtype=alpha.dtype)
            if ahead is not None:
                going = ahead @ moves.T
                beta[: len(going)] = going / going.max(axis=1, keepdims=True)
            marginal = alpha[self.begins[t] : self.begins[t + 1]] * beta
            marginal /= marginal.sum(axis=1, keepdims=True)
            yield t, ahead, marginal
            ahead = emitted[self.begins[t] : self.begins[t + 1]] * beta


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray
    start: np.ndarray
    moves: np.ndarray

    def shares(self, emissions: Emissions, words: list[np.ndarray]) -> np.ndarray:
        """Mean marginal of every language in each sequence of word rows (no sequence is empty)."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        chains = Chains(lengths)
        scores = emissions.scores()[np.concatenate(words)]
        moves = np.exp(self.moves).astype(np.float32)
        emitted, alpha = chains.forward(scores, np.exp(self.start).astype(np.float32), moves)
        totals = np.zeros((len(words), len(self.languages)))
        for t, _, marginal in chains.backward(emitted, alpha, moves):
            totals[: len(marginal)] += marginal
        out = np.empty_like(totals)
        out[chains.order] = totals / lengths[chains.order, None]
        return out


    def marginals(self, emissions: Emissions, words: list[np.ndarray]) -> np.ndarray:
        """The distribution over the languages of every word, one sequence behind the other."""
        chains = Chains(np.array([len(w) for w in words], dtype=np.int64))
        moves = np.exp(self.moves).astype(np.float32)
        emitted, alpha = chains.forward(emissions.scores()[np.concatenate(words)], np.exp(self.start).astype(np.float32), moves)
        by_time = np.empty_like(alpha)
        for t, _, marginal in chains.backward(emitted, alpha, moves):
            by_time[chains.begins[t] : chains.begins[t + 1]] = marginal
        return by_time[chains.places]


def learn(model: Model, squares: list[np.ndarray], texts: list[list[str]], labels: list[int], seed: int) -> None:
    """One pass of stochastic steps over chained runs of words, in place; ``squares`` scales the steps."""
    runs = [(words[i : i + RUN_WORDS], y) for words, y in zip(texts, labels) for i in range(0, len(words), RUN_WORDS)]
    order = np.random.default_rng(seed).permutation(len(runs))
    size = CHAIN_RUNS * STEP_CHAINS
    for at in range(0, len(order), size):
        some = [runs[i] for i in order[at : at + size]]
        chains = [some[i : i + CHAIN_RUNS] for i in range(0, len(some), CHAIN_RUNS)]
        _step(model, squares, [[w for run, _ in c for w in run] for c in chains], [np.concatenate([np.full(len(run), y) for run, y in c]) for c in chains])


def _step(model: Model, squares: list[np.ndarray], words: list[list[str]], labels: list[np.ndarray]) -> None:
    emissions = Emissions(model.weights, model.lexicon)
    rows = [emissions.index(w) for w in words]
    scores = emissions.scores()
    chains = Chains(np.array([len(r) for r in rows], dtype=np.int64))
    flat = np.concatenate(rows)
    moves = np.exp(model.moves)
    emitted, alpha = chains.forward(scores[flat].astype(np.float64), np.exp(model.start), moves)
    marginals, expected = np.empty_like(alpha), np.zeros_like(moves)
    first = None
    for t, ahead, marginal in chains.backward(emitted, alpha, moves):
        marginals[chains.begins[t] : chains.begins[t + 1]] = marginal
        if ahead is not None:
            both = alpha[chains.begins[t] : chains.begins[t] + len(ahead), :, None] * moves * ahead[:, None, :]
            expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        first = marginal
    gradient = marginals[chains.places]
    gradient[np.arange(len(flat)), np.concatenate(labels)] -= 1.0
    seen = np.zeros_like(moves)
    for y in labels:
        np.add.at(seen, (y[:-1], y[1:]), 1.0)
    begun = first.sum(axis=0)
    np.subtract.at(begun, np.array([y[0] for y in labels]), 1.0)
    by_word = np.zeros((len(emissions.known), moves.shape[0]))
    np.add.at(by_word, flat, gradient)
    feature, begins = flat_features(emissions.known, model.lexicon)
    counts = np.diff(np.append(begins, len(feature)))
    total = np.zeros_like(model.weights)
    np.add.at(total, feature, np.repeat(by_word, counts, axis=0))
    used = np.unique(feature)
    n = len(labels)
    squares[0][used] += (total[used] / n) ** 2
    model.weights[used] -= RATE * (total[used] / n / np.sqrt(squares[0][used] + 1e-6) + DECAY * model.weights[used])
    for values, change, scale in ((model.moves, (expected - seen) / n, squares[1]), (model.start, begun / n, squares[2])):
        scale += change**2
        values -= RATE * change / np.sqrt(scale + 1e-6)


def _draw(labelled: DataFrame, doc_id: str, text: str, label: str, per_language: int) -> DataFrame:
    """``(id, text, lang)``: of each language the share of ids by hash that holds about ``per_language`` texts."""
    rows = labelled.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{label}`").cast("string").alias("lang")).where("lang IS NOT NULL")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, per_language / r["count"]))).otherwise(share)
    hashed = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(hashed < share)


def _lexicon(drawn: DataFrame, languages: list[str]) -> dict[str, int]:
    """The ``LEXICON`` words most frequent in one language and mostly found there, with its number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update((lang, w) for w in words_of(text))
            columns = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

    counted = drawn.select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("word"))
    own = counted.withColumn("total", total).where((F.col("n") >= 5) & (F.col("n") >= 0.8 * F.col("total")))
    best = own.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= LEXICON)
    return {r["word"]: languages.index(r["lang"]) for r in best.collect()}


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Learn from rows with a text and its language."""
    ship(labelled.sparkSession)
    drawn = stored(_draw(labelled, doc_id, text, label, per_language).withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(SHARDS)).cast("int")))
    languages = sorted(r["lang"] for r in drawn.select("lang").distinct().collect())
    k = len(languages)
    model = Model(languages, _lexicon(drawn, languages) if k else {}, np.zeros((FEATURES, k)), np.zeros(k), np.zeros((k, k)))
    for turn in range(ROUNDS if k > 1 else 0):
        model = _round(drawn, model, turn)
    return model


def _round(drawn: DataFrame, model: Model, turn: int) -> Model:
    languages, lexicon, shape = model.languages, model.lexicon, model.weights.shape
    state = [a.astype(np.float32) for a in (model.weights, model.start, model.moves)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(languages, lexicon, *[a.astype(np.float64) for a in state])
        squares = [np.zeros(shape), np.zeros((shape[1], shape[1])), np.zeros(shape[1])]
        seen = 0
        for batch in batches:
            texts = [words_of(t) for t in batch.column(0).to_pylist()]
            learn(own, squares, texts, [languages.index(x) for x in batch.column(1).to_pylist()], turn)
            seen += sum(map(len, texts))
        if seen:
            values = [a.astype("<f4").tobytes() for a in (own.weights, own.start, own.moves)]
            yield pa.RecordBatch.from_arrays([pa.array([seen]), *(pa.array([v]) for v in values)], names=["seen", "weights", "start", "moves"])

    dealt = drawn.repartition(SHARDS, "shard").sortWithinPartitions("shard", F.xxhash64("id", F.lit(11)), "text").select("text", "lang")
    states = dealt.mapInArrow(run, "seen long, weights binary, start binary, moves binary").collect()  # at most SHARDS states
    if not states:
        return model
    total = sum(s["seen"] for s in states)
    states.sort(key=lambda s: bytes(s["moves"]))
    mean = lambda name: sum(np.frombuffer(s[name], dtype="<f4").astype(np.float64) * (s["seen"] / total) for s in states)
    return Model(languages, lexicon, mean("weights").reshape(shape), mean("start"), mean("moves").reshape(shape[1], shape[1]))


def predict(df: DataFrame, model: Model, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``lang_pred`` and ``score``, the mean share of that language over the words."""
    ship(df.sparkSession)
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    small = Model(model.languages, model.lexicon, model.weights.astype(np.float32), model.start, model.moves)
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("measurekit_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]), "lang_pred string, score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = Emissions(small.weights, small.lexicon)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            names, values = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)

            def settle(places: list[int], words: list[np.ndarray]) -> None:
                if places:
                    shares = small.shares(emissions, words)
                    best = shares.argmax(axis=1)
                    values[places] = np.minimum(shares[np.arange(len(places)), best], 1.0)
                    for place, i in zip(places, best.tolist()):
                        names[place] = small.languages[i]
                if len(emissions.rows) > WORD_CACHE:
                    emissions.reset()

            places, words, size = [], [], 0
            for i, value in enumerate(texts):
                found = words_of(value.as_py()) if small.languages else []
                if found:
                    places.append(i)
                    words.append(emissions.index(found))
                    size += len(found)
                if size > GROUP_WORDS:
                    settle(places, words)
                    places, words, size = [], [], 0
            settle(places, words)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(values)], names=[*kept, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def label_words(df: DataFrame, model: Model, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """A row for every word of every text: the columns ``keep`` (all by default), ``position`` (from 0), ``word`` (in lower case), ``word_lang`` and
    ``probability``. Texts without words have no rows; without a learned language a word is ``und`` with probability 0.
    """
    ship(df.sparkSession)
    outs = ("position", "word", "word_lang", "probability")
    kept = [c for c in (df.columns if keep is None else keep) if c not in outs]
    small = Model(model.languages, model.lexicon, model.weights.astype(np.float32), model.start, model.moves)
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("measurekit_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]), "position int, word string, word_lang string, probability double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = Emissions(small.weights, small.lexicon)

        def labelled(batch: pa.RecordBatch, places: list[int], found: list[list[str]]) -> pa.RecordBatch:
            lengths = [len(w) for w in found]
            names, values = [UNKNOWN] * sum(lengths), np.zeros(sum(lengths))
            if small.languages:
                shares = small.marginals(emissions, [emissions.index(w) for w in found])
                best = shares.argmax(axis=1)
                names = [small.languages[i] for i in best.tolist()]
                values = np.minimum(shares[np.arange(len(best)), best].astype(np.float64), 1.0)
            at = pa.array(np.repeat(places, lengths))
            columns = [batch.column(i).take(at) for i in range(batch.num_columns - 1)]
            columns += [pa.array(np.concatenate([np.arange(n) for n in lengths]), pa.int32()), pa.array([w for words in found for w in words], pa.string())]
            if len(emissions.rows) > WORD_CACHE:
                emissions.reset()
            return pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(values)], names=[*kept, *outs])

        for batch in batches:
            places: list[int] = []
            found: list[list[str]] = []
            size = 0
            for i, value in enumerate(batch.column(batch.num_columns - 1)):
                words = words_of(value.as_py())
                if words:
                    places.append(i)
                    found.append(words)
                    size += len(words)
                if size > GROUP_WORDS // 4:
                    yield labelled(batch, places, found)
                    places, found, size = [], [], 0
            if places:
                yield labelled(batch, places, found)

    return rows.mapInArrow(run, schema)
