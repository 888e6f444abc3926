"""Benchmark passages in documents: a prefix-filtered set join with exact verification.

A window is ``WINDOW_WORDS`` consecutive words of an item, or all words of a shorter item. A window occurs only where all
of its word shingles do, so its prefix is one shingle: the one that is rarest in the documents. Documents are cut into
words once; each place whose shingle is the prefix of a window is joined with it, the positional and length bounds
place the window inside the document, and its words are compared one by one.

Only DataFrame functions run here; no Python code touches rows.

The windows are a stated query set: they are copied to every task in blocks of ``BLOCK_WINDOWS``, as many blocks as
there are. Documents never meet each other and no group of documents is collected.

Defined results: null, empty and wordless texts have no words and no hits; null and wordless items have no windows; items with equal
ids count once and their windows are united; equal documents are rows of their own; a null item id is counted as the
text ``null``; other columns of the documents stay, those called like an output column are replaced; empty tables give
no hits or no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: What a word is made of, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW_WORDS = 10
#: Words of a shingle; windows with fewer words use shingles of their own length.
SHINGLE_WORDS = 3
#: Stands for the shingle of the place after the last word; what meets it is tested, so a hash may have this value.
CLOSING = 0
#: Windows copied to every task at once, about 30 MB of words.
BLOCK_WINDOWS = 200_000


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    # lower() is the cheaper function and does the same where all characters are ASCII
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1)), F.array().cast("array<string>"))


def windows_of(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW_WORDS) -> DataFrame:
    """``(item, window array<string>, n)``: the distinct windows of every item."""
    words = items.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item"), words_of(F.col(f"`{text}`")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - size, F.lit(0))
    starts = F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, F.lit(size))))
    return words.select("item", starts.alias("window")).distinct().withColumn("n", F.size("window"))


def shingle(words: Column, at: Column, n: int, first: Column | None = None) -> Column:
    """Hash of ``n`` words from place ``at`` (0-based)."""
    return F.xxhash64(F.get(words, at) if first is None else first, *[F.get(words, at + i) for i in range(1, n)])


def places(docs: DataFrame, sizes: list[int], carried: list[str]) -> DataFrame:
    """``carried``, ``words, at, seen``: every place of a document with its shingle; the place after the last word has ``CLOSING``.

    Plain rows instead of functions over arrays, so that one generated loop cuts, hashes and joins them; the
    words travel along by reference and are written out for matches only. The outer explode is
    taken because the inner one adds a filter that cuts the text a second time.
    """
    closed = F.concat("words", F.array(F.lit(None).cast("string")))
    rows = docs.select(*carried, "words", F.posexplode_outer(closed).alias("at", "first"))
    end, words, at = F.size("words"), F.col("words"), F.col("at")
    if len(sizes) == 1:
        n = sizes[0]
        seen = F.when(at == end, F.lit(CLOSING)).otherwise(shingle(words, at, n, F.col("first")))
        return rows.where((at <= end - n) | (at == end)).select(*carried, "words", "at", seen.alias("seen"))
    # items with fewer words than a shingle bring shorter shingles with them
    some = F.array_compact(F.array(F.when(at == end, F.lit(CLOSING)), *[F.when(at <= end - n, shingle(words, at, n, F.col("first"))) for n in sizes]))
    return rows.select(*carried, "words", "at", F.explode(some).alias("seen"))


def shingled(windows: DataFrame, most: int) -> DataFrame:
    """Windows with every shingle and its place in the window."""

    def hashed(n: int) -> Column:
        return F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - n), lambda i: shingle(F.col("window"), i, n)))

    parts = []
    for n in range(1, most + 1):
        found = hashed(n)
        parts.append(windows.where(F.least(F.lit(most), F.col("n")) == n).select("item", "window", "n", found.alias("place", "shingle")))
    return reduce(DataFrame.unionByName, parts)


def prefixes(docs: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """``(shingle, place, item, window, n)``: of each window the shingle rarest in ``docs`` (column ``words``)."""
    held = shingled(windows, SHINGLE_WORDS)
    wanted = held.select("shingle").distinct()
    found = (
        places(docs, sizes, [])
        .join(F.broadcast(wanted), F.col("seen") == F.col("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("often"))
    )
    ranked = held.join(found, "shingle", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    best = ranked.groupBy("item", "window", "n").agg(F.min(F.struct("often", "shingle", "place")).alias("r"))
    return best.select(F.col("r.shingle").alias("shingle"), F.col("r.place").alias("place"), "item", "window", "n")


def occurrences(docs: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """``docs`` (with ``id`` and ``words``) met with the windows: one closing row a document without ``item``, one row an occurrence.

    Columns ``id, n_words, item, start, n`` and, on the closing row only, those of the document.
    """
    spark = docs.sparkSession
    index = prefixes(docs, windows, sizes).select("shingle", "place", "item", "window", F.col("n").alias("size"))
    closing = spark.range(1).select(
        F.lit(CLOSING).alias("shingle"), F.lit(0).alias("place"), F.lit(None).cast("string").alias("item"), F.lit(None).cast("array<string>").alias("window"), F.lit(0).alias("size")
    )
    carried = [c for c in docs.columns if c != "words"]
    start, end = F.col("at") - F.col("place"), F.size("words")
    # inside the document, then word by word
    inside = (start >= 0) & (start + F.col("size") <= end)
    held = inside & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("size")) == F.col("window"))
    fits = F.when(F.col("item").isNull(), F.col("at") == end).otherwise(held)
    met = places(docs, sizes, carried).join(F.broadcast(index.union(closing)), (F.col("seen") == F.col("shingle")) & fits)
    last = F.col("item").isNull()
    return met.select(
        "id", "item", F.when(~last, start).alias("start"), F.col("size").alias("n"), end.alias("n_words"), *[F.when(last, F.col(c)).alias(c) for c in carried if c != "id"]
    )


def covered(spans: Column) -> Column:
    """Number of places in the union of sorted ``struct<start, n>``."""
    step = lambda s, x: F.struct(
        (s["total"] + F.greatest(x["start"] + x["n"] - F.greatest(x["start"], s["until"]), F.lit(0))).alias("total"), F.greatest(s["until"], x["start"] + x["n"]).alias("until")
    )
    return F.aggregate(spans, F.struct(F.lit(0).alias("total"), F.lit(0).alias("until")), step, lambda s: s["total"]).cast("long")


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window_words: int = WINDOW_WORDS
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurrence), ``items`` (sorted ids as strings) and ``contaminated``.

    Rows are numbered as they are read. Where ``docs`` comes out of a shuffle instead of stored files, store it first: a task that runs again may get its rows in
    another order.
    """
    outputs = ["n_words", "n_hit", "items", "contaminated"]
    kept = [c for c in docs.columns if c not in outputs]
    inner = [f"kept{i}" for i in range(len(kept))]
    rows = docs.select(
        F.monotonically_increasing_id().alias("id"), words_of(F.col(f"`{text}`").cast("string")).alias("words"), *[F.col(f"`{c}`").alias(i) for c, i in zip(kept, inner)]
    )
    windows = stored(windows_of(items, item_id, item_text, window_words))
    lengths = {r["n"]: r["count"] for r in windows.groupBy("n").count().collect()}  # at most window_words rows
    sizes = sorted({min(SHINGLE_WORDS, n) for n in lengths}) or [SHINGLE_WORDS]
    blocks = max(1, -(-sum(lengths.values()) // BLOCK_WINDOWS))
    if blocks > 1:
        rows = stored(rows)  # several passes need the ids to be fixed
    met = []
    for block in range(blocks):
        some = windows if blocks == 1 else windows.where(F.pmod(F.hash("window", "item"), F.lit(blocks)) == block)
        met.append(occurrences(rows, some, sizes))
    spans = F.array_sort(F.collect_set(F.when(F.col("item").isNotNull(), F.struct("start", "n"))))
    found = reduce(DataFrame.unionByName, met).groupBy("id").agg(
        F.max("n_words").cast("long").alias("n_words"),
        spans.alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items"),
        *[F.first(i, ignorenulls=True).alias(i) for i in inner],
    )
    return found.select(
        *[F.col(i).alias(c) for c, i in zip(kept, inner)], "n_words", covered(F.col("spans")).alias("n_hit"), "items", (F.size("items") > 0).alias("contaminated")
    )
