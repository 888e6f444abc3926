"""Spelling variants: words one edit apart, and the frequent form that each word leads to.

The words and their counts are a table made once from all texts. Near words are found by asymmetric chunks. Of two words, the longer (of equal
length, the smaller) gives two chunks, its first and its last half without the middle of an odd one; the other gives its grams of that
size with their places. One edit cannot touch both halves, so a half is found again as a gram, shifted by one place at most: by none at the front, by the
difference in length at the back, which are the only grams kept. Words meet by half, size and gram, and the join itself
checks that they are one edit apart, so nothing but near words leaves it; a pair whose first halves agree is left to those.

Halves that many words share are split: both sides are dealt into blocks of ``BLOCK`` words by a hash, and each block of one side
meets each of the other's as a group of its own. Every pair is looked at once, whatever the size of a group.

The form of a word is its near word of the largest count (of equal ones the smallest), if that is at least ``RATIO`` times its own. Counts grow
along forms, so they end; roots are found by doubling the way in every pass, each stored.

Defined results: null texts and texts without words add nothing; a null id counts its words as they stand; a word's length is in code points; repeated rows count
again; counts are exact over whole texts of any length; an empty table gives an empty table; the result has no columns but its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: Words have at least so many code points; two halves of shorter ones would be single letters.
LEAST_LENGTH, LEAST_COUNT = 5, 3
RATIO = 2
#: Words of a half that meet in one group.
BLOCK = 8_192
#: Passes after which something must be wrong: counts double along forms, and passes double the way.
MAX_PASSES = 10


def counts(docs: DataFrame, words: Column, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` from an array of words a row; folded before the shuffle."""
    found = docs.select(F.explode(words).alias("word")).where(F.char_length("word") >= least_length)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def chunks(words: DataFrame) -> DataFrame:
    """The two halves of each word: ``side`` 0 in front, 1 at the back."""
    size = F.expr("size div 2")
    both = F.array(
        F.struct(F.lit(0).alias("side"), F.expr("substring(word, 1, size div 2)").alias("gram")),
        F.struct(F.lit(1).alias("side"), F.expr("substring(word, size - size div 2 + 1, size div 2)").alias("gram")),
    )
    return words.select("word", "n", F.col("size").alias("whole"), size.alias("half"), F.inline(both))


def grams(words: DataFrame) -> DataFrame:
    """The grams of each word at the places where one edit can leave a half of a word as long, or one longer."""
    sizes = words.select("word", "n", "size", F.explode(F.expr("array(size, size + 1)")).alias("whole"))
    both = F.array(
        F.struct(F.lit(0).alias("side"), F.expr("substring(word, 1, whole div 2)").alias("gram")),
        F.struct(F.lit(1).alias("side"), F.expr("substring(word, size - whole div 2 + 1, whole div 2)").alias("gram")),
    )
    return sizes.select("word", "n", "whole", F.inline(both))


KEY = ["whole", "side", "gram"]


def links(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs of near words (a, a_n, b, b_n), each once; ``words`` has distinct words and their counts."""
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    left, right = chunks(sized), grams(sized)
    # only halves with too many words on a side are told apart
    seen = left.select(*KEY, F.lit(1).alias("l"), F.lit(0).alias("r")).union(right.select(*KEY, F.lit(0), F.lit(1)))
    groups = seen.groupBy(*KEY).agg(F.sum("l").alias("l"), F.sum("r").alias("r")).where((F.col("l") > 0) & (F.col("r") > 0))
    large = groups.where(F.greatest("l", "r") > block)
    large = stored(large.select(*KEY, F.ceil(F.col("l") / block).cast("int").alias("l_blocks"), F.ceil(F.col("r") / block).cast("int").alias("r_blocks")))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        found = rows.join(large, KEY, "left")
        mine = F.expr(f"cast(pmod(xxhash64(word), coalesce({own}_blocks, 1)) as int)")
        return found.withColumn(f"{own}_block", mine).withColumn(f"{other}_block", F.explode(F.expr(f"sequence(0, coalesce({other}_blocks, 1) - 1)")))

    a = dealt(left, "l", "r").select(*KEY, "l_block", "r_block", F.col("word").alias("a"), F.col("n").alias("a_n"), "half")
    b = dealt(right, "r", "l").select(*KEY, "l_block", "r_block", F.col("word").alias("b"), F.col("n").alias("b_n"))
    once = "(length(a) > length(b) OR a < b) AND (x.side = 0 OR substring(a, 1, half) <> substring(b, 1, half))"
    same = " AND ".join(f"x.{c} = y.{c}" for c in [*KEY, "l_block", "r_block"])
    met = a.alias("x").join(b.alias("y"), F.expr(f"{same} AND {once} AND levenshtein(a, b, 1) = 1"))
    return met.select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` from ``word`` and ``form`` (none null): the end of each word's way."""
    now = stored(forms.select("word", F.col("form").alias("root")))
    for _ in range(MAX_PASSES):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stored(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")
    raise RuntimeError("forms did not end")


def variants(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of a table of distinct words and counts.

    A null word or count is left out.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL AND n IS NOT NULL"))
    pairs = links(words, block)
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    near = pairs.select(F.inline(ends)).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best")
    )
    enough = -F.col("best.less") >= RATIO * F.col("n")
    near = stored(near.select("word", "n_near", F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    ends = roots(near.where("form IS NOT NULL").select("word", "form"))
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
