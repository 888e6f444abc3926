"""The corpus pipeline over ``documents``: quality, language, near duplicates, benchmark passages, token ids.

Every stage takes the rows that its predecessor kept, as stored, and decides on each of them. A filtering stage keeps a
document unless its operator speaks against it, so rows without labels, languages or ids are kept where nothing can be said.

``doc_id`` and ``text`` are needed; ``lang`` teaches the second stage, which keeps all where it is missing. The filtering stages return the columns that
they get, in their order, whatever they are called. An empty table passes all stages and gives an empty table; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from measurekit.llm import bpe, decontaminate, language_crf, ngram_join, quality
from measurekit.llm.common import fresh_folder, stored, table
from measurekit.llm.queries import vocabulary_path

#: Below these a document goes: likelihood of good quality, and share of its words in the predicted language.
MIN_QUALITY, MIN_LANGUAGE = 0.5, 0.5
#: Near duplicates share this percentage of their shingles of so many words. (op3 has the values of its own contract.)
NEAR_WORDS, NEAR_PERCENT = 5, 80
REST = "measurekit_rest"


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns in one, so that none of them meets an output column of an operator."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(None).cast("int").alias(REST)).alias(REST))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"{REST}.`{c}`") for c in columns])


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject."""
    model = quality.fit(docs, table(spark, folder, "labels"))
    if model.share is not None:  # no two labels to tell apart
        return docs
    return unpacked(quality.score(packed(docs), model, out="score").where(F.col("score") >= MIN_QUALITY), docs.columns)


def one_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which a language is recognised: they have letters, and one language holds enough of the words."""
    model = language_crf.fit(docs) if "lang" in docs.columns else None
    if model is None or not model.languages:
        return docs
    known = (F.col("lang_pred") != language_crf.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE)
    return unpacked(language_crf.predict(packed(docs), model).where(known), docs.columns)


def first_of_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The row with the smallest id of every group of near duplicates (a row without id only where none has one).

    Rows are known by a 64-bit hash of id and text, so what shares an id but not its text is decided on by itself; rows that a second
    hash tells apart, though the first does not, stay. Of rows equal in id and text one stays; rows without id and words all do.
    """
    rows = packed(docs).select("*", F.xxhash64("doc_id", "text").alias("row"), F.xxhash64(F.lit(1), "text", "doc_id").alias("check"))
    joined = ngram_join.join(rows.select("row", "check", "doc_id", "text"), "row", n=NEAR_WORDS, percent=NEAR_PERCENT)
    found = stored(joined.select("row", "check", "doc_id", "n_shingles", "component_id"))
    several = found.groupBy("row").agg(F.count(F.lit(1)).alias("n"), (F.min("check") < F.max("check")).alias("mixed"), F.max(F.col("doc_id").isNotNull() | (F.col("n_shingles") > 0)).alias("known"))
    several = stored(several.where("n > 1"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    # equal rows count once: a group has a second row
    firsts = found.groupBy("component_id").agg(F.min(order)["row"].alias("first"), F.min("row").alias("low"), F.max("row").alias("high"))
    firsts = stored(firsts.where("low < high").select("component_id", "first"))
    others = found.join(firsts, "component_id").where(F.col("row") != F.col("first")).select("row").distinct()
    others = others.join(several.where("mixed").select("row"), "row", "left_anti")
    kept = rows.join(others, "row", "left_anti")
    repeated = several.where("known").select("row")
    single = kept.join(repeated, "row", "left_anti")
    one = kept.join(repeated, "row", "left_semi").groupBy("row", "doc_id", "text").agg(F.min_by(REST, F.to_json(REST)).alias(REST))
    return unpacked(single.select("doc_id", "text", REST).union(one.select("doc_id", "text", REST)), docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.contamination(packed(docs), table(spark, folder, "benchmark"))
    return unpacked(found.where(~F.col("contaminated")), docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document with its token ids and the text they decode to; its id, language and source stay."""
    found = bpe.round_trip(docs, vocabulary_path(), keep=[c for c in ("doc_id", "lang", "source") if c in docs.columns])
    return found.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", good_quality),
    ("language id", one_language),
    ("n-gram jaccard join", first_of_group),
    ("benchmark decontamination", without_benchmark),
    ("bpe encoding and decoding", token_ids),
]

#: The models of the first stages and the trie have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again by the next."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = fresh_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
