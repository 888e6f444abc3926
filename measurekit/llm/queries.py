"""The registered queries of the operators: each applies one of them to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, decontaminate, embedding_dedup, html_text, language_crf, ngram_join, periodic, preference, quality, token_file, url_rules, variants, warc
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: The vocabulary file of the token queries, a name of the installed ``public_tokenizers``.
VOCABULARY = "word_bpe_49k.json"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@query("op1_bpe")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = bpe.round_trip(docs, vocabulary_path(), keep=["doc_id"])
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def remainder(doc_id: str, by: int) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(by))


@query("op5_quality")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labelled = table(spark, folder, "labels").where(remainder("doc_id", 3) != 1)
    scored = quality.score(docs, quality.fit(docs, labelled))
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op6_token_file")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    archive = token_file.write(table(spark, folder, "documents"), vocabulary_path(), end_id=1)
    return token_file.read(spark, archive, ("doc_id", "start", "n_tokens", "ids_crc32"))


@query(
    "op9_warc",
    "WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), "
    "d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p), "
    "f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest) "
    "SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type, "
    "CASE WHEN first IS NOT NULL AND page_id <> first THEN first END AS refers_to FROM d LEFT JOIN f USING (payload_digest)",
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    archive = warc.write(pages)
    # every page is searched by its key; payloads are read and checked in the tasks, and stay there
    found = warc.lookup_keys(spark, archive, warc.keys_of(pages.select("url")), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_embedding_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "n_links", "component_id", "kept")


@query("op3_ngram_join")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = ngram_join.join(docs.select("doc_id", "text"), n=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op7_language_crf")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_crf.fit(docs.where(remainder("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    predicted = language_crf.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return predicted.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


#: The stated rules of the URL query.
URL_RULES = (
    url_rules.Rule("allow", "org", "/"),
    url_rules.Rule("block", "example.org", "/es/"),
    url_rules.Rule("block", "example.org", "/en/1"),
    url_rules.Rule("allow", "com", "/fr/"),
    url_rules.Rule("block", "com", "/de/"),
)


@query("op4_url_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    # the first number of a path is the id of the document that the page shows
    shown = F.expr("try_cast(nullif(regexp_extract(url, '://[^/?#]*/[^0-9?#]*([0-9]+)', 1), '') AS bigint)")
    labels = table(spark, folder, "labels").select("doc_id", (F.col("quality") == 0).alias("block"))
    mined = url_rules.mine(pages.withColumn("doc_id", shown).join(labels, "doc_id"))
    return url_rules.judge(pages, URL_RULES, mined).select("page_id", "host", "path", "rule", "verdict", "mined_confidence", "mined_rule")


@query(
    "op8_decontaminate",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    bw AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS win, least(len(w), 10) AS n
           FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM bw),
    dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
    hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query(
    "op10_preference_pairs",
    """
    WITH t AS (SELECT conv_id, turn, role, text, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS shown FROM conversations),
    last AS (SELECT conv_id, max(turn) AS place, arg_max(text, turn) AS answer FROM t WHERE role = 'assistant' GROUP BY conv_id),
    pair AS (SELECT c.conv_id, last.place, last.answer, o.answer AS other, o.conv_id IS NOT NULL AS found
             FROM (SELECT DISTINCT conv_id FROM t) c LEFT JOIN last ON c.conv_id = last.conv_id LEFT JOIN last o ON o.conv_id = xor(c.conv_id, 1)),
    cut AS (SELECT *, CASE WHEN place IS NULL THEN 1152921504606846976 WHEN found AND answer IS NOT DISTINCT FROM other THEN place ELSE place - 1 END AS until FROM pair),
    prompts AS (SELECT t.conv_id, coalesce(string_agg(shown, '' ORDER BY turn) FILTER (turn <= until), '') AS prompt, count(*) FILTER (turn <= until) AS n_prompt_turns,
                       coalesce(string_agg(shown, '' ORDER BY turn) FILTER (turn > until), '') AS chosen_text FROM t JOIN cut USING (conv_id) GROUP BY t.conv_id),
    rest AS (SELECT t.conv_id, turn, role, length(shown) AS n, coalesce(sum(length(shown)) OVER (PARTITION BY t.conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
             FROM t JOIN cut USING (conv_id) WHERE turn > until),
    marks AS (SELECT conv_id, string_agg((prior + 14) || ':' || (prior + n), ',' ORDER BY turn) AS chosen_spans FROM rest WHERE role = 'assistant' GROUP BY conv_id),
    foreign_answer AS (SELECT conv_id, CASE WHEN place IS NULL OR NOT found OR answer IS NOT DISTINCT FROM other THEN '' ELSE '<|assistant|>' || chr(10) || coalesce(other, '') || '<|end|>' || chr(10) END AS rejected_text FROM cut)
    SELECT conv_id, prompt, n_prompt_turns, chosen_text, coalesce(chosen_spans, '') AS chosen_spans, rejected_text,
           CASE WHEN rejected_text = '' THEN '' ELSE '14:' || length(rejected_text) END AS rejected_spans
    FROM prompts JOIN foreign_answer USING (conv_id) LEFT JOIN marks USING (conv_id)
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    conversations = preference.assemble(table(spark, folder, "conversations"))
    found = preference.format_pairs(preference.with_foreign_answers(conversations))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    return found.withColumn("chosen_spans", shown(F.col("chosen_spans"))).withColumn("rejected_spans", shown(F.col("rejected_spans")))


@query(
    "op11_html_text",
    # the pages of the table mark their article, so SQL can cut it out by its tags
    r"""
    WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '<br>', ' ', 'g') AS part FROM pages),
    b AS (SELECT page_id, url, unnest(regexp_split_to_array(regexp_replace(part, '</?b>', '', 'g'), '</?(?:p|h1)>')) AS block, generate_subscripts(regexp_split_to_array(regexp_replace(part, '</?b>', '', 'g'), '</?(?:p|h1)>'), 1) AS i FROM a),
    c AS (SELECT page_id, url, i, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(block, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS block FROM b),
    t AS (SELECT page_id, url, coalesce(string_agg(block, chr(10) ORDER BY i) FILTER (block <> ''), '') AS text FROM c GROUP BY page_id, url)
    SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def repeated_words(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words of a document as the query changes them: every tenth document repeats a piece from some word on."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


@query("op13_periodic")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find(table(spark, folder, "documents").select("doc_id", "text"), edit=repeated_words)
    # greatest length, then smallest start, then smallest period
    best = F.expr("array_max(transform(runs, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Upper and lower case of the letters that the queries fold.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op12_variants",
    # crc32 byte by byte from a table that a list comprehension makes; near words by the words that are left when one code point goes
    rf"""
    WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))),
    runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
    low AS (SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS w, count(*) AS k FROM runs GROUP BY ALL),
    hashed AS (SELECT w, k, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END))),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) END AS h FROM low, crc),
    words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
    cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
    near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
             UNION SELECT cut.word, cut.n, w.word, w.n FROM cut JOIN words w ON rest = w.word
             UNION SELECT w.word, w.n, cut.word, cut.n FROM cut JOIN words w ON rest = w.word),
    best AS (SELECT word, n, count(*) AS n_near, min(struct_pack(less := -other_n, other := other)) AS b FROM near GROUP BY word, n),
    formed AS (SELECT word, n_near, CASE WHEN -b.less >= 2 * n THEN b.other END AS form, CASE WHEN -b.less >= 2 * n THEN -b.less END AS form_n FROM best),
    walk(word, last) AS (SELECT word, word FROM words UNION ALL SELECT walk.word, form FROM walk JOIN formed ON last = formed.word WHERE form IS NOT NULL)
    SELECT w.word, form, last AS root, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
    FROM words w LEFT JOIN formed f ON w.word = f.word JOIN walk ON walk.word = w.word
    WHERE last NOT IN (SELECT word FROM formed WHERE form IS NOT NULL)
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.explode(F.expr(r"regexp_extract_all(text, '[A-Za-z\\u00C0-\\u00FF]+', 0)")).alias("run"))
    lowered = docs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = lowered.withColumn("h", F.expr("crc32(cast(concat(cast(doc_id as string), ':', run) as binary))"))
    place = "cast(h % char_length(run) as int)"
    word = F.expr(f"if(coalesce(h % 97 = 0, false), concat(left(run, {place}), substring(run, {place} + 2)), run)")
    return variants.variants(variants.counts(hashed, F.array(word)))
