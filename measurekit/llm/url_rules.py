"""URL verdicts from stated rules and from mined token combinations.

``mine`` runs Spark's FP-growth over the tokens of labelled URLs, each transaction holding the tokens and, for a
URL to be blocked, the label. Rules that lead to the label are pruned by support and confidence, by the base rate (the share of blocked URLs
among those that a rule covers must exceed that among all with 95 % certainty: labels that do not depend on URLs give no rules), and by
smaller rules that say as much. ``judge`` matches them by an inverted index: a rule stands under its rarest token; a URL meets the
rules of its tokens and tests the rest of the combination. A stated rule comes first: the longest
that fits the host (or a subdomain) and the beginning of the path decides.

Only DataFrame functions and Spark ML run here; no Python code touches rows.

Defined results: a null URL or one without ``://`` has an empty host and path, no tokens, and is allowed by the method;
rows that are equal stay as many rows; labels that are null are left out; without rules of either kind everything is allowed;
columns of the input that are called like an output column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCKED = "label=block"
#: Share of the labelled URLs that a combination must cover, share of them that must be blocked (most of them, or a rule would block more
#: good URLs than bad ones), and gain over the base rate.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.002, 0.5, 1.0
#: Standard deviations of the lower bound of a rule's share, which must exceed the base rate.
CERTAINTY = 1.96
#: Labelled URLs that a combination must cover at least, whatever the share.
MIN_URLS = 20
#: Measured numbers of rules up to which the index is copied to every task; beyond it is joined by a shuffle.
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: domain endings, single host labels wherever they stand, words of the path and its place, extension, query keys, fragment, scheme."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    endings = F.transform(F.sequence(F.lit(2), F.greatest(F.size(labels), F.lit(2))), lambda n: F.array_join(F.slice(labels, -F.least(n, F.size(labels)), n), "."))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    # numbers name single pages, so all of them are one token
    words = F.transform(parts, lambda p, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), F.regexp_replace(p, "[0-9]+", "0")))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.concat(F.lit("key:"), F.split(q, "=")[0]))
    rest = F.array_compact(
        F.array(
            F.when(url.contains("#"), F.lit("fragment")),
            F.when(path.rlike(r"[^/]/$"), F.lit("slash")),
            F.concat(F.lit("scheme:"), F.regexp_extract(url, "(?s)^(.*?)://", 1)),
            F.concat(F.lit("depth:"), F.size(parts).cast("string")),
        )
    )
    hosts = F.concat(F.transform(endings, lambda e: F.concat(F.lit("host:"), e)), F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("label:"), x)))
    return F.when(host != "", F.array_distinct(F.concat(hosts, words, keys, rest))).otherwise(F.array().cast("array<string>"))


def mine(
    labelled: DataFrame,
    url: str = "url",
    block: str = "block",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_urls: int = MIN_URLS,
) -> DataFrame:
    """Rules ``(rule_id, tokens, n_tokens, confidence, lift, support)`` that lead to blocking; ``block`` is boolean.

    Their number is bounded by the support, not by the number of URLs.
    """
    rows = labelled.where(F.col(f"`{block}`").isNotNull()).select(
        F.when(F.col(f"`{block}`"), F.concat(tokens_of(F.col(f"`{url}`")), F.array(F.lit(BLOCKED)))).otherwise(tokens_of(F.col(f"`{url}`"))).alias("items")
    ).where(F.size("items") > 0)
    rows = stored(rows)
    count = rows.count()
    support = min(1.0, max(min_support, min_urls / max(1, count)))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(rows)
    found = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BLOCKED) & (F.col("lift") >= min_lift))
    base = rows.agg(F.avg(F.array_contains("items", BLOCKED).cast("double"))).first()[0] or 0.0
    covered = F.col("support") * F.lit(float(count)) / F.col("confidence")
    found = found.where(lower_bound(F.col("confidence"), covered) > base)
    rules = stored(found.select(F.sort_array("antecedent").alias("tokens"), "confidence", "lift", "support"))
    # a rule whose combination contains that of another with at least its confidence says nothing new
    small = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("least"))
    small = small.withColumn("token", F.explode("part"))
    wide = rules.withColumn("token", F.explode("tokens"))
    same = wide.join(small, "token").where((F.col("least") >= F.col("confidence")) & (F.size("part") < F.size("tokens")))
    idle = same.groupBy("tokens", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.size("part")).select("tokens").distinct()
    kept = rules.join(idle, "tokens", "left_anti")
    return stored(kept.select(F.sha2(F.array_join("tokens", " "), 256).alias("rule_id"), "tokens", F.size("tokens").alias("n_tokens"), "confidence", "lift", "support"))


def lower_bound(share: Column, n: Column) -> Column:
    """Lower end of the score interval of a share seen among ``n``."""
    z = F.lit(CERTAINTY)
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def inverted(rules: DataFrame) -> DataFrame:
    """``(token, tokens, rule_id, confidence)``: each rule under the token that fewest rules hold."""
    held = rules.select("rule_id", F.explode("tokens").alias("token"))
    often = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = held.join(often, "token").groupBy("rule_id").agg(F.min(F.struct("n", "token")).alias("r"))
    return rarest.join(rules, "rule_id").select(F.col("r.token").alias("rule_token"), F.col("tokens").alias("rule_tokens"), "rule_id", "confidence")


def stated(url: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest stated rule that fits (the first listed of equally long ones), null without one.

    The list is configuration and becomes part of the plan.
    """
    host, path = host_of(url), path_of(url)
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def judge(df: DataFrame, rules: Sequence[Rule], mined: DataFrame | None = None, url: str = "url") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict``, ``mined_confidence`` and ``mined_rule``.

    The mined columns show the strongest combination that the URL holds (ties: smallest id), whatever
    the stated rules say.
    """
    source = F.col(f"`{url}`").cast("string")
    text, verdict = stated(F.col("u"), rules)
    outputs = ["host", "path", "rule", "verdict", "mined_confidence", "mined_rule"]
    kept = [c for c in df.columns if c not in outputs]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row") if kept else F.struct(F.lit(0).alias("none")).alias("row")
    rows = df.select(row, source.alias("u"))
    if mined is not None:
        index = inverted(mined)
        if mined.count() <= BROADCAST_RULES:
            index = F.broadcast(index)
        # stored, so that ids stay the same when a task runs again
        rows = stored(rows.withColumn("id", F.monotonically_increasing_id()))
        rows = rows.withColumn("tokens", tokens_of(F.col("u")))
        # a URL's tokens stay in its task, so the table grows by the rules that really share a token
        met = rows.select("id", "row", "u", "tokens", F.explode_outer("tokens").alias("token")).join(index, F.col("token") == F.col("rule_token"), "left")
        holds = F.forall("rule_tokens", lambda t: F.array_contains(F.col("tokens"), t))
        best = F.max(F.when(holds, F.struct("confidence", "rule_id")))
        rows = met.groupBy("id").agg(F.first("row").alias("row"), F.first("u").alias("u"), best.alias("best"))
    else:
        rows = rows.withColumn("best", F.lit(None).cast("struct<confidence:double,rule_id:string>"))
    method = F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        *[F.col(f"row.`{c}`") for c in kept],
        host_of(F.col("u")).alias("host"),
        path_of(F.col("u")).alias("path"),
        text.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"),
        F.col("best.confidence").alias("mined_confidence"),
        F.col("best.rule_id").alias("mined_rule"),
    )
