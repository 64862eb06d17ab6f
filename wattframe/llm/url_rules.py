"""URL filtering by association rules.

Given rules on hosts and paths decide first. For the other URLs, FP-growth mines which combinations
of URL tokens go with which label; the pruned rules are found through an inverted index that lists
each rule under the rarest token of its antecedent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.session import keep

ALLOW, BLOCK = "allow", "block"
#: Label items among the tokens. No URL token has an equals sign at its start.
_ITEM = {ALLOW: "=allow", BLOCK: "=block"}
#: Words in host names that a reviewer labels as unwanted.
SEED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")

_AFTER = r"^.*?://"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Labelled URLs that a mined rule rests on at least.
LEAST_ROWS = 5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: str) -> Column:
    rule_host, _, rest = rule.partition("/")
    below = (host == rule_host) | host.endswith("." + rule_host)
    return below & path.startswith("/" + rest)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, NULL without one. Rules: (verdict, host/path)."""
    ordered = sorted(rules, key=lambda rule: (-len(rule[1]), rule[1]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in reversed(ordered):
        fits = _fits(host, path, rule)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct words of host, path and query; bare numbers name single pages and are left out."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    marked = [
        F.transform(F.split(text, pattern), lambda word: F.concat(F.lit(mark), word))
        for mark, text, pattern in (
            ("host:", host, r"[^\p{L}\p{N}]+"),
            ("path:", F.lower(path), r"[^\p{L}\p{N}]+"),
            ("query:", F.lower(query), r"[^\p{L}\p{N}]+"),
        )
    ]
    words = F.filter(F.concat(*marked), lambda word: ~word.rlike(r":\d*$"))
    return F.array_sort(F.array_distinct(words))


def mined_rules(
    labelled: DataFrame, urls: DataFrame, min_support: float, min_confidence: float
) -> DataFrame:
    """Rules ``antecedent -> verdict`` from ``(tokens, label)`` rows, pruned.

    A rule rests on ``min_support`` of the rows and on ``LEAST_ROWS`` of them at least: of few labels, every
    subset of every URL's tokens would be frequent otherwise. Kept are rules with enough support and confidence that no shorter rule with the same verdict
    matches in confidence (its antecedent being part of theirs). Tokens that more than 99 in 100 of all
    ``urls`` have cannot tell any apart and are not mined; without them itemsets stay few.
    """
    rows = keep(labelled.where(F.size("tokens") > 0).select("tokens", "label"))
    total = rows.count()
    schema = "rule_id long, antecedent array<string>, verdict string, confidence double, support double"
    if total < LEAST_ROWS:
        return rows.sparkSession.createDataFrame([], schema)
    counts = urls.select(F.explode("tokens").alias("token")).groupBy("token").count()
    many = 0.99 * urls.where(F.size("tokens") > 0).count()
    everywhere = counts.where(F.col("count") > many).select(F.collect_list("token"))
    common = everywhere.first()[0]  # fewer than 1.02 times the tokens of one URL
    items = rows.select(
        F.array_union(
            F.array_except("tokens", F.array(*[F.lit(x) for x in common]).cast("array<string>")),
            F.array(F.concat(F.lit("="), F.col("label"))),
        ).alias("items")
    )
    support = max(min_support, LEAST_ROWS / total)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    label = F.col("consequent")[0]
    found = model.associationRules.where(label.startswith("=")).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(label, 2, 100).alias("verdict"),
        "confidence",
        "support",
    )
    found = keep(found.where(F.size(F.filter("antecedent", lambda x: x.startswith("="))) == 0))
    # A shorter rule is looked up under one of its tokens, so no two rules meet without sharing one.
    general = found.select(
        F.col("antecedent").alias("part"),
        F.col("verdict").alias("part_verdict"),
        F.col("confidence").alias("part_confidence"),
        F.element_at("antecedent", 1).alias("token"),
    )
    special = found.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("token"))
    dominated = (
        special.join(general, "token")
        .where(
            (F.col("verdict") == F.col("part_verdict"))
            & (F.size("part") < F.size("antecedent"))
            & (F.col("part_confidence") >= F.col("confidence"))
            & (F.size(F.array_except("part", "antecedent")) == 0)
        )
        .select("antecedent", "verdict")
        .distinct()
    )
    kept = found.join(dominated, ["antecedent", "verdict"], "left_anti")
    return kept.select(
        F.xxhash64("antecedent", "verdict").alias("rule_id"), "antecedent", "verdict", "confidence", "support"
    )


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct ``tokens`` the most confident rule whose antecedent it contains.

    ``tokens, verdict, confidence, antecedent``; token sets without a rule are absent. Ties go to the
    higher support, the longer antecedent, then the smaller antecedent by its words.
    """
    sets = urls.select("tokens").distinct()
    frequency = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("sets"))
    listed = (
        rules.select("rule_id", F.explode("antecedent").alias("token"))
        .join(frequency, "token", "left")
        .groupBy("rule_id")
        .agg(F.min_by("token", F.struct(F.coalesce("sets", F.lit(0)), "token")).alias("token"))
        .join(rules, "rule_id")
    )
    postings = sets.select("tokens", F.explode("tokens").alias("token"))
    better = F.struct(
        -F.col("confidence"), -F.col("support"), -F.size("antecedent"), "antecedent", "verdict"
    )
    return (
        postings.join(listed, "token")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
        .groupBy("tokens")
        .agg(F.min_by(F.struct("verdict", "confidence", "antecedent"), better).alias("best"))
        .select("tokens", "best.*")
    )


def judged(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    labels: DataFrame | None = None,
    min_support: float = 0.002,
    min_confidence: float = 0.8,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence, antecedent``, one row per row of ``pages``.

    The longest given rule decides; else the best mined rule; else the URL is allowed. What is mined:
    URLs that a given rule decides carry its verdict, hosts with a seed word are labelled ``block``,
    and ``labels(page_id, label)`` may add more (NULL labels and unknown pages are ignored; of several
    labels for a page ``block`` counts). NULL URLs and those without ``://`` have empty host and path,
    no tokens, and are allowed. Repeated rows are judged alike; other columns are ignored; no rows in,
    no rows out.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, says = longest_rule(F.col("host"), F.col("path"), rules)
    tokens = url_tokens(F.col("url"), F.col("host"), F.col("path"))
    seeded = reduce(
        lambda a, b: a | b, [F.array_contains("tokens", f"host:{word}") for word in SEED_WORDS]
    )
    rows = rows.withColumns({"rule": rule, "says": says, "tokens": tokens})
    rows = keep(rows.withColumn("label", F.coalesce("says", F.when(seeded, F.lit(BLOCK)))).drop("url"))
    labelled = rows.where(F.col("label").isNotNull()).select("tokens", "label")
    if labels is not None:
        given = (
            labels.where(F.col("label").isin(ALLOW, BLOCK))
            .groupBy("page_id")
            .agg(F.max("label").alias("given"))
        )
        unlabelled = rows.where(F.col("label").isNull()).select("page_id", "tokens")
        labelled = labelled.unionByName(
            unlabelled.join(given, "page_id").select("tokens", F.col("given").alias("label"))
        )
    mined = keep(mined_rules(labelled, rows.select("tokens"), min_support, min_confidence))
    best = best_rules(rows.where(F.col("says").isNull()), mined).withColumnRenamed("verdict", "learned")
    return rows.join(best, "tokens", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("says", "learned", F.lit(ALLOW)).alias("verdict"),
        F.when(F.col("says").isNull(), F.col("confidence")).alias("confidence"),
        F.when(F.col("says").isNull(), F.array_join("antecedent", " ")).alias("antecedent"),
    )
