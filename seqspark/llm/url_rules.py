"""Url filtering by rules given and by rules mined with FP-growth, in DataFrame functions only."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqspark.llm.common import broadcast_if_small, join_groups, settle

ALLOW, BLOCK = "allow", "block"

MIN_SUPPORT = 0.002
# Urls a combination has to stand for, however few are labelled.
MIN_COUNT = 20
MIN_CONFIDENCE = 0.8

_LABEL = "verdict="
_ADDED = ["host", "path", "rule", "verdict", "learned", "confidence"]


def url_host(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.col(url), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: str = "url") -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(rules: Sequence[tuple[str, str]], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits.

    A rule is ``(host/path, verdict)`` and fits its host and all subdomains, if the path starts with its own.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, _, rest = text.partition("/")
        fits = ((F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)) & F.col(path).startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: str = "url", host: str = "host", path: str = "path") -> Column:
    """Tokens of a url, one for each of ten places, so that the combinations of a url stay few.

    Scheme, top-level domain, domain, what stands before it, first, second and last path segment, extension,
    names of the query's keys, and fragment. Digits count as 0.
    """
    def shape(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), "[0-9]+", "0")

    labels = F.split(F.col(host), r"\.")
    segments = F.filter(F.split(F.col(path), "/"), lambda s: s != "")
    last = F.element_at(segments, -1)
    query = F.regexp_extract(F.col(url), r"(?s)\?([^#]*)", 1)
    keys = F.array_join(F.array_sort(F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))), "&")
    places = [
        ("scheme", F.lower(F.regexp_extract(F.col(url), r"(?s)\A(.*?)://", 1))),
        ("top", F.element_at(labels, -1)),
        ("domain", F.when(F.size(labels) > 1, F.element_at(labels, -2))),
        ("sub", F.when(F.size(labels) > 2, F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), "."))),
        ("first", F.when(F.size(segments) > 0, shape(F.element_at(segments, 1)))),
        ("second", F.when(F.size(segments) > 1, shape(F.element_at(segments, 2)))),
        ("last", F.when(F.size(segments) > 2, shape(last))),
        ("type", F.when(F.size(segments) > 0, F.lower(F.regexp_extract(last, r"\.([A-Za-z0-9]+)\z", 1)))),
        ("keys", F.when(query != "", keys)),
        ("fragment", F.regexp_extract(F.col(url), "(?s)#(.+)", 1)),
    ]
    named = F.array(*[F.when(value != "", F.concat(F.lit(f"{name}:"), value)) for name, value in places])
    return F.coalesce(F.filter(named, lambda t: t.isNotNull()), F.array().cast("array<string>"))


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Rules ``rule_id, antecedent, learned, confidence, support`` from ``(tokens, verdict)`` rows.

    FP-growth counts every labelled row. A rule needs the support and the confidence, and is dropped if one
    of its own parts alone gives the same verdict with no less confidence.
    """
    total = labelled.count()
    empty = labelled.sparkSession.createDataFrame(
        [], "rule_id bigint, antecedent array<string>, learned string, confidence double, support double"
    )
    support = max(min_support, min_count / total) if total else 2.0
    if support > 1:
        return empty
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(_LABEL), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    found = model.associationRules.where(F.element_at("consequent", 1).startswith(_LABEL)).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(F.element_at("consequent", 1), len(_LABEL) + 1, 100).alias("learned"), "confidence", "support",
    )
    rules = settle(found).withColumn("rule_id", F.monotonically_increasing_id())
    # A rule's parts with one token less are looked up by their own text, not compared in pairs.
    parts = rules.where(F.size("antecedent") > 1).select(
        "rule_id", "learned", F.col("confidence").alias("_c"), F.explode("antecedent").alias("_out"), "antecedent"
    ).select("rule_id", "learned", "_c", F.array_except("antecedent", F.array("_out")).alias("antecedent"))
    smaller = rules.select("antecedent", "learned", F.col("confidence").alias("_p"))
    redundant = parts.join(smaller, ["antecedent", "learned"]).where("_p >= _c").select("rule_id").distinct()
    return settle(rules.join(redundant, "rule_id", "left_anti").select(*empty.columns))


def match_rules(token_sets: DataFrame, rules: DataFrame, labelled_tokens: DataFrame) -> DataFrame:
    """The strongest rule of each distinct ``tokens`` row: ``tokens, learned, confidence``.

    The inverted index lists a rule under its rarest token; a url opens the lists of its own tokens and
    checks the rest of each rule there. The most confident rule wins, then the better supported, the longer
    one, and block before allow.
    """
    counts = labelled_tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("_n"))
    placed = rules.select("rule_id", "antecedent", "learned", "confidence", "support", F.explode("antecedent").alias("token")).join(
        counts, "token"
    )
    rarest = Window.partitionBy("rule_id").orderBy("_n", "token")
    index = settle(placed.withColumn("_r", F.row_number().over(rarest)).where("_r = 1").drop("_r", "_n"))
    opened = token_sets.select("tokens", F.explode("tokens").alias("token")).join(broadcast_if_small(index), "token")
    fired = opened.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    strength = F.struct(
        "confidence", "support", F.size("antecedent").alias("n"), (F.col("learned") == BLOCK).alias("b"), "learned"
    )
    return fired.groupBy("tokens").agg(F.max(strength).alias("_best")).select(
        "tokens", F.col("_best.learned").alias("learned"), F.col("_best.confidence").alias("confidence")
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], labels: DataFrame | None = None, default: str = ALLOW,
    min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE,
    page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """Judge every row: its columns and ``host, path, rule, verdict, learned, confidence``.

    Urls that a given rule decides get its verdict. They are also the labels from which rules over token
    combinations are mined, unless ``labels`` (``url, verdict``) gives others. Remaining urls get the verdict
    of their strongest mined rule, or ``default`` where none fires.

    Null urls and urls without ``://`` have an empty host and path, fit no given rule and go the same way.
    Repeated rows are judged alike, each for itself. Columns with the names added are replaced. An empty
    table stays empty; with too few labels nothing is mined.
    """
    kept = pages.drop(*_ADDED)
    parsed = kept.withColumn("host", url_host(url)).withColumn("path", url_path(url))
    rule, says = given_rule(rules)
    parsed = parsed.withColumn("rule", rule).withColumn("_says", says).withColumn("_tokens", url_tokens(url))
    if labels is None:
        labelled = parsed.where(F.col("_says").isNotNull()).select(F.col("_tokens").alias("tokens"), F.col("_says").alias("verdict"))
    else:
        known = labels.select(F.col("url").alias(url), "verdict").where(F.col("verdict").isin(ALLOW, BLOCK))
        known = known.withColumn("host", url_host(url)).withColumn("path", url_path(url))
        labelled = known.select(url_tokens(url).alias("tokens"), "verdict")
    labelled = settle(labelled)
    mined = mine_rules(labelled, min_support, min_count, min_confidence)
    open_sets = parsed.where(F.col("_says").isNull()).select(F.col("_tokens").alias("tokens")).distinct()
    learned = match_rules(open_sets, mined, labelled).withColumnRenamed("tokens", "_tokens")
    judged = join_groups(parsed, learned, ["_tokens"], page_id, "left")
    return judged.select(
        *kept.columns, "host", "path", "rule",
        F.coalesce("_says", "learned", F.lit(default)).alias("verdict"), "learned", "confidence",
    )
