"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqspark.llm.common import join_groups, settle

# A larger mean is split into equal parts of at most this size, whose draws are added.
MAX_MEAN = 16.0

# Draws of one part that have a probability a 52-bit uniform number can meet.
MAX_DRAW = 63

_ADDED = ["copy", "rate", "shuffle_key"]


def _hex(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def _uniform(hashed: Column) -> Column:
    """52 bits of a hexadecimal hash as a number in [0, 1)."""
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def source_rates(
    docs: DataFrame, weights: Mapping[str, float], default_weight: float = 1.0, source: str = "source", text: str = "text"
) -> DataFrame:
    """Per source: ``source, size, weight, rate``.

    Size counts characters, and one more for the end of each document, so that it is never zero. The rate is
    how often a document has to be repeated on average for the source to hold its share of the present total.
    Sources the weights do not name get ``default_weight``; a null source is one of them.
    """
    if min([default_weight, *weights.values()]) < 0 or not all(map(math.isfinite, [default_weight, *weights.values()])):
        raise ValueError("weights must be finite and not negative")
    weight = F.lit(float(default_weight))
    for name, value in weights.items():
        weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    size = F.coalesce(F.length(text), F.lit(0)) + F.lit(1)
    sizes = settle(
        docs.groupBy(F.col(source).alias("source")).agg(F.sum(size.cast("bigint")).alias("size")).withColumn("weight", weight)
    )
    total, weight_sum = sizes.agg(F.sum("size"), F.sum("weight")).first()
    scale = float(total or 0)
    rate = F.when(
        F.lit(float(weight_sum or 0)) > 0,
        (F.col("weight") * F.lit(scale)) / (F.lit(float(weight_sum or 1)) * F.col("size").cast("double")),
    ).otherwise(F.lit(0.0))
    return sizes.withColumn("rate", rate)


def _with_distribution(rates: DataFrame) -> DataFrame:
    """Adds the number of ``parts`` and the cumulative distribution ``cdf`` of one part's draws."""
    mean = F.col("rate") / F.col("parts")
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(MAX_DRAW)),
        F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf")),
        lambda s, k: F.struct(
            (s["p"] * mean / k).alias("p"),
            F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * mean / k)).alias("cdf"),
        ),
        lambda s: s["cdf"],
    )
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(MAX_MEAN))).cast("int")
    return rates.withColumn("parts", parts).withColumn("cdf", grown)


def mix_sources(
    docs: DataFrame, weights: Mapping[str, float], default_weight: float = 1.0, seed: int = 0,
    doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """Repeat every document a Poisson number of times so that sources reach their weights, then shuffle.

    Returns all columns of ``docs`` with ``copy`` (from 1), ``rate`` and ``shuffle_key``, in the order of that
    key; a column of such a name in ``docs`` is replaced. The number of copies is the smallest k whose
    cumulative Poisson probability exceeds a uniform number taken from a hash of seed and id. It depends on
    nothing else, so a lost task gives the same rows again.

    Null ids hash like empty text. A null text has size 0 (plus one, as all). Repeated rows get equal counts.
    A source of weight 0 vanishes; with all weights 0 so does everything. An empty table stays empty.
    """
    docs = docs.drop(*_ADDED)
    rates = _with_distribution(source_rates(docs, weights, default_weight, source, text))
    table = rates.select(F.col("source").alias(source), "rate", F.col("parts").alias("_parts"), F.col("cdf").alias("_cdf"))
    joined = join_groups(docs, table, [source], doc_id)
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))

    def draw(part: Column) -> Column:
        u = _uniform(_hex(seed, name, part.cast("string")))
        return F.size(F.filter("_cdf", lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("_parts")), F.lit(0), lambda n, part: n + draw(part))
    repeated = (
        joined.withColumn("_n", F.when(F.col("rate") > 0, count).otherwise(F.lit(0)))
        .where("_n > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    )
    key = _hex(seed, F.lit("order"), name, F.col("copy").cast("string"))
    return repeated.select(*docs.columns, "copy", "rate", key.alias("shuffle_key")).orderBy("shuffle_key", "copy")


def mixing_sql(weights: Mapping[str, float], default_weight: float, seed: int, documents: str = "documents") -> str:
    """The rows of ``mix_sources`` over a table with the columns of ``documents``."""
    weight = " ".join(f"WHEN source = '{k}' THEN {float(v)!r}::DOUBLE" for k, v in weights.items())
    return f"""
WITH sized AS (SELECT source, sum(coalesce(length(text), 0) + 1)::BIGINT AS size FROM {documents} GROUP BY source),
weighed AS (SELECT *, CASE {weight} ELSE {float(default_weight)!r}::DOUBLE END AS weight FROM sized),
rated AS (SELECT source, (weight * (SELECT sum(size) FROM sized)::DOUBLE)
    / ((SELECT sum(weight) FROM weighed) * size::DOUBLE) AS rate FROM weighed),
parted AS (SELECT source, rate, greatest(1, ceil(rate / {MAX_MEAN}))::INTEGER AS parts FROM rated),
mass AS (SELECT source, k, exp(-rate / parts) * list_product(list_concat([1.0::DOUBLE],
    list_transform(range(1, k + 1), lambda j: rate / parts / j))) AS p
  FROM parted, range(0, {MAX_DRAW + 1}) AS r(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM mass),
draw AS (SELECT d.*, r.rate, part, (('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || part), 1, 13))
    ::BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM {documents} d JOIN parted r ON d.source IS NOT DISTINCT FROM r.source, range(1, r.parts + 1) AS q(part)),
drawn AS (SELECT doc_id, part, count(*) AS n FROM draw JOIN cdf ON draw.source IS NOT DISTINCT FROM cdf.source AND cdf.c <= draw.u
  GROUP BY ALL),
counted AS (SELECT doc_id, sum(n) AS n FROM drawn GROUP BY doc_id)
SELECT d.*, copy, rate, md5('{seed}|order|' || coalesce(d.doc_id::VARCHAR, '') || '|' || copy) AS shuffle_key
FROM {documents} d JOIN counted USING (doc_id) JOIN parted r ON d.source IS NOT DISTINCT FROM r.source,
  range(1, counted.n::BIGINT + 1) AS c(copy)"""
