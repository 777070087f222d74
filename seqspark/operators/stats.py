"""Descriptive statistics per group, with exact quantiles that scale."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqspark.functions.sequence import cluster_label, gc_fraction
from seqspark.operators.exact import Limbs
from seqspark.operators.filters import row_sum, sample_conditions
from seqspark.session import join_on, settle

QUARTILES = (0.25, 0.5, 0.75)
# Values of a group are cut into STEP * STEP buckets.
STEP = 16

NOISE = -1


def quantiles(
    df: DataFrame, value: str, by: Sequence[str], probs: Sequence[float] = QUARTILES, weight: str | None = None
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group: columns ``p0``, ``p1``, ...

    With ``weight``, a row stands for that many equal ones.
    The built-in exact percentile holds every distinct value of a group in one task. Here values are
    counted first, cut into buckets at approximate quantiles of the group, and only the few buckets in
    which a wanted rank falls are sorted. The cut points merely decide who sorts what, so their error
    does not reach the result.
    """
    by = list(by)
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    hist = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(rows.alias("_n"))
    cuts = [i / STEP**2 for i in range(1, STEP**2)]
    frame = hist.groupBy(*by).agg(
        F.percentile_approx("_v", cuts, 2_000).alias("_cuts"), F.sum("_n").alias("_total")
    )
    # Every STEP-th cut first, then the cuts up to the next of these.
    coarse = F.transform(F.sequence(F.lit(STEP), F.lit(STEP * (STEP - 1)), F.lit(STEP)), lambda i: F.col("_cuts")[i - 1])

    def below(limits: Column) -> Column:
        return F.size(F.filter(limits, lambda c: c < F.col("_v")))

    binned = (
        join_on(hist, frame.withColumn("_coarse", coarse), by)
        .withColumn("_step", below(F.col("_coarse")) * STEP)
        .select(
            *by, "_v", "_n", "_total",
            (F.col("_step") + below(F.slice("_cuts", F.col("_step") + 1, F.lit(STEP - 1)))).alias("_bucket"),
        )
    )
    ranks = [(F.col("_total") - 1) * F.lit(float(p)) for p in probs]
    wanted = [(F.floor(r), F.ceil(r)) for r in ranks]
    upto = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sizes = binned.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_size"), F.max("_total").alias("_total"))
    edges = sizes.withColumn("_from", F.sum("_size").over(upto) - F.col("_size"))

    def holds(first: Column, count: Column, rank: Column) -> Column:
        return (first <= rank) & (rank < first + count)

    needed = edges.where(
        reduce(
            lambda a, b: a | b,
            [holds(F.col("_from"), F.col("_size"), r) for pair in wanted for r in pair],
        )
    ).select(*by, "_bucket", "_from")
    inside = Window.partitionBy(*by, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_on(binned, needed, [*by, "_bucket"]).withColumn(
        "_first", F.col("_from") + F.sum("_n").over(inside) - F.col("_n")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(holds(F.col("_first"), F.col("_n"), rank), F.col("_v")))

    parts = [
        e
        for i, (low, high) in enumerate(wanted)
        for e in (
            at(low).alias(f"_low{i}"),
            at(high).alias(f"_high{i}"),
            F.max(ranks[i] - low).alias(f"_share{i}"),
        )
    ]
    found = ranked.groupBy(*by).agg(*parts)
    return found.select(
        *by,
        *[
            (F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_share{i}")).alias(f"p{i}")
            for i in range(len(probs))
        ],
    )


def long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), name: str = "metric") -> DataFrame:
    """Columns as ``(by, metric, value)`` rows; NaN becomes NULL."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([*by], list(columns), name, "_value").select(
        *by, name, F.when(~F.isnan("_value"), F.col("_value")).alias("value")
    )


def describe_long(long: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Count, mean, sd (n-1), min, max, quartiles and positive share per group of a long table.

    Means come from exact sums, so they are the same however the rows are dealt.
    """
    summary = long.groupBy(*by).agg(
        F.count(value).alias("n"),
        Limbs.of(long, value).mean(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count_if(F.col(value) > 0).alias("nonzero"),
        (F.count_if(F.col(value) > 0) * 100.0 / F.count(F.lit(1))).alias("nonzero_pct"),
    )
    return join_on(summary, quantiles(long, value, by), by, "left").withColumnsRenamed(
        {"p0": "q1", "p1": "median", "p2": "q3"}
    )


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row of statistics per group and column (``metric``).

    The columns are settled as plain numbers: they are gone through several times, the texts they come from once.
    """
    numbers = settle(df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]))
    return describe_long(long_form(numbers, columns, by), [*by, "metric"])


def seq_features(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Add ``length`` and ``gc``."""
    return df.withColumn("length", F.length(seq).cast("bigint")).withColumn("gc", gc_fraction(seq))


def chart_features(df: DataFrame, seq: str = "seq") -> DataFrame:
    """``length`` and ``gc`` as charts count them: an empty sequence has a gc share of 0."""
    features = seq_features(df, seq)
    return features.withColumn("gc", F.when(F.col(seq).isNotNull(), F.coalesce("gc", F.lit(0.0))))


def condition_totals(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per-row sums of each condition's samples, as ``(by, condition, replicates, value)`` rows."""
    groups = sample_conditions(columns)
    wide = settle(df.select(*by, *[row_sum(cols).alias(c) for c, cols in groups.items()]))
    replicates = F.create_map(*[F.lit(x) for c, cols in groups.items() for x in (c, len(cols))])
    return wide.unpivot([*by], list(groups), "condition", "value").withColumn(
        "replicates", replicates[F.col("condition")]
    )


def condition_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Statistics of the per-row condition sums; no rows unless there are two conditions."""
    several = len(sample_conditions(columns)) > 1
    totals = condition_totals(df, columns, by).where(F.lit(several))
    return describe_long(totals, [*by, "condition", "replicates"]).select(
        *by, "condition", "replicates", "mean", "median", "sd"
    )


def condition_by_cluster(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean per-row condition sum for each cluster."""
    totals = condition_totals(df, columns, [cluster])
    return totals.groupBy(cluster, "condition").agg(Limbs.of(totals, "value").mean("value").alias("mean"))


def expression_matrix(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean of every sample per cluster, one column per sample."""
    limbs = Limbs.of(df, *columns)
    return df.groupBy(cluster).agg(*[limbs.mean(c).alias(c) for c in columns])


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows per cluster, with the noise group marked."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size")).withColumn(
        "is_noise", F.col(cluster) == NOISE
    )


def cluster_summary(
    df: DataFrame, seq: str | None = "seq", columns: Sequence[str] = (), cluster: str = "cluster"
) -> DataFrame:
    """Size, mean and median length and GC, and total expression when there are expression columns.

    Without ``seq`` the table already has ``length`` and ``gc``.
    """
    features = seq_features(df, seq) if seq else df
    metrics = ["length", "gc"]
    if columns:
        features = features.withColumn("total_expr", row_sum(columns))
        metrics.append("total_expr")
    features = settle(features.select(cluster, *metrics))
    limbs = {m: Limbs.of(features, m) for m in metrics}
    means = features.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"),
        *[limbs[m].mean(m).alias(f"mean_{m}") for m in metrics],
        *([limbs["total_expr"].sum("total_expr").alias("sum_total_expr")] if columns else []),
    )
    medians = quantiles(long_form(features, metrics, [cluster]), "value", [cluster, "metric"], [0.5])
    wide = medians.groupBy(cluster).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("p0"))).alias(f"median_{m}") for m in metrics]
    )
    return join_on(means, wide, [cluster], "left")


def cluster_comparison(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Share of each cluster, number of clusters without noise, and number of noise rows."""
    sizes = cluster_sizes(df, cluster)
    real = F.col(cluster) != NOISE
    totals = sizes.agg(
        F.struct(
            F.sum("size").alias("total"),
            F.count_if(real).alias("n_clusters"),
            F.coalesce(F.sum(F.when(~real, F.col("size"))), F.lit(0)).alias("noise"),
        )
    ).scalar()
    return sizes.withColumn("_t", totals).select(
        cluster,
        "size",
        (F.col("size") * 100.0 / F.col("_t.total")).alias("share_pct"),
        F.col("_t.total").alias("total"),
        F.col("_t.n_clusters").alias("n_clusters"),
        F.col("_t.noise").alias("noise"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value; empty bins left out."""
    values = df.select(F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    edges = values.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high"))).scalar()
    placed = values.withColumn("_e", edges)
    low, high = F.col("_e.low"), F.col("_e.high")
    size = (high - low) / bins
    index = F.when(high > low, F.least(F.lit(bins - 1), F.floor((F.col("_v") - low) / size))).otherwise(0)
    counted = placed.groupBy(index.cast("int").alias("bin"), "_e").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "bin",
        (low + F.col("bin") * size).alias("bin_start"),
        (low + (F.col("bin") + 1) * size).alias("bin_stop"),
        "n",
    )


def box_summary(df: DataFrame, column: str, cluster: str = "cluster") -> DataFrame:
    """Quartiles and whiskers (outermost values within 1.5 interquartile ranges) per cluster."""
    values = settle(df.select(cluster, F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull()))
    quarts = quantiles(values, "_v", [cluster])
    reach = (F.col("p2") - F.col("p0")) * 1.5
    # Distinct values are enough for the whiskers, and far fewer than rows.
    distinct = values.groupBy(cluster, "_v").agg(F.count(F.lit(1)).alias("_n"))
    whiskers = join_on(distinct, quarts, [cluster]).groupBy(cluster).agg(
        F.sum("_n").alias("n"),
        F.max("p0").alias("q1"),
        F.max("p1").alias("median"),
        F.max("p2").alias("q3"),
        F.min(F.when(F.col("_v") >= F.col("p0") - reach, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(F.col("_v") <= F.col("p2") + reach, F.col("_v"))).alias("whisker_high"),
    )
    return whiskers.withColumn("label", cluster_label(cluster))
