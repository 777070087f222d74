"""Family selection, column checks and expression columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqspark.functions.sequence import condition_of

# Numeric columns that are never expression values, and the name parts that mark an
# expression column when no numeric one is left.
NOT_EXPRESSION = ("start", "stop", "Unnamed: 0", "chr", "Cluster", "_total_expr")
SAMPLE_PREFIXES = ("A1_", "A2_", "A3_", "B1_", "B2_", "B3_", "C1_", "C2_", "C3_")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail with the missing and the available columns, or return ``df``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}. Available columns: {df.columns}")
    return df


def _matches(text: Column, pattern: str, literal: bool) -> Column:
    if literal:
        return F.contains(F.lower(text), F.lower(F.lit(pattern)))
    return F.rlike(text, F.lit(f"(?i){pattern}"))


def filter_family(df: DataFrame, pattern: str, name: str = "TE_name", literal: bool = False) -> DataFrame:
    """Rows whose name contains the pattern, a regex unless ``literal``; any case, NULL never."""
    return df.where(_matches(F.col(name), pattern, literal))


def family_names(df: DataFrame, name: str = "TE_name", n: int = 20) -> DataFrame:
    """A few of the distinct names, in name order, and how many there are."""
    names = df.select(F.col(name).alias("name")).distinct()
    counted = names.agg(F.count("name")).scalar()
    return names.where(F.col("name").isNotNull()).orderBy("name").limit(n).select(
        "name", counted.alias("distinct_names")
    )


def preview_count(df: DataFrame, pattern: str) -> DataFrame:
    """Rows of which any column matches the pattern, in any case."""
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    return df.where(_matches(line, pattern, False)).agg(F.count(F.lit(1)).alias("matches"))


def seq_presence(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Whether every row has its sequence."""
    missing = F.count_if(F.col(seq).isNull())
    return df.agg(
        F.count(F.lit(1)).alias("rows"), missing.alias("missing"), (missing == 0).alias("all_present")
    )


def expression_columns(df: DataFrame, exclude: Sequence[str] = NOT_EXPRESSION) -> list[str]:
    """Numeric columns that are not known to be something else, else columns named like samples."""
    numeric = [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
    return numeric or [c for c in df.columns if any(p in c for p in SAMPLE_PREFIXES)]


def sample_conditions(columns: Sequence[str]) -> dict[str, list[str]]:
    """Expression columns by condition, in order of condition name."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        condition = condition_of(c)
        if condition is not None:
            groups.setdefault(condition, []).append(c)
    return dict(sorted(groups.items()))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum over columns with missing values as 0; 0 without columns."""
    def value(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v)

    return reduce(lambda a, b: a + b, [value(c) for c in columns], F.lit(0.0))


def with_total_expr(df: DataFrame, columns: Sequence[str], name: str = "total_expr") -> DataFrame:
    return df.withColumn(name, row_sum(columns))
