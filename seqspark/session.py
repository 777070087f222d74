"""Session-level helpers: parallelism, shared scratch space, checked broadcast, null-safe joins."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Largest table that is broadcast, in bytes.
MAX_BROADCAST = 64 * 1024 * 1024

# Parts a group is spread over when a per-group table is too large to broadcast.
SALTS = 32


def width(spark: SparkSession) -> int:
    """Partition count for an explicit repartition.

    Used in front of operators that multiply their input (k-mers are ~20x the text), where the
    post-shuffle sizes adaptive execution would coalesce on say nothing about the work to come.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables, as the session names it.

    Only a local session without the setting gets a folder of its own. Whoever needs the folder is about to
    run this package's code in workers, so that is sent there, too.
    """
    ship_package(spark)
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if not root:
        root = context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="seqspark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session; they need not find it on their own path."""
    context = spark.sparkContext
    if getattr(context, "_seqspark_shipped", False):
        return
    package = Path(__file__).resolve().parent
    if package.parent.is_dir():
        archive = Path(tempfile.mkdtemp(prefix="seqspark-")) / "seqspark-package.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, str(file.relative_to(package.parent)))
        context.addPyFile(str(archive))
    context._seqspark_shipped = True


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cut the lineage and pin values that several branches must agree on."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def _value_bytes(name: str, kind: T.DataType) -> Column:
    """Size of a value as it is held in memory, an upper estimate for the types used here."""
    if isinstance(kind, T.MapType | T.StructType):
        raise TypeError(f"size of {kind.simpleString()} column {name!r} is not measured")
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType | T.BinaryType):
            inner = F.aggregate(name, F.lit(0).cast("bigint"), lambda n, e: n + F.coalesce(F.octet_length(e), F.lit(0)) + 16)
            return F.coalesce(inner, F.lit(0)) + 24
        fields = len(kind.elementType.fields) if isinstance(kind.elementType, T.StructType) else 1
        return F.coalesce(F.size(name), F.lit(0)) * (8 * fields + 16) + 24
    return F.lit(16)


def is_small(df: DataFrame, max_bytes: int = MAX_BROADCAST) -> bool:
    """Whether a table fits in ``max_bytes``, measured over all its rows. Pass a settled table."""
    size = reduce(lambda a, b: a + b, [_value_bytes(f.name, f.dataType) for f in df.schema.fields], F.lit(16))
    return (df.agg(F.sum(size.cast("bigint"))).first()[0] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST) -> DataFrame:
    """Broadcast a settled table whose measured size is small; otherwise leave Spark a shuffled join."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which a NULL group matches the NULL group."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def join_groups(
    rows: DataFrame, table: DataFrame, by: Sequence[str], row_id: str, how: str = "inner",
    max_bytes: int = MAX_BROADCAST,
) -> DataFrame:
    """Join rows with a table holding one row per group, however many rows a group has.

    The table is settled and measured. A small one is broadcast, so the rows stay where they are. A larger
    one is repeated once per salt and the rows are salted by id: no task gets a whole group.
    """
    table = settle(table)
    if is_small(table, max_bytes):
        return join_on(rows, F.broadcast(table), by, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return join_on(salted, repeated, [*by, "_salt"], how).drop("_salt")
