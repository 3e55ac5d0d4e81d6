"""What operators need of a session: tables, spreading, cut lineage, checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a computed side may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part where the input has fewer parts than the cluster has cores.

    Inputs of many files or blocks are left as they are, so this costs no shuffle at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def durable(df: DataFrame) -> DataFrame:
    """Compute df once and keep it in the shared checkpoint folder.

    The folder is spark.checkpoint.dir where the session names one. Only where it is
    unset and all runs in one process, as in tests, a temporary folder is taken;
    on a cluster that raises.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessaloom-"))
    return df.checkpoint(eager=True)


def small_side(df: DataFrame) -> DataFrame:
    """A computed side of a join, hinted for broadcast only if its counted rows and bytes stay under the bounds.

    Beyond them it is returned without a hint and Spark joins by shuffling, where
    adaptive execution splits hot keys.
    """
    kept = durable(df)
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in kept.columns), F.lit(0))
    rows, size = kept.select(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(kept) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else kept


def blank(c: Column | str) -> Column:
    """True where a string is null or has nothing but white space."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | ~c.rlike(r"(?U)[^\s\x1c-\x1f]")
