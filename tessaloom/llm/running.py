"""Running sums within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessaloom.session import small_side

#: Rows of one group that are summed in one task; groups with more are summed in parts.
ROWS_A_PART = 100_000


def running(df: DataFrame, group: str, order: list[str], weight: Column, part_rows: int = ROWS_A_PART) -> DataFrame:
    """df with `_at`, the sum of the weights of a group's rows before a row, in an order by hash and then by `order`.

    Groups are cut into parts by hash, as many as their counted rows need, so
    no task holds a whole large group. The parts' offsets are running sums over
    one small row for each part.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_rows"))
    hashed = F.xxhash64(*order)
    parts = df.join(small_side(sizes), group).withColumn("_part", F.pmod(hashed, F.ceil(F.col("_rows") / part_rows))).withColumn("_weight", weight.cast("bigint")).drop("_rows")
    counted = parts.groupBy(group, "_part").agg(F.sum("_weight").alias("_n"))
    offsets = counted.select(group, "_part", (F.sum("_n").over(Window.partitionBy(group).orderBy("_part")) - F.col("_n")).alias("_before"))
    within = F.sum("_weight").over(Window.partitionBy(group, "_part").orderBy(hashed, *order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_weight")
    return parts.withColumn("_within", within).join(small_side(offsets), [group, "_part"]).withColumn("_at", F.col("_within") + F.col("_before")).drop("_within", "_before", "_part", "_weight")
