"""Row positions of a sorted DataFrame, as a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint


def with_position(ordered: DataFrame, name: str, through: str | None = None) -> DataFrame:
    """``name`` = 1, 2, ... in the order of a globally sorted DataFrame.

    A sorted result is range-partitioned: the position is the row's place in its
    partition plus the sizes of the partitions before it (one row per partition). The sorted
    rows are checkpointed, or written as Parquet, a fraction of that, to the shared folder
    ``through``, which must stay as long as the result is read.
    """
    low = (1 << 33) - 1
    rows = ordered.select("*", F.spark_partition_id().alias("_part"),
                          F.monotonically_increasing_id().bitwiseAND(F.lit(low)).alias("_at"))
    if through is None:
        rows = checkpoint(rows)
    else:
        rows.write.parquet(through)
        rows = rows.sparkSession.read.schema(rows.schema).parquet(through)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return rows.join(F.broadcast(before), "_part").withColumn(
        name, (F.col("_before") + F.col("_at") + 1).cast("long")).drop("_part", "_at", "_before")
