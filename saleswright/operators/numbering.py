"""Dense row numbers and new keys without putting all rows on one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.session import shared_folder

# monotonically_increasing_id() keeps the partition above bit 33, the place in it below.
_PLACE_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str = "rn") -> DataFrame:
    """``df`` sorted by ``order``, with numbers 1, 2, 3, ... in column ``name``.

    ``order`` must end in a unique key: it fixes the order of ties, and it lets rows with
    one hot sort value spread over many partitions.

    The rows are range-partitioned and sorted once, marked with partition and place, and
    written to the checkpoint folder. The mark is then a stored value that a lost executor
    cannot change, and only the row counts per partition are added up in one task.
    """
    shared_folder(df.sparkSession)
    marked = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_mark", _PLACE_BITS))
    )
    # As many rows as there were partitions, which bounds both this window and the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        marked.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    place = F.col("_mark").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return marked.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + place + 1).alias(name)
    )


def assign_ids(
    rows: DataFrame, existing: DataFrame, key: str, order: list[Column], name: str | None = None
) -> DataFrame:
    """Give new rows unique keys above the highest key of ``existing``, from 1 if empty."""
    highest = existing.agg(F.coalesce(F.max(key).cast("long"), F.lit(0).cast("long"))).scalar()
    numbered = number_rows(rows, order, "_number")
    return numbered.select(*rows.columns, (highest + F.col("_number")).alias(name or key))
