"""Time joins and sums over tables made larger, a third of all rows on one key.

python bench_skewed.py FOLDER TIMES [OUT]: the tables of FOLDER are repeated TIMES times under keys of
their own into OUT (by default a folder of its own under /tmp), with every third line on one order and
every third order on one customer, and each query is run once with broadcast joins off.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.plans.catalog import QUERIES
from saleswright.session import clear_scratch, local_session

TIMED = [
    "join_inner",
    "join_left",
    "join_group_sum",
    "join_three_way",
    "join_three_way_bucketed",
    "view_sales_by_month",
    "in_subquery",
    "check_primary_key",
    "check_foreign_key",
]
KEYS = {
    "customer": ["c_custkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey"],
}
HOT = {"orders": "o_custkey", "lineitem": "l_orderkey"}


def enlarged(spark: SparkSession, folder: str, table: str, times: int) -> DataFrame:
    """A table ``times`` over, each copy with keys of its own, a third of the rows on one."""
    rows = spark.read.parquet(f"{folder}/{table}.parquet")
    many = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    for key in KEYS.get(table, []):
        own = F.col(key) + F.col("_copy") * 100_000_000
        if HOT.get(table) == key:
            own = F.when(F.rand(7) < 1 / 3, F.lit(1)).otherwise(own)
        many = many.withColumn(key, own.cast(rows.schema[key].dataType))
    return many.drop("_copy")


def main() -> None:
    folder, times = sys.argv[1], int(sys.argv[2])
    out = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="skewed-", dir="/tmp")
    spark = local_session(
        "skewed",
        int(os.environ.get("BENCH_CPUS", "8")),
        spark__sql__shuffle__partitions="64",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32MB",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for table in ("customer", "part", "orders", "lineitem"):
        path = f"{out}/{table}.parquet"
        if not os.path.exists(path):
            enlarged(spark, folder, table, times).write.parquet(path)
    for name in TIMED:
        start = time.perf_counter()
        QUERIES[name](spark, out).write.format("noop").mode("overwrite").save()
        print(name, round(time.perf_counter() - start, 1), flush=True)
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
