"""A parent table and its child side by side: bucketed and sorted by the parent's key on load.

A join of the two on that key then reads matching buckets together and shuffles neither table. A
bucket is one task, so a hot parent, whose children alone would fill several, is kept out of the
buckets: its children lie in files of their own, spread evenly, and meet the few hot parents in a
join that Spark broadcasts by their size.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.operators.hot_keys import hot_keys
from saleswright.sources.tables import quoted_name

#: Child rows that one bucket should hold.
ROWS_PER_BUCKET = 2_000_000
#: Buckets at least, so that small tables use more than one core.
LEAST_BUCKETS = 8


def bucket_count(rows: int) -> int:
    """A power of two, so that tables of other counts still line up."""
    return 1 << max(LEAST_BUCKETS - 1, -(-rows // ROWS_PER_BUCKET) - 1).bit_length()


@dataclass(frozen=True)
class CoBucketed:
    """Two tables loaded by ``write_co_bucketed``."""

    parent: DataFrame
    child: DataFrame
    hot_parent: DataFrame
    hot_child: DataFrame
    parent_key: str
    child_key: str

    def children(self) -> DataFrame:
        """All child rows."""
        return self.child.unionByName(self.hot_child)

    def joined(
        self, parent_columns: dict[str, str], child_columns: dict[str, str]
    ) -> DataFrame:
        """Children with their parents by an inner join, with columns (new name: column) of each."""

        def meet(parent: DataFrame, child: DataFrame) -> DataFrame:
            key = F.col(self.parent_key).alias("_parent")
            left = parent.select(key, *[F.col(c).alias(n) for n, c in parent_columns.items()])
            key = F.col(self.child_key).alias("_child")
            right = child.select(key, *[F.col(c).alias(n) for n, c in child_columns.items()])
            return right.join(left, right["_child"] == left["_parent"]).drop("_parent", "_child")

        cold = meet(self.parent, self.child)
        return cold.unionByName(meet(self.hot_parent, self.hot_child))


def _table(base: str, name: str) -> str:
    """A catalogue name that follows from the place of the files."""
    return f"co_bucketed_{sha256(base.encode()).hexdigest()[:24]}_{name}"


def _write(df: DataFrame, base: str, name: str, key: str, buckets: int) -> None:
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {quoted_name(_table(base, name))}")
    # Dealt out as the buckets are, so that each is one sorted file.
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = dealt.write.mode("overwrite").option("path", f"{base}/{name}")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(_table(base, name))


def write_co_bucketed(
    parent: DataFrame,
    child: DataFrame,
    base: str,
    parent_key: str,
    child_key: str,
    buckets: int | None = None,
) -> CoBucketed:
    """Write both tables under ``base`` and return them. A load that is repeated replaces itself.

    ``parent_key`` must be unique in ``parent``; both keys must have the same type. Children with a
    null key or without a parent are kept, and join nothing.
    """
    if parent.schema[parent_key].dataType != child.schema[child_key].dataType:
        raise ValueError(f"{parent_key} and {child_key} must have one type to share buckets")
    hot = hot_keys(child, child_key)
    buckets = buckets or bucket_count(hot.rows)
    is_hot = hot.holds(F.col(child_key))
    _write(parent, base, "parent", parent_key, buckets)
    _write(child.filter(~is_hot), base, "child", child_key, buckets)
    some = parent.filter(hot.holds(F.col(parent_key)))
    some.coalesce(1).write.mode("overwrite").parquet(f"{base}/hot_parent")  # at most 64 rows
    child.filter(is_hot).write.mode("overwrite").parquet(f"{base}/hot_child")
    return open_co_bucketed(child.sparkSession, base, parent_key, child_key, buckets)


def open_co_bucketed(
    spark: SparkSession, base: str, parent_key: str, child_key: str, buckets: int
) -> CoBucketed:
    """The tables that ``write_co_bucketed`` has left at ``base``, also in a session whose catalogue
    does not know them: names and buckets are then noted again, and no file is touched."""

    def table(name: str, key: str) -> DataFrame:
        named = quoted_name(_table(base, name))
        if not spark.catalog.tableExists(named):
            columns = spark.read.parquet(f"{base}/{name}").schema.fields
            kinds = ", ".join(f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in columns)
            spark.sql(
                f"CREATE TABLE {named} ({kinds}) USING parquet CLUSTERED BY ({quoted_name(key)}) "
                f"SORTED BY ({quoted_name(key)}) INTO {buckets} BUCKETS LOCATION '{base}/{name}'"
            )
        return spark.table(named)

    return CoBucketed(
        table("parent", parent_key),
        table("child", child_key),
        spark.read.parquet(f"{base}/hot_parent"),
        spark.read.parquet(f"{base}/hot_child"),
        parent_key,
        child_key,
    )


def drop_co_bucketed(spark: SparkSession, base: str) -> None:
    """Forget the tables' names. Their files stay."""
    for name in ("parent", "child"):
        spark.sql(f"DROP TABLE IF EXISTS {quoted_name(_table(base, name))}")
