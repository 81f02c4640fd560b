"""Key, reference, NULL, length and domain rules as jobs that return the rows at fault."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.operators.joins import Keys, equal_keys
from saleswright.session import scratch_path
from saleswright.sources.schemas import TableSpec


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their number of rows."""
    null_key = reduce(Column.__or__, [F.col(name).isNull() for name in key])
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("n"))
        .filter((F.col("n") > 1) | null_key)
    )


#: Bytes of the bitmap of one bucket of places, and bytes that a key costs in a shuffle, about.
_BITMAP_BYTES, _KEY_BYTES = 4096, 16


def suspected_buckets(df: DataFrame, place: Column) -> DataFrame:
    """Buckets of 32,768 places in which more rows lie than places are taken.

    Every task sends one bitmap per bucket it has rows of, a bit a place, instead of its keys.
    """
    return (
        df.select(place.cast("long").alias("_place"))
        .filter("_place IS NOT NULL")
        .groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
        .agg(
            F.count("*").alias("_rows"),
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_place"))).alias("_taken"),
        )
        .filter("_rows > _taken")
        .select("_bucket")
    )


def bitmaps_pay(df: DataFrame, place: Column) -> bool:
    """Whether the bitmaps of all tasks are smaller than the keys: rows that lie together in the
    files must have places near each other. One pass over the key, summed to one row."""
    bucket = F.bitmap_bucket_number(place.cast("long"))
    marked = df.select(F.struct(F.spark_partition_id(), bucket).alias("bitmap"))
    row = marked.agg(
        F.count("*").alias("n"), F.approx_count_distinct("bitmap").alias("bitmaps")
    ).first()
    return row["bitmaps"] * _BITMAP_BYTES < row["n"] * _KEY_BYTES


def screened_duplicate_keys(df: DataFrame, key: list[str], place: Column) -> DataFrame:
    """What ``duplicate_keys`` gives, for a table stored in the order of its key.

    ``place`` is a whole number made of the key alone; near keys should have near places. Keys
    may share one: that only makes their bucket suspected. Only rows of suspected buckets, and
    those with a NULL in the key or a NULL place, are shuffled by key, so a clean table costs
    about a bit a row. Where the rows do not lie in the order of their places, all keys are
    shuffled as ``duplicate_keys`` does. ``df`` is read up to three times and must be the same
    each time, so give it a stored table.
    """
    if not bitmaps_pay(df, place):
        return duplicate_keys(df, key)
    spark = df.sparkSession
    path = scratch_path(spark, "suspected-buckets")
    suspected_buckets(df, place).write.parquet(path)
    suspected = spark.read.schema("_bucket long").parquet(path)
    keys = df.select(*key, place.cast("long").alias("_place"))
    unknown = reduce(Column.__or__, [F.col(name).isNull() for name in [*key, "_place"]])
    bucket = F.bitmap_bucket_number("_place").alias("_bucket")
    known = keys.filter(~unknown).select(*key, bucket)
    in_doubt = known.join(suspected, "_bucket", "left_semi").select(*key)
    return duplicate_keys(in_doubt.unionAll(keys.filter(unknown).select(*key)), key)


def orphans(child: DataFrame, parent: DataFrame, keys: Keys) -> DataFrame:
    """Child rows whose reference is NULL or has no parent; keys as (child, parent).

    Any number of child rows may share a reference: the anti join reads the parents' keys as
    they are, without an aggregate in between, so that a hot partition of children can be split.
    """
    parents = parent.select(*[b for _, b in keys])
    return child.join(parents, equal_keys(child, parents, keys), "left_anti")


def null_counts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Number of NULLs for each named column, in one pass."""
    return df.agg(*[F.count_if(c.isNull()).alias(name) for name, c in columns.items()])


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with a text longer than its limit."""
    return df.filter(reduce(Column.__or__, [F.length(c) > n for c, n in limits.items()]))


def outside_domain(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule is FALSE. A rule that is NULL is kept, as CHECK does."""
    return df.filter(~rule)


def broken_references(tables: dict[str, DataFrame], specs: list[TableSpec]) -> DataFrame:
    """All child rows at fault over all declared references."""
    found = []
    for spec in specs:
        for reference in spec.foreign_keys:
            keys = [(reference.column, reference.parent_column)]
            rows = orphans(tables[spec.name], tables[reference.parent], keys)
            found.append(
                rows.select(
                    F.lit(reference.name).alias("constraint_name"),
                    F.col(spec.key).cast("long").alias("row_key"),
                    F.col(reference.column).cast("long").alias("reference"),
                )
            )
    return reduce(DataFrame.unionByName, found)


def fault_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Number of rows that break each NOT NULL and length rule of a table, in one pass."""
    rules = {f"{name} is null": F.col(name).isNull() for name in spec.required}
    rules |= {f"{c} over {n}": F.length(c) > n for c, n in spec.text_limits.items()}
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n").filter("n > 0")
