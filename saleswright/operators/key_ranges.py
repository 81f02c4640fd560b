"""Ranges of keys that runs reserve before they write rows, so that a repeated run gives the same.

A table's ledger lies beside its runs, with one small file for each run: the first key of its range
and how many keys it has. A range that a failed run has reserved and never used stays unused.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.operators.numbering import number_rows
from saleswright.sources.tables import RUN

_LEDGER = "first_key long, n_keys long, run_id string"


def ledger_path(base: str) -> str:
    """Where the ledger of the table at ``base`` lies."""
    return f"{base.rstrip('/')}_keys"


def read_ranges(spark: SparkSession, base: str) -> DataFrame:
    """All ranges that runs of a table have reserved: first_key, n_keys, run_id."""
    try:
        return spark.read.schema(_LEDGER).parquet(ledger_path(base))
    except AnalysisException:  # none has yet
        return spark.createDataFrame([], _LEDGER)


def reserve(
    spark: SparkSession, base: str, run: str, n: int, highest: Callable[[], int]
) -> int:
    """The first of ``n`` keys for ``run``.

    A run that has reserved as many keys before gets the same again, whatever other runs have
    reserved since. Else its range starts above all others and above ``highest()``, the highest key
    in use, which is asked for only then. One writer per table.
    """
    ranges = read_ranges(spark, base)
    own = ranges.filter(F.col(RUN) == run).first()
    if own and n <= own["n_keys"]:
        return own["first_key"]
    others = ranges.filter(F.col(RUN) != run)
    reserved = others.agg(F.max(F.col("first_key") + F.col("n_keys") - 1)).first()[0]
    first = max(reserved or 0, highest()) + 1
    row = spark.range(1).select(F.lit(first).alias("first_key"), F.lit(n).cast("long").alias("n_keys"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{ledger_path(base)}/{RUN}={run}")
    return first


def with_reserved_keys(
    rows: DataFrame,
    base: str,
    run: str,
    key: str,
    order: list[Column],
    highest: Callable[[], int],
) -> DataFrame:
    """``rows`` with keys of the run's own range in ``order``, which ends in a unique column. Their
    number and their keys are of the same rows, which ``number_rows`` has stored."""
    numbered = number_rows(rows, order, "_number")
    n = numbered.agg(F.max("_number")).first()[0] or 0
    first = reserve(rows.sparkSession, base, run, n, highest)
    keys = (F.col("_number") + F.lit(first - 1)).cast("long").alias(key)
    return numbered.select(*rows.columns, keys)
