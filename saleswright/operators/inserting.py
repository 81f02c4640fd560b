"""An INSERT as one run: keys and defaults given, rules checked, rows appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from saleswright.operators.key_ranges import with_reserved_keys
from saleswright.operators.quality import broken_references, duplicate_keys, fault_counts
from saleswright.session import scratch_path
from saleswright.sources.schemas import TableSpec, complete_rows
from saleswright.sources.tables import RUN, read_runs, write_run


def new_rows(
    rows: DataFrame,
    existing: DataFrame,
    spec: TableSpec,
    order: list[Column],
    base: str,
    run: str,
) -> DataFrame:
    """Rows under the declared schema: a key left out is given, from a range that the run reserves
    above the highest of ``existing``, in ``order`` (which ends in a unique column), and any other
    column left out takes its default, or NULL. Keys that come with the rows are kept."""
    if spec.key not in rows.columns:
        rows = with_reserved_keys(
            rows, base, run, spec.key, order, lambda: existing.agg(F.max(spec.key)).first()[0] or 0
        )
    return complete_rows(rows, spec.schema, spec.defaults)


def rule_faults(
    rows: DataFrame, existing: DataFrame, spec: TableSpec, parents: dict[str, DataFrame]
) -> DataFrame:
    """Each rule that ``rows`` would break beside ``existing``, and by how many: NOT NULL, text
    lengths, the key, and references to ``parents``, tables by name."""
    broken = fault_counts(rows, spec)
    keys = rows.select(spec.key).unionAll(
        existing.join(rows.select(spec.key), spec.key, "left_semi").select(spec.key)
    )
    repeated = duplicate_keys(keys.filter(F.col(spec.key).isNotNull()), [spec.key])
    broken = broken.unionByName(
        repeated.agg(F.lit(f"{spec.key} repeated").alias("rule"), F.count("*").alias("n"))
    )
    if spec.foreign_keys:
        lost = broken_references({spec.name: rows, **parents}, [spec])
        given = lost.filter(F.col("reference").isNotNull())  # a NULL breaks NOT NULL
        broken = broken.unionByName(
            given.groupBy(F.col("constraint_name").alias("rule")).agg(F.count("*").alias("n"))
        )
    return broken.filter("n > 0")


def insert_run(
    spark: SparkSession,
    base: str,
    run: str,
    rows: DataFrame,
    spec: TableSpec,
    order: list[Column],
    parents: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Append ``rows`` to the table kept in runs at ``base``, and return the table.

    No row that is there already is read in full or written again: the highest key and the keys
    that the new rows bring are looked up, and the new rows become a run of their own. Rows that
    break a rule stop the run before anything is appended. A run that is repeated replaces
    itself, with the same keys whatever runs came later. One writer per table.
    """
    with_run = StructType([*spec.schema.fields, StructField(RUN, StringType())])
    stored = spark.read.schema(with_run).parquet(base)
    others = stored.filter(F.col(RUN) != run).select(*spec.schema.names)
    prepared = scratch_path(spark, "insert")
    new_rows(rows, others, spec, order, base, run).write.parquet(prepared)
    ready = spark.read.schema(spec.schema).parquet(prepared)
    faults = rule_faults(ready, others, spec, parents or {}).collect()  # one row per rule
    if faults:
        raise ValueError("; ".join(sorted(f"{row['rule']}: {row['n']}" for row in faults)))
    write_run(ready, base, run)
    return read_runs(spark, base, spec.schema)
