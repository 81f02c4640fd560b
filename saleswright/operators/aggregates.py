"""Aggregates that reduce rows before they are shuffled or joined."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.functions.scalar import mean, whole_quotient
from saleswright.operators.joins import Keys, equal_keys, inner


def total_per_name(
    facts: DataFrame, parents: DataFrame, keys: Keys, names: list[str], amount: Column, alias: str
) -> DataFrame:
    """Sum of ``amount`` per parent name; ``keys`` pairs fact columns with parent columns.

    The facts are summed per key first, so the join and the second sum see one row per key.
    Parents that share a name end up in one group.
    """
    per_key = facts.groupBy(*[a for a, _ in keys]).agg(F.sum(amount).alias("_total"))
    return (
        inner(per_key, parents, keys)
        .groupBy(*names)
        .agg(F.sum("_total").cast("decimal(38,2)").alias(alias))
    )


def mean_per_name_between(
    facts: DataFrame,
    parents: DataFrame,
    keys: Keys,
    names: list[str],
    amount: Column,
    low: int | Decimal,
    high: int | Decimal,
    alias: str,
) -> DataFrame:
    """Names whose mean amount lies between two bounds, both included.

    The bounds are compared as ``low * n <= sum <= high * n``, which needs no rounded quotient.
    """
    per_key = facts.groupBy(*[a for a, _ in keys]).agg(
        F.sum(amount).alias("_total"), F.count(amount).alias("_n")
    )
    total, n = F.col("_total"), F.col("_n").cast("decimal(19,0)")
    return (
        inner(per_key, parents, keys)
        .groupBy(*names)
        .agg(F.sum("_total").alias("_total"), F.sum("_n").alias("_n"))
        .filter((total >= n * F.lit(low)) & (total <= n * F.lit(high)))
        .select(*names, mean(F.col("_total"), F.col("_n")).alias(alias))
    )


def count_per_parent(
    parents: DataFrame, facts: DataFrame, keys: Keys, counted: str, alias: str
) -> DataFrame:
    """Parents with their number of facts, 0 where there is none; keys as (parent, fact)."""
    counts = facts.groupBy(*[b for _, b in keys]).agg(F.count(counted).alias("_n"))
    return parents.join(counts, equal_keys(parents, counts, keys), "left").select(
        *[parents[name] for name in parents.columns],
        F.coalesce("_n", F.lit(0)).cast("long").alias(alias),
    )


def joined_in_parts(
    df: DataFrame, group: list[str], text: str, key: str, keys_per_part: int, alias: str
) -> DataFrame:
    """Texts of a group joined by line feeds in key order, as numbered parts.

    A part covers ``keys_per_part`` consecutive values of the unique ``key``, so no task holds
    more than that many texts of a hot group. The parts of a group, in order and joined by a
    line feed, are its whole text; a group within one range of keys has one part. NULL texts
    add nothing.
    """
    part = whole_quotient(F.col(key), F.lit(keys_per_part)).cast("long")
    return (
        df.filter(F.col(text).isNotNull())
        .groupBy(*group, part.alias("part_no"))
        .agg(F.expr(f"listagg(`{text}`, chr(10)) WITHIN GROUP (ORDER BY `{key}`)").alias(alias))
    )


def threshold_label(total: Column, bound: int | Decimal, above: str, otherwise: str) -> Column:
    """One text where the total is over the bound, another where it is not or is NULL."""
    return F.when(total > bound, above).otherwise(otherwise)
