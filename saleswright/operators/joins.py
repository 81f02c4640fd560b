"""Joins written so that one hot key cannot pin its rows to one task.

Inner joins need nothing here: Spark broadcasts a side that its size estimate shows to be
small, and otherwise adaptive execution splits a hot partition on either side. It cannot
split the right side of a left outer, semi or anti join. For semi and anti joins the forms below
bring a right side with many rows per key down to its distinct keys, which partial aggregation
does before the shuffle; for an outer join they deal the rows of a hot key over slices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.operators.hot_keys import hot_keys

Keys = list[tuple[str, str]]


def equal_keys(left: DataFrame, right: DataFrame, keys: Keys) -> Column:
    return reduce(Column.__and__, [left[a] == right[b] for a, b in keys])


def _distinct_keys(right: DataFrame, keys: Keys) -> DataFrame:
    return right.select(*[b for _, b in keys]).distinct()


def with_match(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """Rows of ``left`` that match some row of ``right`` (EXISTS, IN).

    ``left`` must have no hot key, such as a key that is unique there: the aggregate on the right
    keeps Spark from splitting it. See ``rows_with_match``.
    """
    found = _distinct_keys(right, keys)
    return left.join(found, equal_keys(left, found, keys), "left_semi")


def without_match(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """Rows of ``left`` that match no row of ``right``; a NULL key matches nothing.

    ``left`` must have no hot key, as for ``with_match``. See ``rows_without_match``.
    """
    found = _distinct_keys(right, keys)
    return left.join(found, equal_keys(left, found, keys), "left_anti")


def rows_with_match(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """``with_match`` for a ``left`` with any number of rows of one key, and a ``right`` with few:
    its keys are read as they are, so that a hot partition on the left can be split."""
    found = right.select(*[b for _, b in keys])
    return left.join(found, equal_keys(left, found, keys), "left_semi")


def rows_without_match(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """``without_match`` for a ``left`` with any number of rows of one key."""
    found = right.select(*[b for _, b in keys])
    return left.join(found, equal_keys(left, found, keys), "left_anti")


def inner(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    return left.join(right, equal_keys(left, right, keys), "inner")


def outer_one_to_many(one: DataFrame, many: DataFrame, keys: Keys) -> DataFrame:
    """``one LEFT JOIN many``; ``keys`` pairs columns of ``one`` with columns of ``many``.

    ``many`` may hold any number of rows for one key; column names of the two must differ. Hot
    values of the key are found by a sketch. Rows of ``many`` that have one are dealt
    over as many slices as its share asks for, and ``one``'s rows of that value are repeated for
    each slice. Both tables are read once; without a hot key it is the plain join.
    """
    left, right = keys[0]
    hot = hot_keys(many, right)
    if not hot.counts:
        return one.join(many, equal_keys(one, many, keys), "left")
    if len(keys) > 1:
        return _by_inner_and_anti(one, many, keys)
    slices = F.sequence(F.lit(0), hot.slices(F.col(left)) - 1)
    repeated = one.withColumn("_slice", F.explode(slices))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), hot.slices(F.col(right)))
    dealt = many.withColumns({"_part": part.cast("int"), "_met": F.lit(True)})
    sliced = equal_keys(repeated, dealt, keys) & (repeated["_slice"] == dealt["_part"])
    # A hot value has matches, though perhaps not in every slice: a slice without any is no row.
    real = F.col("_met").isNotNull() | ~hot.holds(F.col(left))
    met = repeated.join(dealt, sliced, "left").filter(real)
    return met.drop("_slice", "_part", "_met")


def _by_inner_and_anti(one: DataFrame, many: DataFrame, keys: Keys) -> DataFrame:
    """The same where a hot value of the first column may still lack a match by the others: matched
    rows by an inner join, which Spark can split, and the others by an anti join."""
    return inner(one, many, keys).unionByName(
        without_match(one, many, keys), allowMissingColumns=True
    )


def outer_where_null(one: DataFrame, many: DataFrame, keys: Keys, column: str) -> DataFrame:
    """``many RIGHT JOIN one`` where ``column`` of ``many`` is NULL.

    As written in SQL, this keeps rows of ``one`` without a match and also those whose
    match holds a NULL there. ``without_match`` keeps the first kind only.
    """
    null_matches = inner(one, many.filter(many[column].isNull()), keys)
    return null_matches.unionByName(without_match(one, many, keys), allowMissingColumns=True)
