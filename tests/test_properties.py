"""The rewritten joins and aggregates against their plain forms, on random rows."""

from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswright.operators import joins
from saleswright.operators.aggregates import (
    count_per_parent,
    joined_in_parts,
    mean_per_name_between,
    total_per_name,
)
from saleswright.operators.hot_keys import HotKeys
from saleswright.operators.joins import (
    outer_one_to_many,
    outer_where_null,
    with_match,
    without_match,
)
from saleswright.operators.numbering import number_rows
from saleswright.operators.quality import duplicate_keys, orphans

some_examples = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

# Few keys and few names, so that both repeat; NULL in any place.
key = st.one_of(st.none(), st.integers(0, 4))
cents = st.one_of(st.none(), st.integers(-300, 300))
parents = st.lists(st.tuples(st.integers(0, 6), st.sampled_from("abc")), unique_by=lambda t: t[0])
facts = st.lists(st.tuples(key, cents), max_size=25)


def frames(spark, parent_rows, fact_rows):
    parent = spark.createDataFrame(parent_rows, "pk int, name string")
    rows = [
        (i, k, None if c is None else Decimal(c) / 100) for i, (k, c) in enumerate(fact_rows)
    ]
    return parent, spark.createDataFrame(rows, "id int, fk int, amount decimal(12,2)")


def same(left, right):
    def rows(df):
        return sorted((str(tuple(row)) for row in df.select(*left.columns).collect()))

    assert rows(left) == rows(right)


@some_examples
@given(parents, facts, st.integers(1, 3))
def test_outer_join_with_slices(spark, parent_rows, fact_rows, share):
    """Every key counts as hot from one row on, or from a share of the rows."""
    parent, fact = frames(spark, parent_rows, fact_rows)
    counts = Counter(k for k, _ in fact_rows if k is not None)
    rows = sum(counts.values())
    hot = HotKeys(rows, {k: n for k, n in counts.items() if n * share >= rows})
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(joins, "hot_keys", lambda df, column: hot)
        found = outer_one_to_many(parent, fact, [("pk", "fk")])
    same(found, parent.join(fact, F.col("pk") == F.col("fk"), "left"))


@some_examples
@given(parents, facts)
def test_joins(spark, parent_rows, fact_rows):
    parent, fact = frames(spark, parent_rows, fact_rows)
    on = F.col("pk") == F.col("fk")
    keys = [("pk", "fk")]
    same(outer_one_to_many(parent, fact, keys), parent.join(fact, on, "left"))
    same(
        outer_where_null(parent, fact, keys, "amount"),
        fact.join(parent, on, "right").filter("amount IS NULL"),
    )
    same(with_match(parent, fact, keys), parent.join(fact, on, "left_semi"))
    same(without_match(parent, fact, keys), parent.join(fact, on, "left_anti"))
    same(orphans(fact, parent, [("fk", "pk")]), fact.join(parent, on, "left_anti"))
    same(
        count_per_parent(parent, fact, keys, "amount", "n"),
        parent.join(fact, on, "left").groupBy("pk", "name").agg(F.count("amount").alias("n")),
    )


@some_examples
@given(parents, facts, st.integers(-300, 300), st.integers(0, 300))
def test_totals_and_means(spark, parent_rows, fact_rows, low, width):
    parent, fact = frames(spark, parent_rows, fact_rows)
    keys = [("fk", "pk")]
    joined = fact.join(parent, F.col("pk") == F.col("fk"))
    amount = F.col("amount")
    same(
        total_per_name(fact, parent, keys, ["name"], amount, "total"),
        joined.groupBy("name").agg(F.sum("amount").cast("decimal(38,2)").alias("total")),
    )
    bounds = Decimal(low) / 100, Decimal(low + width) / 100
    found = mean_per_name_between(fact, parent, keys, ["name"], amount, *bounds, "media")
    groups = {}
    for row in joined.filter("amount IS NOT NULL").collect():
        groups.setdefault(row.name, []).append(row.amount)
    expected = {
        name for name, v in groups.items() if bounds[0] * len(v) <= sum(v) <= bounds[1] * len(v)
    }
    assert {row.name for row in found.collect()} == expected


@some_examples
@given(facts)
def test_numbers(spark, fact_rows):
    _, fact = frames(spark, [(0, "a")], fact_rows)
    numbered = number_rows(fact, [F.asc_nulls_first("fk"), F.asc("id")])
    rows = [(-1 if r.fk is None else r.fk, r.id) for r in numbered.collect()]
    assert rows == sorted(rows)
    assert [r.rn for r in numbered.collect()] == list(range(1, len(fact_rows) + 1))


@some_examples
@given(facts, st.integers(1, 9))
def test_parts_make_up_the_whole_text(spark, fact_rows, width):
    _, fact = frames(spark, [(0, "a")], fact_rows)
    text = fact.withColumn("text", F.col("amount").cast("string"))
    parts = joined_in_parts(text, ["fk"], "text", "id", width, "t")
    found = {}
    for row in sorted(parts.collect(), key=lambda r: r.part_no):
        assert len(row.t.split("\n")) <= width
        found.setdefault(row.fk, []).append(row.t)
    expected = {}
    for row in text.orderBy("id").collect():
        if row.text is not None:
            expected.setdefault(row.fk, []).append(row.text)
    assert {k: "\n".join(v) for k, v in found.items()} == {
        k: "\n".join(v) for k, v in expected.items()
    }


@some_examples
@given(facts)
def test_duplicate_keys(spark, fact_rows):
    _, fact = frames(spark, [(0, "a")], fact_rows)
    counts = {}
    for k, _ in fact_rows:
        counts[k] = counts.get(k, 0) + 1
    expected = {(k, n) for k, n in counts.items() if n > 1 or k is None}
    assert {tuple(row) for row in duplicate_keys(fact, ["fk"]).collect()} == expected
