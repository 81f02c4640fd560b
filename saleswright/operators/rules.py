"""The declared rules of a table, checked on the rows that a change touches."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.operators.quality import broken_references, duplicate_keys, fault_counts
from saleswright.sources.schemas import TABLES, TableSpec

if TYPE_CHECKING:
    from saleswright.operators.changes import Statement


class BrokenRules(ValueError):
    """Rules that a change would break, by name, with their numbers of rows."""

    def __init__(self, faults: dict[str, int]) -> None:
        super().__init__("; ".join(f"{rule}: {n}" for rule, n in sorted(faults.items())))
        self.faults = faults


@dataclass(frozen=True)
class TableRules:
    """NOT NULL, text lengths, the key, the references to ``parents`` (tables by name), and those of
    ``children`` to this table: (constraint, child table, its column)."""

    spec: TableSpec
    parents: dict[str, DataFrame] = field(default_factory=dict)
    children: list[tuple[str, DataFrame, str]] = field(default_factory=list)

    @staticmethod
    def declared(spec: TableSpec, tables: dict[str, DataFrame]) -> TableRules:
        """The rules of a table among all declared tables that ``tables`` holds by name."""
        parents = {k.parent: tables[k.parent] for k in spec.foreign_keys if k.parent in tables}
        children = [
            (key.name, tables[name], key.column)
            for name, other in TABLES.items()
            for key in other.foreign_keys
            if key.parent == spec.name and name in tables
        ]
        return TableRules(spec, parents, children)

    def faults_of(self, statement: Statement) -> DataFrame:
        """Each rule that a statement breaks, and by how many rows: ``rule``, ``n``.

        New rows alone are tested, and only keys that the statement took away are looked for
        among the children. The content is read for its keys, and rows that match none of the
        changed keys are not shuffled while the changed rows are few.
        """
        new = statement.row_set("inserted").unionByName(statement.row_set("after"))
        old = statement.row_set("deleted").unionByName(statement.row_set("before"))
        return self._faults(new, old, statement.content)

    def faults_between(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """The same for a change that is known by the table before and after it alone."""
        return self._faults(new, old, new)

    def row_faults(self, rows: DataFrame) -> DataFrame:
        """Rules that rows break by themselves or against the parents, whatever else is there."""
        broken = fault_counts(rows, self.spec)
        keys = [k for k in self.spec.foreign_keys if k.parent in self.parents]
        if keys:
            some = TableSpec(self.spec.name, self.spec.schema, self.spec.key, tuple(keys))
            lost = broken_references({self.spec.name: rows, **self.parents}, [some])
            given = lost.filter(F.col("reference").isNotNull())  # a NULL breaks NOT NULL, if any
            counts = given.groupBy(F.col("constraint_name").alias("rule")).agg(F.count("*").alias("n"))
            broken = broken.unionByName(counts)
        return broken

    def _faults(self, new: DataFrame, old: DataFrame, content: DataFrame) -> DataFrame:
        key = self.spec.key
        found = [self.row_faults(new)]
        touched = new.select(key).filter(F.col(key).isNotNull()).distinct()
        beside = content.select(key).join(touched, key, "left_semi")
        repeated = duplicate_keys(beside, [key])
        found.append(repeated.agg(F.lit(f"{key} repeated").alias("rule"), F.count("*").alias("n")))
        if self.children:
            gone = old.select(F.col(key).alias("_gone")).distinct()
            stay = content.select(F.col(key).alias("_gone")).join(gone, "_gone", "left_semi")
            gone = gone.join(stay.distinct(), "_gone", "left_anti")
            for name, child, column in self.children:
                left = child.join(gone, child[column] == gone["_gone"], "left_semi")
                found.append(left.agg(F.lit(name).alias("rule"), F.count("*").alias("n")))
        return reduce(DataFrame.unionByName, found).filter("n > 0")

    @staticmethod
    def require(faults: DataFrame) -> None:
        rows = faults.collect()  # one row per rule at most
        if rows:
            raise BrokenRules({row["rule"]: row["n"] for row in rows})
