"""Keys that hold a large share of a table's rows, found in one pass over one column."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with at least this share of all rows is hot, so there are at most 64.
SHARE = 1 / 64
#: Items that the sketch keeps: its error is about 3.5 / 16384 of the rows, far below a hot share.
_TRACKED = 12288


@dataclass(frozen=True)
class HotKeys:
    """The hot keys with their number of rows, which the sketch may put slightly too high, and the
    number of all rows (those with a null key are not counted)."""

    rows: int
    counts: dict[object, int]

    def holds(self, key: Column) -> Column:
        """Whether a key is hot; false for a null key."""
        if not self.counts:
            return F.lit(False)
        return F.coalesce(key.isin(list(self.counts)), F.lit(False))

    def slices(self, key: Column, share: float = SHARE) -> Column:
        """Into how many parts a key's rows go, so that each has about ``share`` of all rows."""
        parts = F.lit(1)
        for value, n in self.counts.items():
            size = max(2, math.ceil(n / (share * self.rows)))
            parts = F.when(key == F.lit(value), F.lit(size)).otherwise(parts)
        return parts


def hot_keys(df: DataFrame, column: str, share: float = SHARE) -> HotKeys:
    """The values of ``column`` that at least ``share`` of the rows hold, by a frequent-items sketch
    that every task makes of its rows. No more than ``1 / share`` values come to the driver.

    All values with that share are found; each was seen in ``df``.
    """
    most = math.ceil(1 / share)
    values = df.select(F.col(column).alias("k")).filter("k IS NOT NULL")
    found = values.agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(k, {most}, {_TRACKED})").alias("top")
    ).first()
    hot = {x["item"]: x["count"] for x in found["top"] or [] if x["count"] >= share * found["n"]}
    # A few rows make any key hot, and no task long.
    return HotKeys(found["n"], hot if found["n"] > most * most else {})
