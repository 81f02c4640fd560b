"""Exact duplicates of texts, against an immutable snapshot and within a new batch.

A snapshot keeps one row per different text in buckets by digest, and for each bucket a static
binary fuse filter of its digests (Graf and Lemire, 2022): about nine bits a digest and no false
negatives. The different texts of a new batch are screened bucket by bucket; the few that pass
meet the bucket's exact rows, and their bytes are compared. What is new is grouped by itself.

Texts are equal when they are the same after all of [\\x20\\x09-\\x0D] is deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import SPACE, kept, text_or_empty

#: Different texts in a bucket, on average: what one task builds a filter of.
BUCKET_ROWS = 200_000
#: Remainders of digests by which texts are sorted out that no comparison asks for, before any
#: text is shuffled: the most rows that are broadcast.
PLACES = 1 << 20

_FILTER = "bucket int, seed long, segment long, segments long, prints binary"


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.astype(np.uint64) + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(33))


class FuseFilter:
    """A static set of 64-bit keys: always true for its own, true for one in 256 of others."""

    def __init__(self, seed: int, segment: int, segments: int, prints: np.ndarray) -> None:
        self.seed, self.segment, self.segments, self.prints = seed, segment, segments, prints

    def _places(self, h: np.ndarray) -> np.ndarray:
        """Three places for each key, in three segments that follow one another."""
        span, mask = np.uint64(self.segments * self.segment), np.uint64(self.segment - 1)
        first = ((h >> np.uint64(32)) * span) >> np.uint64(32)
        second = (first + np.uint64(self.segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * self.segment)) ^ (h & mask)
        return np.stack((first, second, third)).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32))).astype(np.uint8)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        h = _mixed(keys, self.seed)
        a, b, c = self.prints[self._places(h)]
        return (a ^ b ^ c) == self._print(h)

    @classmethod
    def of(cls, keys: np.ndarray) -> FuseFilter:
        """Build by peeling: a place that one key alone uses is left to that key, again and
        again; the keys then get their prints in the reverse order."""
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 2)
        segment = 1 << max(2, min(18, int(np.log(n) / np.log(3.33) + 2.25)))
        room = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n)))
        segments = max(1, -(-room // segment) - 2)
        size = (segments + 2) * segment
        for seed in range(1, 200):
            found = cls(seed, segment, segments, np.zeros(size, dtype=np.uint8))
            h = _mixed(keys, seed)
            places = found._places(h)
            layers = cls._peel(places, size)
            if layers is None:
                continue
            prints = cls._print(h)
            for some, at in reversed(layers):
                a, b, c = found.prints[places[:, some]]
                found.prints[at] = prints[some] ^ a ^ b ^ c
            return found
        raise RuntimeError("no seed gives a filter")

    @staticmethod
    def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        n = places.shape[1]
        uses = np.bincount(places.ravel(), minlength=size)
        users = np.zeros(size, dtype=np.int64)  # xor of the keys that use a place
        for row in places:
            np.bitwise_xor.at(users, row, np.arange(n))
        layers, done, alone = [], 0, np.flatnonzero(uses == 1)
        while len(alone):
            some, first = np.unique(users[alone], return_index=True)
            layers.append((some, alone[first]))
            done += len(some)
            touched = places[:, some].ravel()
            np.subtract.at(uses, touched, 1)
            np.bitwise_xor.at(users, touched, np.tile(some, 3))
            touched = np.unique(touched)
            alone = touched[uses[touched] == 1]
        return layers if done == n else None


def _best() -> Column:
    """Of equal texts: the most code points, then the smallest doc_id, nulls last."""
    place = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull(), "doc_id", "rid")
    return F.min(place)


def digested(docs: DataFrame, batch: Column) -> DataFrame:
    """The rows as ``row``, with a number of their own, digests of their texts and their batch
    (0: snapshot, 1: new). Written once, so that what follows reads one fixed copy."""
    text = text_or_empty(docs)
    norm = F.translate(text, SPACE, "")
    marked = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("points"),
        F.xxhash64(norm).alias("digest"),
        F.sha2(norm, 256).alias("sha"),
        batch.cast("int").alias("batch"),
    )
    return kept(marked, "digests")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per different text: digest, sha, n (rows), best."""
    return rows.groupBy("digest", "sha").agg(F.count("*").alias("n"), _best().alias("best"))


def _bucket(n: int) -> Column:
    return F.pmod(F.shiftright("digest", 3), F.lit(n)).cast("int").alias("bucket")


@dataclass
class Snapshot:
    """Written once and never changed: exact rows in buckets and a filter of each bucket."""

    buckets: int
    rows: DataFrame  # digest, sha, n, best, bucket
    filters: DataFrame


def snapshot(rows: DataFrame, buckets: int) -> Snapshot:
    exact = kept(_groups(rows).select("*", _bucket(buckets)), "snapshot")

    def build(table: pa.Table) -> pa.Table:
        built = FuseFilter.of(table["digest"].to_numpy().view(np.uint64))
        return pa.table(
            {
                "bucket": table["bucket"][:1].cast(pa.int32()),
                "seed": [built.seed],
                "segment": [built.segment],
                "segments": [built.segments],
                "prints": pa.array([built.prints.tobytes()], pa.binary()),
            }
        )

    narrow = exact.select("bucket", "digest").groupBy("bucket")
    return Snapshot(buckets, exact, kept(narrow.applyInArrow(build, _FILTER), "filters"))


def screened(groups: DataFrame, old: Snapshot) -> DataFrame:
    """The digests of a batch that pass their bucket's filter: all that the snapshot has, and
    about one in 256 of the others."""

    def screen(new: pa.Table, filters: pa.Table) -> pa.Table:
        if not len(new) or not len(filters):
            return new.slice(0, 0).select(["digest"])
        row = filters.to_pylist()[0]
        prints = np.frombuffer(row["prints"], dtype=np.uint8)
        fuse = FuseFilter(row["seed"], row["segment"], row["segments"], prints)
        found = fuse.contains(new["digest"].to_numpy().view(np.uint64))
        return new.select(["digest"]).filter(pa.array(found))

    new = groups.select("digest", _bucket(old.buckets)).groupBy("bucket")
    return new.cogroup(old.filters.groupBy("bucket")).applyInArrow(screen, "digest long")


def duplicates(docs: DataFrame, batch: Column | None = None) -> DataFrame:
    """Every row with the group of its text: ``row`` (the given columns), ``rid``, ``doc_id``,
    ``sha`` (of the text without white space), ``keep_id``, ``group_size`` and ``kept``.

    ``batch`` says which rows make the snapshot (0) and which come after it (1); by default half
    of the doc_ids each. The groups are the same whatever it says.

    Of equal texts the row with the most code points stays, then the smallest doc_id (nulls
    last), then the first row read. A null text is empty, and all texts without any other
    characters are equal. Repeated rows are rows of their own. The given columns are packed in
    ``row``, so their names cannot clash. No rows give no rows.

    One text in a third of the rows is counted in part by every task, and the rows then meet one
    row per text in a join that Spark can split: both sides come straight from an exchange.
    """
    if batch is None:
        batch = F.pmod(F.xxhash64(docs["doc_id"].cast("long")), F.lit(2))
    rows = digested(docs, F.coalesce(batch, F.lit(0)))
    narrow = rows.select("rid", "doc_id", "points", "digest", "sha", "batch")
    new = kept(_groups(narrow.filter("batch = 1")), "batch-groups")
    old_rows = narrow.filter("batch = 0")
    most = max(new.count(), old_rows.count())
    old = snapshot(old_rows, max(1, -(-most // BUCKET_ROWS)))

    # Positives meet the exact rows of their digest, then their bytes are compared.
    hits = kept(screened(new, old).distinct(), "positives")
    found = (
        new.join(hits, "digest", "left_semi")
        .select("digest", F.col("sha").alias("new_sha"), F.col("best.rid").alias("new_rid"))
        .join(
            old.rows.select(
                "digest", F.col("sha").alias("old_sha"), F.col("best.rid").alias("old_rid")
            ),
            "digest",
        )
    )
    found = kept(found, "candidates")
    norm = F.translate(F.coalesce(F.col("row.text"), F.lit("")), SPACE, "")
    place = F.pmod("digest", F.lit(PLACES))
    places = F.broadcast(hits.select(place.alias("place")).distinct())  # at most PLACES rows
    few = rows.join(places, place == F.col("place"), "left_semi")
    bytes_of = few.select("rid", "batch", norm.alias("norm"))
    theirs = bytes_of.filter("batch = 1").select(F.col("rid").alias("new_rid"), F.col("norm"))
    ours = bytes_of.filter("batch = 0").select(
        F.col("rid").alias("old_rid"), F.col("norm").alias("old_norm")
    )
    equal = (
        found.join(theirs, "new_rid")
        .join(ours, "old_rid")
        .filter(F.col("norm") == F.col("old_norm"))
        .select("new_sha", "old_sha", F.col("digest"))
    )

    # A new text that the snapshot has joins its group; any other makes one.
    keys = ["digest", "sha"]
    ours = old.rows.select(F.lit(0).alias("batch"), *keys, "n", "best", F.lit(True).alias("known"))
    joined = new.join(
        equal.select("digest", F.col("new_sha").alias("sha"), F.lit(True).alias("hit")),
        keys,
        "left",
    )
    theirs = joined.select(
        F.lit(1).alias("batch"), *keys, "n", "best", F.coalesce("hit", F.lit(False)).alias("known")
    )
    both = ours.unionAll(theirs).groupBy("digest", "sha", "known")
    merged = both.agg(
        F.min("best").alias("best"),
        F.sum("n").alias("group_size"),
        F.collect_set("batch").alias("batches"),  # one or two
    )
    groups = merged.select(
        F.explode("batches").alias("batch"),
        *keys,
        F.col("best.rid").alias("keep_rid"),
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
    )
    groups = kept(groups, "groups")
    return rows.join(groups, ["digest", "sha", "batch"]).select(
        "row",
        "rid",
        "doc_id",
        "sha",
        "keep_id",
        "group_size",
        (F.col("rid") == F.col("keep_rid")).alias("kept"),
    )


def without_duplicates(docs: DataFrame, batch: Column | None = None) -> DataFrame:
    """``docs`` with one row of each group, as ``duplicates`` chooses it."""
    return duplicates(docs, batch).filter("kept").select("row.*")
