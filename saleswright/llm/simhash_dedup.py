"""Near-duplicates by SimHash: fingerprints, links at few differing bits, and their components.

Two fingerprints that differ in at most 4 of 64 bits agree on at least 3 of 7 blocks of bits, so
each different fingerprint goes to the 35 buckets of its block triples (27 or 28 bits). In a
bucket, the pivot tables come in: the Hamming distances of its fingerprints to reference
fingerprints are computed once (again in each of a fingerprint's buckets, which costs less than
to shuffle them); two fingerprints whose distances to any reference differ by more than 4
cannot be linked, and only pairs that pass are verified. Distances from the references alone
cannot make buckets: for 64 bits they lie around 32 with a deviation of 4, no wider than
the bound itself, so cells of them would hold most of the fingerprints.

A bucket gives no pairs but a spanning forest of its links: fewer rows than it has fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import kept, pieces_of

#: Hamming distance up to which fingerprints are linked, at most.
MOST_BITS = 4
SHINGLE = 4
PIVOTS = 16
_BLOCKS, _EQUAL = 7, 3
#: Pairs that a task looks at in one step.
_STEP = 1 << 22


def fingerprint(words: list[bytes], size: int = SHINGLE) -> int:
    """The fingerprint of a text's words (no words: 0)."""
    if not words:
        return 0
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(size)))))
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(x, 42) for x in shingles), np.dtype("<u8"), len(shingles)
    )
    # Bits are counted in bytes, 255 rows at a time, which fit.
    counts = np.zeros(64, dtype=np.int64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    for start in range(0, len(bits), 255):
        counts += np.add.reduce(bits[start : start + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """rid, doc_id and ``fp``, the fingerprint's bits in a long, of rows (rid, doc_id, text).

    Words are [^\\x20\\x09-\\x0D]+ of the text with A-Z in lower case; a null text has none.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, most=1 << 20):
            texts = pc.fill_null(batch.column(2), "").cast(pa.binary()).to_pylist()
            fps = [fingerprint(text.lower().split(), size) for text in texts]
            values = np.array(fps, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(values)], ["rid", "doc_id", "fp"]
            )

    narrow = rows.select("rid", F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(mark, "rid long, doc_id long, fp long")


def _masks() -> list[int]:
    """Bit masks of all triples of the seven blocks."""
    cuts = [round(64 * i / _BLOCKS) for i in range(_BLOCKS + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(some) for some in combinations(blocks, _EQUAL)]


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: the same for every bucket and run."""
    return np.random.default_rng(7).integers(0, 1 << 64, n, dtype=np.uint64)


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def bucket_links(fps: np.ndarray, bits: int) -> np.ndarray:
    """Pairs (places in ``fps``) of a spanning forest of all links among ``fps``.

    Rows are taken in steps, so memory does not grow with the bucket. Fingerprints are sorted by
    their distance to the first reference, which bounds the partners of each; the other
    references discard pairs; those left that are not yet connected are verified.
    """
    n = len(fps)
    table = np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int16)
    order = np.argsort(table[:, 0], kind="stable")
    table, fps = table[order], fps[order]
    parent, links = np.arange(n), []
    ends = np.searchsorted(table[:, 0], table[:, 0] + bits, side="right")
    start = 0
    while start < n:
        reach = np.cumsum(ends[start:] - np.arange(start, n))
        stop = start + max(1, int(np.searchsorted(reach, _STEP, side="right")))
        counts = ends[start:stop] - np.arange(start, stop) - 1
        a = np.repeat(np.arange(start, stop), counts)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
        apart = parent[a] != parent[b]
        a, b = a[apart], b[apart]
        for i in range(1, table.shape[1]):
            if not len(a):
                break
            near = np.abs(table[a, i] - table[b, i]) <= bits
            a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= bits
        for pair in zip(a[near].tolist(), b[near].tolist(), strict=True):
            x, y = pair
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            while parent[y] != y:
                parent[y] = parent[parent[y]]
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append(pair)
        parent = _roots(parent)
        start = stop
    pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
    return order[pairs]


def _near_pairs(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Of pairs (a[i], b[i]): those that the pivots do not discard and that are near."""
    for pivot in pivots():
        far = np.bitwise_count(a.view(np.uint64) ^ pivot).astype(np.int16)
        far -= np.bitwise_count(b.view(np.uint64) ^ pivot)
        near = np.abs(far) <= bits
        a, b = a[near], b[near]
    near = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= bits
    return np.stack((a[near], b[near]), axis=1)


def links(distinct: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """Pairs (a, b) of fingerprints that connect all that differ in at most ``bits`` bits.

    ``distinct`` has one row per fingerprint (``fp``). Rows of a bucket are sorted together and
    streamed to a task, bucket after bucket.
    """
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"bits must be 0 to {MOST_BITS}")
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in _masks()])
    keyed = distinct.select("fp", F.posexplode(masks).alias("m", "mask")).select(
        F.xxhash64("m", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp"
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            fps = np.concatenate((fps, batch.column(1).to_numpy()))
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            yield from found(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
        yield from found(keys, fps)

    def found(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        ends = np.append(starts[1:], len(keys))
        pair = starts[ends - starts == 2]  # by far the most common: all at once
        out = [_near_pairs(fps[pair], fps[pair + 1], bits)]
        for a, b in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
            some = fps[a:b]
            out.append(some[bucket_links(some.view(np.uint64), bits)])
        pairs = np.concatenate(out)
        if len(pairs):
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], ["a", "b"]
            )

    gathered = keyed.repartition("key").sortWithinPartitions("key")
    return gathered.mapInArrow(join, "a long, b long").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of ``pairs`` (a, b): one label per component.

    Labels start as the node itself. In each round a node takes the least label around it, and
    then the label of its label, so paths shrink by half. Rounds are written to the shared
    folder. A label that a third of the nodes share meets its one row in a join that Spark splits.
    """
    both = kept(pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = kept(
        both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
            .groupBy("a")
            .agg(F.min("l").alias("l"))
            .select(F.col("a").alias("node"), "l")
        )
        stepped = labels.join(near, "node").select(
            "node", F.least("label", "l").alias("label"), F.col("label").alias("old")
        )
        stepped = kept(stepped, "labels")
        up = stepped.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = stepped.join(up, "label").select("node", F.col("up").alias("label"), "old")
        jumped = kept(jumped, "labels")
        if jumped.filter("label <> old").isEmpty():
            return jumped.drop("old")
        labels = jumped.drop("old")


def near_duplicates(
    rows: DataFrame, bits: int = MOST_BITS, size: int = SHINGLE
) -> DataFrame:
    """One row per row of ``rows`` (rid, doc_id, text): rid, doc_id, ``fp``, ``component_id``
    (the least doc_id that links lead to) and ``kept``, true for one row of each component.

    ``rid`` numbers the rows. Texts without words have fingerprint 0 and are linked like any
    other; so are repeated rows. Null doc_ids count last: a component_id is null if all are.
    The least doc_id's row stays, and of rows that repeat it the least rid. No rows give no rows.
    """
    marked = kept(fingerprints(rows, size), "fingerprints")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    firsts = kept(marked.groupBy("fp").agg(F.min(place).alias("first")), "distinct")
    labels = components(kept(links(firsts.select("fp"), bits), "pairs"))
    labelled = firsts.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    labelled = kept(labelled, "labelled")
    least = kept(labelled.groupBy("label").agg(F.min("first").alias("least")), "least")
    named = labelled.join(least, "label").select(
        "fp", F.col("least.doc_id").alias("component_id"), F.col("least.rid").alias("keep_rid")
    )
    return marked.join(kept(named, "named"), "fp").select(
        "rid", "doc_id", "fp", "component_id", (F.col("rid") == F.col("keep_rid")).alias("kept")
    )


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` as one column ``row``, so that names cannot clash, with a number ``rid``."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    return docs.select(F.monotonically_increasing_id().alias("rid"), row)


def without_near_duplicates(
    docs: DataFrame, bits: int = MOST_BITS, size: int = SHINGLE
) -> DataFrame:
    """``docs`` with one row of each component, as ``near_duplicates`` chooses it."""
    rows = kept(numbered(docs), "numbered")
    groups = near_duplicates(rows.select("rid", "row.doc_id", "row.text"), bits, size)
    stay = kept(groups.filter("kept").select("rid"), "staying")
    return rows.join(stay, "rid", "left_semi").select("row.*")
