"""Best-fit packing of documents into sequences of a fixed number of tokens.

Large-item matching: pieces above a third of the capacity go at most two to a sequence, so the
largest is matched with the largest partner that fits, which leaves the most for the others.
Smaller pieces then go, largest first, where the least room that holds them is left.

Pieces of one length are alike, so the plan is made from counts by length, at most as many as
the capacity: its size does not grow with the corpus. It is a list of runs. A run takes the
next so many pieces of one length and lays them into consecutive sequences, a fixed number to
each. Every task then looks up the places of its own pieces by their rank among their length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswright.llm.common import binary_rows, kept, pieces_of
from saleswright.llm.tokens import encoder


def packing_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs as rows (length, first rank, pieces, first sequence, pieces in each, offset).

    The piece of rank ``first + i`` goes to sequence ``first sequence + i // each`` at
    ``offset + (i % each) * length``. Rows are sorted by length and rank.
    """
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("a piece must have 1 to capacity tokens")
    left = {length: n for length, n in counts.items() if n > 0}
    ranks: dict[int, int] = defaultdict(int)
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first sequence, how many)
    sizes: list[int] = []
    runs: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        runs.append((length, ranks[length], n, first, each, offset))
        ranks[length] += n

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if not rooms[room]:
                insort(sizes, room)
            rooms[room].append((first, n))

    # Large pieces, the largest first, each with the largest partner that fits.
    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large[-1]
        n = left[length]
        fitting = bisect_left(large, capacity - length + 1)
        partner = large[fitting - 1] if fitting else None
        if partner is None:
            pairs = 0
            put(length, n, sequences, 1, 0)
            leave(capacity - length, sequences, n)
            sequences += n
            left[length] = 0
        elif partner == length:
            pairs = n // 2
            if pairs:
                put(length, 2 * pairs, sequences, 2, 0)
                leave(capacity - 2 * length, sequences, pairs)
                sequences += pairs
            left[length] -= 2 * pairs
            if left[length]:  # one is over, and only smaller ones may go with it
                smaller = large[fitting - 2] if fitting > 1 else None
                put(length, 1, sequences, 1, 0)
                if smaller is None:
                    leave(capacity - length, sequences, 1)
                else:
                    put(smaller, 1, sequences, 1, length)
                    left[smaller] -= 1
                    leave(capacity - length - smaller, sequences, 1)
                    if not left[smaller]:
                        large.remove(smaller)
                sequences += 1
                left[length] = 0
        else:
            pairs = min(n, left[partner])
            put(length, pairs, sequences, 1, 0)
            put(partner, pairs, sequences, 1, length)
            leave(capacity - length - partner, sequences, pairs)
            sequences += pairs
            left[length] -= pairs
            left[partner] -= pairs
            if not left[partner]:
                large.remove(partner)
        if not left[length]:
            large.remove(length)

    # Small pieces, the largest first, each into the least room that holds it.
    for length in sorted((x for x in left if 3 * x <= capacity and left[x]), reverse=True):
        n = left[length]
        while n:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                room, each = capacity, capacity // length
                first, bins = sequences, -(-n // each)
                sequences += bins
            else:
                room = sizes[at]
                each = room // length
                first, bins = rooms[room].pop()
                if not rooms[room]:
                    del sizes[at]
            whole, over = divmod(min(n, bins * each), each)
            put(length, whole * each + over, first, each, capacity - room)
            leave(room - each * length, first, whole)
            if over:
                leave(room - over * length, first + whole, 1)
            used = whole + (over > 0)
            leave(room, first + used, bins - used)
            n -= whole * each + over
    plan = np.array(runs, dtype=np.int64).reshape(-1, 6)
    return plan[np.lexsort((plan[:, 1], plan[:, 0]))]


def cut_into_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of at most ``capacity`` ids, as cut, before they have places.

    Columns: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), and the rank of
    the piece among those of its length in its task (``_task``, ``_rank``).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in pieces_of(batches):
            ids, ends = encoder(vocabulary).encode(batch.column(1))
            rows = len(batch)
            lengths = np.diff(ends, prepend=0)
            ids = np.insert(ids, ends, end_id)
            lengths = lengths + 1
            n_pieces = -(-lengths // capacity)
            row = np.repeat(np.arange(rows), n_pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(lengths[row] - start, capacity)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.searchsorted(ordered, ordered)
            rank = np.empty(len(row), dtype=np.int64)
            rank[order] = np.arange(len(row)) - first + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    binary_rows(ids.astype("<u4"), np.cumsum(length) * 4),
                    pa.array(np.full(len(row), task), pa.int32()),
                    pa.array(rank, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids", "_task", "_rank"],
            )

    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    schema = "doc_id long, piece int, start long, length long, ids binary, _task int, _rank long"
    return docs.select(doc_id, "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """All documents' pieces with their places.

    Returns doc_id, piece (from 0), start (ids of the document before it), length, ids
    (little-endian unsigned 32-bit), sequence_id and offset. A document is its ids and
    ``end_id``; only one longer than ``capacity`` is cut. A null or empty text is ``end_id``
    alone. Equal and repeated rows are documents of their own; a null doc_id stays null.
    Columns but doc_id and text are not read. No documents give no rows.

    The texts are encoded once. Pieces never meet by length, which may be one for a third of
    them: tasks count their own, and the counts of the tasks are added up per length.
    """
    pieces = kept(cut_into_pieces(docs, vocabulary, capacity, end_id), "pieces")
    counts = kept(pieces.groupBy("_task", "length").agg(F.count("*").alias("n")), "piece-counts")
    by_length = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows
    plan = packing_plan({row["length"]: row["n"] for row in by_length}, capacity)
    before = (
        Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))
    places = counts.select("_task", "length", earlier.alias("_before"))
    span = np.int64(1) << 44  # above all ranks
    keys = plan[:, 0] * span + plan[:, 1]

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            run = plan[np.searchsorted(keys, length * span + rank, side="right") - 1]
            i = rank - run[:, 1]
            sequence, offset = run[:, 3] + i // run[:, 4], run[:, 5] + i % run[:, 4] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    ranked = pieces.join(places, ["_task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids", (F.col("_before") + F.col("_rank")).alias("r")
    )
    schema = (
        "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
    )
    return ranked.mapInArrow(lay, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, ids joined in order, and doc_ids in order.

    A sequence holds at most its capacity of pieces, so no group grows with the corpus.
    """
    part = F.struct("offset", "ids", "doc_id")
    parts = F.array_sort(F.collect_list(part))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("p"))
        .select(
            "sequence_id",
            F.expr("aggregate(p.ids, cast('' as binary), (a, x) -> a || x)").alias("ids"),
            F.col("p.doc_id").alias("doc_ids"),
        )
    )
