"""Hard-negative mining by inner products over an STR-packed R-tree.

Rows are sorted by label and first component and cut into slabs of a fixed number of rows. A task
packs a slab as sort-tile-recursive does: sorted along the coordinate that spreads most, cut into
equal runs, each run sorted along the next, down to leaves of ``LEAF`` rows. A leaf's minimum
bounding box gives an interval for every product of a query's component with a coordinate, and
the intervals' sums bound the score of all its rows.

A query takes leaves from a queue, the highest upper bound first. It leaves out boxes whose scores
all lie outside its windows of scores, and ends when the next box lies strictly below the kth score
that it has; a box that may reach the kth is opened, since a tie can be won by a smaller id. The best
of all slabs are then compared, so results are exact.

A slab and one batch of queries are all that a task holds. Queries are the different vectors and
labels of the anchors, so copies are searched for once. Of rows that are alike in vector and label
only the first few ids can be among the best, and only these are indexed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.llm.common import kept, positions

#: Rows of one slab, and of one leaf of its tree.
SLAB = 4096
LEAF = 64
#: Coordinates that tiles are cut along, and leaves that a query opens at a time.
TILED = 3
_OPEN = 8
#: Sums below this are exact as doubles.
_EXACT = float(1 << 53)


class Tree:
    """One slab: rows in packed order, and the box of each run of ``LEAF`` rows."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        order = _packed(vectors, labels)
        self.vectors, self.labels, self.ids = vectors[order], labels[order], ids[order]
        starts = np.arange(0, len(ids), LEAF)
        self.low = np.minimum.reduceat(self.vectors, starts, axis=0)
        self.high = np.maximum.reduceat(self.vectors, starts, axis=0)
        self.first_label = np.minimum.reduceat(self.labels, starts)
        self.last_label = np.maximum.reduceat(self.labels, starts)
        self.largest = int(np.abs(vectors).max(initial=0))
        self._doubles = self.vectors.astype(np.float64)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the highest score that rows of each leaf can have with each query."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        low = self._product(up, self.low) + self._product(down, self.high)
        high = self._product(up, self.high) + self._product(down, self.low)
        return low, high

    def scores(self, leaves: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of some leaves and their scores."""
        rows = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = rows[rows < len(self.ids)]
        if self._fits(query):
            return rows, (self._doubles[rows] @ query.astype(np.float64)).astype(np.int64)
        return rows, self.vectors[rows] @ query

    def _product(self, queries: np.ndarray, boxes: np.ndarray) -> np.ndarray:
        if self._fits(queries):
            return (queries.astype(np.float64) @ boxes.T.astype(np.float64)).astype(np.int64)
        return queries @ boxes.T

    def _fits(self, queries: np.ndarray) -> bool:
        most = int(np.abs(queries).max(initial=0))
        return self.largest * most * max(1, queries.shape[-1]) < _EXACT


def _packed(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The sort-tile-recursive order of rows: by label first, as labels are searched apart."""
    n, dim = vectors.shape
    spread = vectors.astype(np.float64).std(axis=0) if n and dim else np.empty(0)
    keys = [labels, *(vectors[:, c] for c in np.argsort(-spread, kind="stable")[:TILED])]

    def tile(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        leaves = -(-len(rows) // LEAF)
        if depth == len(keys) or leaves <= 1:
            return [rows]
        rows = rows[np.argsort(keys[depth][rows], kind="stable")]
        # Whole leaves in each run, and as many runs along each coordinate that is left.
        runs = math.ceil(leaves ** (1 / (len(keys) - depth)))
        size = -(-leaves // runs) * LEAF
        return [x for i in range(0, len(rows), size) for x in tile(rows[i : i + size], depth + 1)]

    parts = tile(np.arange(n), 0)
    return np.concatenate(parts) if parts else np.arange(0)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by the smaller id, in that order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def search(
    tree: Tree,
    query: np.ndarray,
    label: int,
    low: np.ndarray,
    high: np.ndarray,
    windows: list[tuple[int, int]],
    k: int,
    same: bool,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores (both ends belong to it): ids and scores of the k best rows in it of
    the same label, or of other labels. ``low`` and ``high`` bound the leaves' scores."""
    least, most = (np.array(x, dtype=np.int64) for x in zip(*windows, strict=True))
    found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    needed = least.copy()  # a box strictly below it has nothing for the window
    if same:
        has = (tree.first_label <= label) & (label <= tree.last_label)
    else:
        has = (tree.first_label != label) | (tree.last_label != label)
    queue = np.flatnonzero(has)
    queue = queue[np.argsort(-high[queue], kind="stable")]
    while len(queue):
        if high[queue[0]] < needed.min():
            break
        head, queue = queue[:_OPEN], queue[_OPEN:]
        useful = (high[head, None] >= needed) & (low[head, None] <= most)
        head = head[useful.any(axis=1)]
        if not len(head):
            continue
        rows, scores = tree.scores(head, query)
        right = (tree.labels[rows] == label) if same else (tree.labels[rows] != label)
        right &= scores >= needed.min()
        rows, scores = rows[right], scores[right]
        for w in range(len(windows)):
            mine = (scores >= needed[w]) & (scores <= most[w])
            if not mine.any():
                continue
            ids = np.concatenate((found[w][0], tree.ids[rows[mine]]))
            values = np.concatenate((found[w][1], scores[mine]))
            best = _first(values, ids, k)
            found[w] = ids[best], values[best]
            if len(best) == k:
                needed[w] = values[best[-1]]
    return found


# --- on Spark -------------------------------------------------------------------------

_INDEX = ["dim", "label", "vec_id", "vector"]


def usable(rows: DataFrame, scale: int = 256) -> DataFrame:
    """Rows (vec_id, vector, label, anchor) that take part, with ``dim`` and whole-number components
    floor(scale * x).

    A null vec_id, label or vector, or a null or non-finite component, keeps a row out; so does a
    component so large that a score would not fit a long.
    """
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    finite = F.forall(
        "vector", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))
    )
    most = F.floor(F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.col("dim"), F.lit(1))) / scale)
    there = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    sized = rows.filter(there & finite).withColumn("dim", F.size("vector"))
    fitting = sized.filter(F.forall("vector", lambda x: F.abs(x.cast("double")) < most))
    return fitting.select(
        "dim",
        F.col("label").cast("long").alias("label"),
        F.col("vec_id").cast("long").alias("vec_id"),
        whole.alias("vector"),
        F.coalesce("anchor", F.lit(False)).alias("anchor"),
    )


def _ranked(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key with their ``rank``; each task keeps k before the shuffle."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def _search_slabs(
    index: DataFrame,
    queries: DataFrame,
    per_slab: Callable[[Tree, pa.RecordBatch], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Each slab's answers to the queries sent to it. ``index`` and ``queries`` have slab, label,
    id, vector, dim and scores. A slab's rows come before its queries, both in a stream."""
    stream = index.select(*_STREAM, F.lit(0).alias("kind")).unionByName(
        queries.select(*_STREAM, F.lit(1).alias("kind"))
    )
    stream = stream.repartition("dim", "slab").sortWithinPartitions("dim", "slab", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, parts, tree = None, [], None
        for batch in batches:
            at = np.stack([batch.column(i).to_numpy() for i in (0, 1, 6)])
            cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
            ends = [*cuts.tolist(), len(batch)]
            for start, end in zip([0, *cuts.tolist()], ends, strict=True):
                if start == end:
                    continue
                some = batch.slice(start, end - start)
                if slab != (at[0, start], at[1, start]):
                    slab, parts, tree = (at[0, start], at[1, start]), [], None
                if not at[2, start]:
                    parts.append(some)
                elif parts or tree:
                    if tree is None:
                        tree, parts = _tree(parts), []
                    yield from per_slab(tree, some)

    return stream.mapInArrow(run, schema)


_STREAM = ["dim", "slab", "label", "id", "vector", "scores"]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    vectors = batch.column(4)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(batch), -1 if len(batch) and len(flat) else 0)


def _tree(parts: list[pa.RecordBatch]) -> Tree:
    labels, ids = (
        np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]) for i in (2, 3)
    )
    return Tree(np.concatenate([_matrix(p) for p in parts]), labels, ids)


def _positives_of(k: int) -> Callable[[Tree, pa.RecordBatch], Iterator[pa.RecordBatch]]:
    def answer(tree: Tree, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        queries = _matrix(batch)
        low, high = tree.bounds(queries)
        anywhere = [(-(1 << 63), (1 << 63) - 1)]
        out = []
        for i, (label, qid) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            ((ids, scores),) = search(tree, queries[i], label, low[i], high[i], anywhere, k, True)
            out.append((np.full(len(ids), qid), ids, scores))
        yield _columns(out, ["qid", "vec_id", "score"])

    return answer


def _negatives_of(
    k: int, least: int, most: int
) -> Callable[[Tree, pa.RecordBatch], Iterator[pa.RecordBatch]]:
    def answer(tree: Tree, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        queries = _matrix(batch)
        low, high = tree.bounds(queries)
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in (2, 3, 5)), strict=True)
        for i, (label, qid, positive) in enumerate(rows):
            windows = [(-(-least * p // 100), most * p // 100) for p in positive]
            found = search(tree, queries[i], label, low[i], high[i], windows, k, False)
            for p, (ids, scores) in zip(positive, found, strict=True):
                out.append((np.full(len(ids), qid), np.full(len(ids), p), ids, scores))
        yield _columns(out, ["qid", "positive_score", "vec_id", "score"])

    return answer


def _columns(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    none = np.empty(0, np.int64)
    arrays = [np.concatenate([none, *x]) for x in zip(*parts)] or [none] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], names)


def hard_negatives(
    rows: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
) -> DataFrame:
    """For each anchor and each of its positives, the hardest negatives in the window of scores.

    ``rows`` has vec_id, vector, label and ``anchor``, which says whether the row asks. A score is
    the inner product of whole-number vectors (see ``usable``). An anchor's positives are the other
    rows of its label with the highest scores; negatives are rows of other labels whose score is
    ``least`` to ``most`` per cent of the positive's, the highest first. Equal scores go by the
    smaller vec_id. Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows meet those with as many components. Repeated rows are rows of their own, each other's
    positives, and anchors of their own. Anchors without positives or negatives give no rows.
    """
    alike = ["dim", "label", "vector"]
    all_rows = kept(usable(rows, scale), "usable")
    anchors = all_rows.filter("anchor").select(*alike, "vec_id")
    # A row's copies with smaller ids come before it anywhere, so the first few copies are enough;
    # one more, as one of them may be the anchor.
    first = _ranked(all_rows, alike, [F.asc("vec_id")], max(positives + 1, negatives))
    lead = F.coalesce(F.try_element_at("vector", F.lit(1)), F.lit(0).cast("long"))
    order = [F.col("label").asc(), lead.asc()]
    index = kept(positions(first.select(*_INDEX), ["dim"], order, "slab-order"), "index")
    labels = index.groupBy("dim", "label").agg(F.min("idx").alias("start"), F.count("*").alias("rows"))
    labels = kept(labels, "labels")
    asked = anchors.select(*alike).distinct()
    asked = kept(asked.withColumn("id", F.monotonically_increasing_id()), "queries")

    # Positives: slabs that hold rows of the query's label.
    none = F.array().cast("array<bigint>").alias("scores")
    stored = index.select(
        "dim", F.expr(f"idx div {SLAB}").alias("slab"), "label", F.col("vec_id").alias("id"), "vector", none
    )
    slabs = F.sequence(
        F.expr(f"start div {SLAB}"), F.expr(f"(start + rows - 1) div {SLAB}")
    )
    sent = asked.join(labels, ["dim", "label"]).withColumn("slab", F.explode(slabs))
    near = _search_slabs(
        stored, sent.withColumn("scores", none), _positives_of(positives + 1), "qid long, vec_id long, score long"
    )
    best = [F.desc("score"), F.asc("vec_id")]
    top = _ranked(near, ["qid"], best, positives + 1)
    one = F.struct("rank", "vec_id", "score").alias("one")
    top = top.groupBy("qid").agg(F.array_sort(F.collect_list(one)).alias("top"))
    top = kept(top, "positives")

    # Negatives: all slabs, for the windows of the different scores of the positives.
    scores = F.array_sort(F.array_distinct(F.transform("top", lambda x: x["score"])))
    windowed = F.filter(scores, lambda s: s >= 0 if least <= most else s <= 0)  # else empty
    sizes = labels.groupBy("dim").agg(F.sum("rows").alias("n"))
    every = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {SLAB}"))
    told = top.select(F.col("qid").alias("id"), windowed.alias("scores")).filter(F.size("scores") > 0)
    sent = asked.join(told, "id").join(sizes, "dim").withColumn("slab", F.explode(every))
    far = _search_slabs(
        stored,
        sent,
        _negatives_of(negatives, least, most),
        "qid long, positive_score long, vec_id long, score long",
    )
    hard = _ranked(far, ["qid", "positive_score"], best, negatives)
    one = F.struct("rank", "vec_id", "score").alias("one")
    hard = hard.groupBy("qid", "positive_score").agg(F.array_sort(F.collect_list(one)).alias("hard"))
    hard = kept(hard, "negatives")

    # Each anchor takes its query's positives, without itself, and their negatives.
    of_anchor = anchors.join(asked, alike).select(
        F.col("vec_id").alias("anchor_id"), F.col("id").alias("qid"), _product("vector").alias("own")
    )
    others = of_anchor.join(top, "qid").select(
        "qid", "anchor_id", F.slice(_without_one("top", "anchor_id", "own"), 1, positives).alias("p")
    )
    each = others.select("qid", "anchor_id", F.explode("p").alias("p")).select(
        "qid", "anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score")
    )
    met = each.join(hard, ["qid", "positive_score"]).select("*", F.explode("hard").alias("h"))
    return met.select(
        "anchor_id",
        "positive_id",
        F.col("h.rank").cast("int").alias("rank"),
        F.col("h.vec_id").alias("negative_id"),
        "positive_score",
        F.col("h.score").alias("negative_score"),
    )


def _product(vector: str) -> Column:
    """A vector's inner product with itself."""
    return F.aggregate(vector, F.lit(0).cast("long"), lambda s, x: s + x * x)


def _without_one(top: str, vec_id: str, score: str) -> Column:
    """The list without one entry of that id and score, if there is any."""
    is_own = lambda x: (x["vec_id"] == F.col(vec_id)) & (x["score"] == F.col(score))
    at = F.array_position(F.transform(top, is_own), F.lit(True))
    return F.when(at == 0, F.col(top)).otherwise(F.filter(top, lambda x, i: i + 1 != at))
