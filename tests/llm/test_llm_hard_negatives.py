"""Hard negatives against all pairs, and the tree's boxes and order by themselves."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from saleswright.llm import hard_negatives as module
from saleswright.llm.hard_negatives import LEAF, Tree, hard_negatives, search
from saleswright.llm.queries import QUERIES

ROWS = "vec_id long, vector array<float>, label int, anchor boolean, dim string, id string, slab string"


def whole(row):
    vec_id, vector, label = row[:3]
    if vec_id is None or label is None or vector is None:
        return None
    if any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def by_hand(rows, positives=5, negatives=3):
    """All pairs: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    used = [(r[0], whole(r), r[2], bool(r[3])) for r in rows if whole(r) is not None]
    found = Counter()
    for i, (anchor, a, label, asks) in enumerate(used):
        if not asks:
            continue
        others = [(-sum(map(int.__mul__, a, b)), x, other == label) for j, (x, b, other, _) in enumerate(used) if j != i and len(a) == len(b)]
        for score, positive, _ in sorted(o for o in others if o[2])[:positives]:
            fit = sorted(o for o in others if not o[2] and 50 * -score <= 100 * -o[0] <= 95 * -score)
            for rank, (other, negative, _) in enumerate(fit[:negatives], 1):
                found[(anchor, positive, rank, negative, -score, -other)] += 1
    return found


def table(spark, rows):
    return spark.createDataFrame([(*r, "d", "i", "s") for r in rows], ROWS).repartition(3)


def some_rows(seed, n, dim=5, labels=3, values=6):
    rnd = random.Random(seed)
    return [
        (i, [rnd.randint(-values, values) / 8 for _ in range(dim)], rnd.randrange(labels), rnd.random() < 0.2)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed,n,slab", [(1, 400, 4096), (2, 400, 16), (3, 60, 7)])
def test_all_pairs(spark, monkeypatch, seed, n, slab):
    """Few values, so that scores tie; slabs of other sizes give the same."""
    monkeypatch.setattr(module, "SLAB", slab)
    rows = some_rows(seed, n)
    assert Counter(map(tuple, hard_negatives(table(spark, rows)).collect())) == by_hand(rows)


def test_odd_rows(spark, monkeypatch):
    """Nulls, NaN and infinity, vectors of other lengths and none, repeated rows and ids."""
    monkeypatch.setattr(module, "SLAB", 16)
    rows = some_rows(4, 80) + some_rows(5, 40, dim=2) + some_rows(6, 9, dim=0)
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1, True), (501, [nan] * 5, 1, True), (502, [inf, 0.0, 0.0, 0.0, 0.0], 1, True)]
    rows += [(503, [None] * 5, 1, True), (504, [0.5] * 5, None, True), (None, [0.5] * 5, 1, True)]
    rows += [(505, [0.25] * 5, 1, None), (506, [0.0] * 5, 2, True), *rows[:10], *rows[:3]]
    rows += [(3, [0.75] * 5, 1, True), (3, [0.75] * 5, 0, True)]
    assert Counter(map(tuple, hard_negatives(table(spark, rows)).collect())) == by_hand(rows)


def test_one_vector_in_most_rows(spark, monkeypatch):
    monkeypatch.setattr(module, "SLAB", 32)
    rows = [(i, [0.5, 0.5, 0.25], i % 2, i % 10 == 0) for i in range(300)]
    rows += [(1000 + i, [0.5, 0.25, 0.25 + (i % 5) / 16], i % 3, i % 7 == 0) for i in range(60)]
    random.Random(1).shuffle(rows)
    assert Counter(map(tuple, hard_negatives(table(spark, rows)).collect())) == by_hand(rows)


def test_too_large_for_a_long_takes_no_part(spark):
    rows = [(1, [3e38, 0.0], 1, True), *[(i, [0.5, 0.5 - i / 64], i % 2, True) for i in range(2, 9)]]
    assert Counter(map(tuple, hard_negatives(table(spark, rows)).collect())) == by_hand(rows[1:])


def test_large_components_are_exact(spark):
    """Beyond what doubles add up exactly."""
    rows = [(i, [2.0**18 + i / 256, 2.0**18 - 3 * i / 256, i / 256], i % 2, True) for i in range(40)]
    rows += [(100 + i, [(2.0**18 + i) * 0.75, 2.0**18 * 0.75, 0.0], i % 2, False) for i in range(40)]
    assert Counter(map(tuple, hard_negatives(table(spark, rows)).collect())) == by_hand(rows)


def test_no_rows_and_no_anchors(spark):
    assert hard_negatives(table(spark, [])).count() == 0
    assert hard_negatives(table(spark, [(1, [1.0], 1, False), (2, [1.0], 1, False)])).count() == 0
    assert hard_negatives(table(spark, [(1, [1.0], 1, True)])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 500), st.integers(0, 6))
def test_boxes_bound_the_scores_of_their_rows(seed, n, dim):
    rng = np.random.default_rng(seed)
    vectors, labels = rng.integers(-9, 10, (n, dim)), rng.integers(0, 3, n)
    tree = Tree(vectors, labels, np.arange(n))
    assert sorted(tree.ids.tolist()) == list(range(n))
    queries = rng.integers(-9, 10, (4, dim))
    low, high = tree.bounds(queries)
    for q, a, b in zip(queries, low, high, strict=True):
        scores = tree.vectors @ q
        for leaf in range(len(a)):
            some = scores[leaf * LEAF : (leaf + 1) * LEAF]
            assert a[leaf] <= some.min() and some.max() <= b[leaf]


def test_boxes_that_cannot_help_stay_closed(monkeypatch):
    """Points far apart along the coordinates: a query opens few of the leaves."""
    grid = np.array([(x, y, z) for x in range(0, 160, 10) for y in range(0, 160, 10) for z in range(0, 160, 10)])
    tree = Tree(grid, np.zeros(len(grid), int), np.arange(len(grid)))
    query = np.array([1, 1, 1])
    low, high = tree.bounds(query[None])
    opened, real = [], Tree.scores
    monkeypatch.setattr(Tree, "scores", lambda self, leaves, q: (opened.extend(leaves), real(self, leaves, q))[1])
    ((ids, scores),) = search(tree, query, 0, low[0], high[0], [(-(1 << 63), (1 << 63) - 1)], 5, True)
    assert scores.tolist() == sorted(grid.sum(axis=1).tolist())[:-6:-1]
    assert len(opened) <= len(grid) // LEAF // 4
    opened.clear()
    ((ids, scores),) = search(tree, query, 1, low[0], high[0], [(100, 110)], 3, False)
    assert scores.tolist() == [110] * 3 and len(opened) < len(grid) // LEAF


def test_query_against_all_pairs(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, (x + 1) % 10 if i % 7 == 0 else x, i % 50 == 0) for i, v, x in rows]
    assert Counter(map(tuple, QUERIES["op13_hard_negatives"](spark, data).collect())) == by_hand(rows)
