"""Toxicity by a factorization machine over hashed terms.

Besides a weight per term the machine learns a vector per term; the product of two terms' vectors
is the weight of their meeting in one text, such as an insult and a group's name, which adding
up single weights cannot tell from either alone.

Terms, words and how they begin, are hashed into a fixed space, and every term of the texts that
the machine is fitted to is its input, but those of a single one of these texts. None is chosen
by how it goes with the class by itself: a term may tell nothing alone and much beside another.
The machine is fitted on the driver to about ``MOST_ROWS`` training texts of each class, taken by
a hash of their text and weighted up to all of them, so its memory does not grow with the labels.
Scoring is one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import digest, kept, pieces_of, text_or_empty

#: Hashed terms there can be, and training texts of each class.
SPACE_BITS = 22
BEGINNINGS = (4, 5, 6)
MOST_ROWS = 10_000
#: Texts of the fit that a term must be in: of one alone it can only tell that text.
LEAST_TEXTS = 2
#: Training texts whose digests every task may hold; more are joined to the documents by a shuffle.
BROADCAST_LABELS = 1_000_000
FACTORS = 8
#: Steps at least, texts of a step, and times that each text is seen at least.
STEPS = 200
STEP_ROWS = 1024
ROUNDS = 8


@dataclass(frozen=True)
class Doubt:
    """How far the fit trusts what it sees.

    ``weight`` and ``vector``: times its deviation by chance that a term's pull must be to move a
    weight from 0, and that a pair's must be to make vectors grow. Weights beyond ``sure`` are
    hardly held back any more. ``calm``: terms of a text up to which steps are of full size.

    The defaults have the highest F1 of ``grid`` over folds within training rows (``compared``;
    the lower loss where two are equal).
    """

    weight: float = 5.0
    vector: float = 0.5
    sure: float = 0.05
    calm: float = 60


#: Entries that are counted at a time.
_AT_ONCE = 1 << 20
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different words (A-Z in lower case) and, for each word of the texts, its row and place."""
    words = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), _NOT_WORD)
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy())
    coded = words.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), rows, coded.indices.to_numpy()


def _hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed terms of words, and the word of each: the word itself and how it begins."""
    found, mask = xxhash.xxh3_64_intdigest, (1 << SPACE_BITS) - 1
    terms, at = [found(word) & mask for word in words], list(range(len(words)))
    for length in BEGINNINGS:
        some = [i for i, word in enumerate(words) if len(word) > length]
        terms += [found(words[i][:length] + "*") & mask for i in some]
        at += some
    terms, at = np.array(terms, dtype=np.int64), np.array(at, dtype=np.int64)
    written = np.array([bool(word) for word in words], dtype=bool)
    return terms[written[at]], at[written[at]]


def _in_rows(
    rows: np.ndarray, codes: np.ndarray, n_words: int, values: np.ndarray, at: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of words that have some, each value once per row, sorted by row."""
    order = np.argsort(at, kind="stable")
    values, per = values[order], np.bincount(at, minlength=n_words)
    some = per[codes] > 0
    rows, codes = rows[some], codes[some]
    n = per[codes]
    first = (np.cumsum(per) - per)[codes]
    place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    keys = np.sort(np.repeat(rows, n) << SPACE_BITS | values[place])
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    return keys >> SPACE_BITS, keys & ((1 << SPACE_BITS) - 1)


#: Terms, rows and places of entries (rows ascend), classes and weights of rows.
Sample = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Machine:
    """Hashed terms (sorted), the bias, a weight and a vector per term."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rows and places of the machine's terms in texts, each once per row."""
        words, rows, codes = _words(texts)
        terms, at = _hashed(words)
        if not len(self.terms) or not len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        some = self.terms[place] == terms
        return _in_rows(rows, codes, len(words), place[some], at[some])

    def margins(self, rows: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        pairs = -np.bincount(rows, (self.vectors**2).sum(axis=1)[places], n)
        for factor in self.vectors.T:
            pairs += np.bincount(rows, factor[places], n) ** 2
        return self.bias + np.bincount(rows, self.weights[places], n) + 0.5 * pairs

    def scores(self, texts: pa.Array) -> np.ndarray:
        rows, places = self.features(texts)
        return 1 / (1 + np.exp(-np.clip(self.margins(rows, places, len(texts)), -30, 30)))


def fit(
    terms: np.ndarray,
    rows: np.ndarray,
    places: np.ndarray,
    toxic: np.ndarray,
    weight: np.ndarray,
    doubt: Doubt = Doubt(),
) -> Machine:
    """Weighted logistic loss, ``STEP_ROWS`` rows in a step (Adam), weights and vectors kept small.

    ``rows`` ascend. Sums over a row's or a term's entries are taken over runs of sorted entries.
    Rows take turns in an order drawn once; few rows are all in each step.
    """
    n, m = len(toxic), len(terms)
    share = (float((weight * toxic).sum()) + 0.5) / (float(weight.sum()) + 2)
    rng = np.random.default_rng(11)
    bias = float(np.log(share / (1 - share)))
    if not m or not len(rows):
        return Machine(terms, bias, np.zeros(m), np.zeros((m, FACTORS)))
    parts = -(-n // STEP_ROWS)
    weight = weight * (parts / weight.sum())
    # Texts of many terms take smaller steps: all of a text's terms move its margin together.
    ends = np.searchsorted(rows, np.arange(n + 1, dtype=rows.dtype))
    terms_of = np.diff(ends)
    calm = max(1.0, float(np.median(terms_of)) / doubt.calm)
    # A term's weight and vector are a column; the bias is the last column's weight.
    values = np.zeros((1 + FACTORS, m + 1), dtype=np.float32)
    values[1:, :m] = rng.normal(0, 0.01, (FACTORS, m))
    values[0, m] = bias
    # How much a term's gradient is off by chance: less than a few times that moves nothing.
    chance = np.zeros(m + 1, dtype=np.float32)
    chance[:m] = _by_chance(places, rows, weight / parts, m, share)
    # A vector's pull is off by as much for each of the terms beside it.
    beside = np.zeros(m + 1, dtype=np.float32)
    beside[:m] = _by_chance(places, rows, weight * terms_of / parts, m, share)
    keep_small = np.maximum(doubt.vector * beside, 1e-3)
    first_rate = np.array([[0.1 / calm], *[[0.02 / calm]] * FACTORS], dtype=np.float32)
    mean, square = np.zeros_like(values), np.zeros_like(values)
    order = rng.permutation(n)
    steps = max(STEPS, ROUNDS * parts)
    for step in range(1, steps + 1):
        rate = first_rate * min(1.0, 2 * (1 - (step - 1) / steps))
        some = np.sort(order[(step - 1) % parts :: parts])
        at, per = _runs(ends[some], ends[some + 1])
        has, first = np.flatnonzero(per), (np.cumsum(per) - per)[per > 0]
        here, of_row = places[at], np.repeat(np.arange(len(some)), per)
        by_term = np.argsort(here, kind="stable")
        used, start = np.unique(here[by_term], return_index=True)
        entries = values.take(here, axis=1)
        sums = np.zeros((1 + FACTORS, len(some)), dtype=np.float32)
        own = np.zeros(len(some), dtype=np.float32)
        if len(has):
            sums[:, has] = np.add.reduceat(entries, first, axis=1)
            own[has] = np.add.reduceat((entries[1:] ** 2).sum(axis=0), first)
        margin = values[0, m] + sums[0] + 0.5 * ((sums[1:] ** 2).sum(axis=0) - own)
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic[some]
        error = (weight[some] * error).astype(np.float32)
        pulls = np.zeros((1 + FACTORS, 0), dtype=np.float32)
        if len(has):
            pull = sums.take(of_row, axis=1)
            pull[0] = 1
            pull[1:] -= entries[1:]
            pull *= error.take(of_row)
            pulls = np.add.reduceat(pull.take(by_term, axis=1), start, axis=1)
        # Weights and each factor in turn, so that no more than a column of all terms is made anew.
        for f in range(1 + FACTORS):
            gradient = keep_small * values[f] if f else np.zeros(m + 1, dtype=np.float32)
            gradient[m] = 0 if f else error.sum()
            gradient[used] += pulls[f]
            mean[f] += 0.1 * (gradient - mean[f])
            square[f] += 0.001 * (gradient**2 - square[f])
            scaled = np.sqrt(square[f] / (1 - 0.999**step)) + 1e-9
            values[f] -= rate[f] * mean[f] / (1 - 0.9**step) / scaled
            if not f:
                held = doubt.weight * chance / (1 + (values[0] / doubt.sure) ** 2)
                over = np.abs(values[0]) - held * rate[0] / scaled
                values[0] = np.copysign(np.maximum(over, 0), values[0])
    return Machine(terms, float(values[0, m]), values[0, :m].copy(), values[1:, :m].T)


def _by_chance(
    places: np.ndarray, rows: np.ndarray, weight: np.ndarray, m: int, share: float
) -> np.ndarray:
    """The deviation of each term's gradient over texts whose classes are drawn by ``share``."""
    total, squares = np.zeros(m), weight**2
    for i in range(0, len(rows), _AT_ONCE):
        total += np.bincount(places[i : i + _AT_ONCE], squares[rows[i : i + _AT_ONCE]], m)
    return np.sqrt(total * share * (1 - share))


def _runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from each start to its end, one run after another, and the runs' lengths."""
    per = ends - starts
    return np.arange(int(per.sum())) + np.repeat(starts - (np.cumsum(per) - per), per), per


def compared(sample: Sample, doubts: list[Doubt], folds: int = 3) -> list[tuple[float, float]]:
    """For each of ``doubts``: F1 of the toxic texts at a score of 0.5, and the mean logistic loss,
    over all texts of the sample, each scored by a machine fitted to the folds it is not in.

    This is how the defaults of ``Doubt`` are chosen, from training texts alone. Texts are dealt
    to the folds by class in the order of their terms, so that near copies share a fold often.
    """
    terms, rows, places, toxic, weight = sample
    n = len(toxic)
    ends = np.searchsorted(rows, np.arange(n + 1, dtype=rows.dtype))
    first = np.full(n, -1)
    some = np.diff(ends) > 0
    first[some] = places[ends[:-1][some]]
    rank = np.empty(n, dtype=np.int64)
    rank[np.lexsort((first, toxic))] = np.arange(n)
    of = np.where(toxic == 1, rank - int((toxic == 0).sum()), rank)
    size = np.where(toxic == 1, max(1, int((toxic == 1).sum())), max(1, int((toxic == 0).sum())))
    of = of * folds // size
    out = []
    for doubt in doubts:
        margins = np.zeros(n)
        for fold in range(folds):
            learns = of != fold
            there = learns[rows]
            machine = fit(
                terms,
                (np.cumsum(learns) - 1)[rows[there]],
                places[there],
                toxic[learns],
                weight[learns],
                doubt,
            )
            back = np.cumsum(~learns) - 1
            margins[~learns] = machine.margins(
                back[rows[~there]], places[~there], int((~learns).sum())
            )
        hit = float((weight * toxic * (margins >= 0)).sum())
        called = float((weight * (margins >= 0)).sum())
        real = float((weight * toxic).sum())
        loss = np.logaddexp(0, np.where(toxic == 1, -margins, margins))
        out.append((2 * hit / max(called + real, 1e-9), float(np.average(loss, weights=weight))))
    return out


def grid() -> list[Doubt]:
    """The settings that were compared: a first grid, and one beyond the edges its best lay at."""
    first = product((1.5, 3.0), (0.05, 0.2), (0.05, 0.1), (30, 60))
    second = product((3.0, 5.0), (0.2, 0.5), (0.05,), (60, 120))
    return [Doubt(*some) for some in dict.fromkeys([*first, *second])]


def train(docs: DataFrame, labels: DataFrame, learns: Column) -> Machine:
    """Fit a machine to the labelled rows of ``docs`` (doc_id, text) for whose ``doc_id`` the
    column ``learns`` holds: see ``training_sample``. Without texts of both classes the machine
    has no terms and scores every text by the share of toxic ones, below a half.
    """
    return fit(*training_sample(docs, labels, learns))


def training_sample(docs: DataFrame, labels: DataFrame, learns: Column) -> Sample:
    """What a machine is fitted to: terms, rows and places of their entries, classes and weights
    of the sample of labelled rows of ``docs`` (doc_id, text) for whose ``doc_id`` ``learns`` holds.

    Of a doc_id's several labels the toxic one counts; null labels and doc_ids do not. Equal texts
    are one training text, toxic if any is; a row that repeats both doc_id and text counts again.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .filter(learns)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text")
    )
    first, second = digest(F.col("text"))
    texts = texts.withColumns({"d1": first, "d2": second})
    # One row of each text: equal texts meet as digests, and no text is shuffled for it.
    chosen = (
        texts.drop("text")
        .join(marks, "doc_id")
        .groupBy("d1", "d2")
        .agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    )
    chosen = kept(chosen, "training-texts")
    sizes = {row["toxic"]: row["count"] for row in chosen.groupBy("toxic").count().collect()}
    few = sum(sizes.values()) <= BROADCAST_LABELS
    labelled = texts.join(F.broadcast(chosen) if few else chosen, ["doc_id", "d1", "d2"])
    labelled = labelled.select("text", "toxic", "d1")
    span = 1 << 30
    share = {label: min(1.0, MOST_ROWS / n) for label, n in sizes.items()}
    limit = F.when(F.col("toxic") == 1, int(share.get(1, 0) * span)).otherwise(
        int(share.get(0, 0) * span)
    )
    sample = labelled.filter(F.pmod("d1", F.lit(span)) < limit)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            words, rows, codes = _words(batch.column(0))
            rows, terms = _in_rows(rows, codes, len(words), *_hashed(words))
            ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(batch)))))
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(terms, pa.int32())
            )
            yield pa.RecordBatch.from_arrays([lists, batch.column(1)], ["terms", "toxic"])

    schema = "terms array<int>, toxic int"
    got = sample.select("text", "toxic").mapInArrow(features, schema).toArrow()
    toxic = got["toxic"].to_numpy().astype(np.float64)
    lists = got["terms"].combine_chunks()
    del got
    per = pc.list_value_length(lists).to_numpy()
    entries = lists.flatten().to_numpy()
    del lists
    terms, places, some = _numbered(entries)
    del entries
    rows = np.repeat(np.arange(len(toxic), dtype=np.int32), per)[some]
    del some
    pa.default_memory_pool().release_unused()
    weight = np.where(toxic == 1, 1 / max(share.get(1, 1), 1e-9), 1 / max(share.get(0, 1), 1e-9))
    return terms, rows, places, toxic, weight


def _numbered(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms that ``LEAST_TEXTS`` texts have, the place among them of each entry that is one, and
    which entries are. Entries are taken some at a time, since numpy widens what it counts."""
    texts = np.zeros(1 << SPACE_BITS, dtype=np.int32)
    for i in range(0, len(entries), _AT_ONCE):
        texts += np.bincount(entries[i : i + _AT_ONCE], minlength=len(texts)).astype(np.int32)
    terms = np.flatnonzero(texts >= LEAST_TEXTS)
    place = np.full(len(texts), -1, dtype=np.int32)
    place[terms] = np.arange(len(terms), dtype=np.int32)
    places = place[entries]
    some = places >= 0
    return terms, places[some], some


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` as ``row`` (all columns, so that names cannot clash), ``score`` and ``predicted``.

    A null text is empty and scored as such. Every row gets a score; equal texts get equal ones.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            scores = shared.value.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array(scores >= 0.5).cast(pa.int32()),
                ],
                ["row", "score", "predicted"],
            )

    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    kind = docs.select(row).schema["row"].dataType.simpleString()
    return docs.select(row, docs["text"]).mapInArrow(
        mark, f"row {kind}, score double, predicted int"
    )


def without_toxic(docs: DataFrame, labels: DataFrame, learns: Column) -> DataFrame:
    """``docs`` without the rows that a machine trained on them rejects."""
    found = score(docs, train(docs, labels, learns))
    return found.filter("predicted = 0").select("row.*")
