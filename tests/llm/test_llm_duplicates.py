"""Line dedup, exact dedup and near-dedup against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_helpers import ODD, texts_of
from saleswright.llm import exact_dedup, line_dedup
from saleswright.llm.common import kept
from saleswright.llm.exact_dedup import FuseFilter, duplicates, without_duplicates
from saleswright.llm.line_dedup import SeenTwice, dedup_lines
from saleswright.llm.simhash_dedup import (
    components,
    fingerprint,
    links,
    near_duplicates,
    numbered,
    without_near_duplicates,
)

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- lines ----------------------------------------------------------------------------


def key(line):
    return line.strip(SPACE).translate(LOWER)


def lines_by_hand(texts, min_docs, min_chars=1):
    seen = Counter(k for _, t in texts for k in {key(x) for x in t.split("\n")})
    drop = {k for k, n in seen.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for doc_id, text in texts:
        lines = text.split("\n")
        left = [x for x in lines if key(x) not in drop]
        out.append((doc_id, len(lines), len(lines) - len(left), "\n".join(left)))
    return Counter(out)


def lines_found(df):
    return Counter(tuple(r) for r in df.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect())


@pytest.mark.parametrize("room", [line_dedup.BROADCAST_BYTES, 0])
def test_lines_of_odd_rows(odd, monkeypatch, room):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", room)
    for min_docs, min_chars in ((2, 1), (4, 1), (3, 12), (2, 0)):
        found = dedup_lines(odd, min_docs, min_chars)
        assert lines_found(found) == lines_by_hand(texts_of(odd), min_docs, min_chars)
    assert "RID" in found.schema["row"].dataType.names


@pytest.mark.parametrize("room", [line_dedup.BROADCAST_BYTES, 0])
def test_lines_of_many_rows(spark, monkeypatch, room):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", room)
    rnd = random.Random(5)
    texts = [
        (i, "\n".join(rnd.choice("abcdefghij") * rnd.randint(0, 6) for _ in range(rnd.randint(1, 9))))
        for i in range(400)
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    assert lines_found(dedup_lines(docs, 10)) == lines_by_hand(texts, 10)


def test_first_occurrence_stays(spark):
    texts = [(2, "x\nA\na"), (1, "b\n a \nA"), (3, "a\nc"), (None, "b")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = dict(dedup_lines(docs, 2, keep="first").select("row.doc_id", "kept_text").collect())
    assert got == {None: "b", 1: " a ", 2: "x", 3: "c"}


def test_lines_of_no_rows(no_rows):
    assert dedup_lines(no_rows, 10).count() == 0
    with pytest.raises(ValueError):
        dedup_lines(no_rows, 1)


def test_merged_filters_have_all_that_two_tasks_saw():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, (2, 500), dtype=np.uint64)
    b[:50] = a[:50]
    pairs = [SeenTwice(1 << 10) for _ in range(2)]
    for pair, some in zip(pairs, (a, b), strict=True):
        pair.add(some)
    pairs[0].merge(slice(None), pairs[1].once, pairs[1].twice)
    word, mask = line_dedup._bits(a, 1 << 10)
    found = (pairs[0].twice[word] & mask) == mask
    assert found[:50].all() and found[50:].mean() < 0.05


# --- equal texts ----------------------------------------------------------------------


def norm(text):
    return "".join(c for c in text if c not in SPACE)


def groups_by_hand(texts):
    groups = defaultdict(list)
    for doc_id, text in texts:
        groups[norm(text)].append((-len(text), doc_id is None, doc_id or 0))
    return {k: (min(v), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("batch", [None, "0", "1", "cast(null as int)"])
def test_equal_texts_of_odd_rows(odd, batch):
    rows = duplicates(odd, batch and F.expr(batch)).select("row.*", "keep_id", "group_size", F.col("kept").alias("stays"))
    assert rows.columns[: len(odd.columns)] == odd.columns
    groups = groups_by_hand(texts_of(odd))
    stays = Counter()
    for r in rows.collect():
        best, size = groups[norm(r["text"] or "")]
        assert (r["keep_id"], r["group_size"]) == (None if best[1] else best[2], size)
        if r["stays"]:
            assert -len(r["text"] or "") == best[0]
            stays[norm(r["text"] or "")] += 1
    assert set(stays) == set(groups) and set(stays.values()) == {1}


def test_without_equal_texts(odd, no_rows):
    left = without_duplicates(odd)
    assert left.columns == odd.columns
    assert left.count() == len({norm(t or "") for _, t in ODD})
    assert without_duplicates(no_rows).count() == 0


def test_texts_of_one_digest_stay_apart(odd, monkeypatch):
    """The bytes decide: with one 64-bit digest for all texts the groups are the same."""
    wanted = sorted(map(str, duplicates(odd).select("doc_id", "sha", "keep_id", "group_size").collect()))
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *_: F.lit(8).cast("long"))
    batch = F.coalesce(F.col("doc_id") % 2, F.lit(0))
    got = duplicates(odd, batch).select("doc_id", "sha", "keep_id", "group_size").collect()
    assert sorted(map(str, got)) == wanted


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 60_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**64 - 1, n, dtype=np.uint64)
    fuse = FuseFilter.of(keys)
    assert fuse.contains(keys).all()
    others = rng.integers(0, 2**64 - 1, 20_000, dtype=np.uint64)
    assert fuse.contains(others).mean() < 0.01
    assert n < 10_000 or len(fuse.prints) < 1.35 * n


# --- near texts -----------------------------------------------------------------------


def fingerprint_by_hand(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    votes = [sum(xxhash.xxh64_intdigest(s, 42) >> k & 1 for s in shingles) for k in range(64)]
    return sum(1 << k for k in range(64) if 2 * votes[k] > len(shingles))


def components_by_hand(fps, bits):
    f = np.array(fps, dtype=np.uint64)
    parent = list(range(len(f)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= bits) + i + 1:
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(f))]


def near_by_hand(texts, bits=4):
    fps = [fingerprint_by_hand(t) for _, t in texts]
    roots = components_by_hand(fps, bits)
    least = defaultdict(list)
    for (doc_id, _), r in zip(texts, roots, strict=True):
        least[r] += [] if doc_id is None else [doc_id]
    named = [min(least[r], default=None) for r in roots]
    return Counter((i, f, c) for (i, _), f, c in zip(texts, fps, named, strict=True)), len(set(roots))


def test_near_texts_of_odd_rows(odd, no_rows):
    wanted, n = near_by_hand(texts_of(odd))
    rows = near_duplicates(numbered(odd).select("rid", "row.doc_id", "row.text")).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in rows) == wanted
    assert sum(r["kept"] for r in rows) == n
    left = without_near_duplicates(odd)
    assert left.columns == odd.columns and left.count() == n
    assert without_near_duplicates(no_rows).count() == 0


def test_near_texts_of_the_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    wanted, n = near_by_hand(texts_of(docs))
    rows = near_duplicates(numbered(docs).select("rid", "row.doc_id", "row.text")).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in rows) == wanted


def test_fingerprint_of_many_words():
    text = " ".join(f"W{i % 700}" for i in range(3000))
    assert fingerprint(text.encode().lower().split()) == fingerprint_by_hand(text)


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_links_join_all_that_are_near(spark, bits):
    """Dense clouds, chains and far points."""
    rnd = random.Random(bits)
    fps = {0, 2**64 - 1}
    base = rnd.getrandbits(64)
    for _ in range(900):
        x = rnd.choice([base, rnd.choice(sorted(fps)), rnd.getrandbits(64)])
        for _ in range(rnd.randint(1, 7)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    table = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in fps], "fp long")
    pairs = kept(links(table, bits), "pairs")
    assert all(bin((r["a"] ^ r["b"]) % 2**64).count("1") <= bits for r in pairs.collect())
    label = {r["node"] % 2**64: r["label"] for r in components(pairs).collect()}
    by_hand, found = defaultdict(set), defaultdict(set)
    for x, r in zip(fps, components_by_hand(fps, bits), strict=True):
        by_hand[r].add(x)
        found[label.get(x, ("own", x))].add(x)
    assert sorted(map(sorted, by_hand.values())) == sorted(map(sorted, found.values()))


def test_a_long_chain_is_one_component(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    rows = components(pairs).collect()
    assert len(rows) == 301 and {r["label"] for r in rows} == {0}
