"""The Merkle manifest against a tree built by hand."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from saleswright.llm import merkle
from saleswright.llm.merkle import folded, leaf, merkle_manifest, proof_digest
from saleswright.llm.queries import QUERIES


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        levels.append(nodes)
    return levels


def siblings(levels, i):
    found = []
    for level in levels[:-1]:
        run = i // 3 * 3
        found.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        i //= 3
    return found


def fold(node, proof):
    for left, right in proof:
        node = h(left, node, right)
    return node


def spelled(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def documents_by_hand(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of documents as tuples of five."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        made = [(r, h(*map(spelled, r))) for r in groups[s]]
        groups[s] = sorted(made, key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = tree([x[1] for x in groups[s]])
    top = tree([trees[s][-1][0] for s in names])
    found = Counter()
    for k, s in enumerate(names):
        for i, (r, own) in enumerate(groups[s]):
            proof = siblings(trees[s], i) + siblings(top, k)
            seen = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = r[4] if r[4] is None else r[4].replace("\n", "")
                seen = h(*map(spelled, (*r[:4], text)))
            digest = h("".join(a + b for a, b in proof))
            root = top[-1][0]
            found[(r[0], own, trees[s][-1][0], root, digest, fold(seen, proof), fold(seen, proof) == root)] += 1
    return found


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_all_sizes(spark, monkeypatch, levels):
    """Groups of 1 to 100 leaves over blocks of 3, 9 and 729."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "é": 9, "f": 10, "g": 28, "h": 100, None: 82, "": 27, "=": 5}
    rows = [(g, i, h(str(g), str(i))) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "group string, place long, leaf string")
    df = df.withColumn("row", F.struct("group", "place")).repartition(5)
    proof = F.col("proof")
    got = merkle_manifest(df).select(
        "*", folded(F.col("leaf"), proof).alias("up"), proof_digest(proof).alias("p")
    ).collect()
    assert len(got) == len(rows)
    names = sorted(sizes, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in rows if x[0] == g]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    for r in got:
        own = trees[r["row"]["group"]]
        wanted = siblings(own, r["row"]["place"]) + siblings(top, names.index(r["row"]["group"]))
        assert [tuple(x) for x in r["proof"]] == wanted
        assert (r["subroot"], r["root"], r["up"]) == (own[-1][0], top[-1][0], top[-1][0])
        assert r["leaf"] == own[0][r["row"]["place"]] and r["p"] == h(*map("".join, wanted))


DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, key string"


def write(spark, tmp_path, rows, schema=DOCS):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return QUERIES["op12_merkle_manifest"](spark, str(tmp_path))


def test_odd_rows(spark, tmp_path):
    """Nulls everywhere, repeated rows and doc_ids, long texts, clashing names."""
    rows = [(i, "ab"[i % 2], "en", i, f"line {i}\nnext\n") for i in range(20)]
    rows += [(5, "a", None, None, None), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(7, "", "", 0, ""), (7, "a", "x", -3, "é\n" * 200_000), (8, "a", "en", 8, "line 8\nnext\n")]
    df = write(spark, tmp_path, [(*r, "L", "K") for r in rows])
    assert Counter(map(tuple, df.collect())) == documents_by_hand(rows)


def test_lone_leaf_and_no_rows(spark, tmp_path):
    (r,) = write(spark, tmp_path / "one", [(2, "s", "l", 1, "x", "", "")]).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] == h("1:2", "1:s", "1:l", "1:1", "1:x")
    assert r["verified"] and r["proof_sha256"] == h()
    assert write(spark, tmp_path / "none", []).count() == 0


def test_any_change_is_found(spark):
    rows = spark.range(300).selectExpr(
        "concat('s', id % 4) AS group", "id AS place", "cast(id AS string) AS text"
    )
    rows = rows.select("group", "place", leaf(F.col("text")).alias("leaf"), F.struct("text").alias("row"))
    found = merkle_manifest(rows).select(
        (folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("same"),
        (folded(leaf(F.concat("row.text", F.lit("x"))), F.col("proof")) == F.col("root")).alias("other"),
    )
    assert found.groupBy("same", "other").count().collect() == [(True, False, 300)]


def test_query_on_the_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    result = QUERIES["op12_merkle_manifest"](spark, data).collect()
    assert Counter(map(tuple, result)) == documents_by_hand(rows)
    assert {r["verified"] for r in result} == {True, False}


def test_a_hot_group_is_spread(spark, monkeypatch):
    """Two thirds of the rows in one group, all alike: no block holds more than its share."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 3)
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, concat('s', id % 50), 'hot') AS group", "if(id % 3 = 0, id, 1) AS place"
    )
    rows = rows.select("group", "place", leaf(F.col("place")).alias("leaf"), F.struct("place").alias("row"))
    seen = []

    def watch(df, label, *by):
        out = kept(df, label, *by)
        if label == "tree-blocks":
            seen.append(out.agg(F.max(F.size("nodes")).alias("n")).first()["n"])
        return out

    kept = merkle.kept
    monkeypatch.setattr(merkle, "kept", watch)
    found = merkle_manifest(rows)
    assert found.filter(folded(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 3000
    assert max(seen) <= 27
