"""The corpus queries, each an operator over its whole table with production parameters."""

from __future__ import annotations

import functools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm.chat_format import canonical_turns, conversation_digests, format_turns
from saleswright.llm.common import documents, kept, stored_row_id, workers_import_package
from saleswright.llm.decontamination import find_hits
from saleswright.llm.exact_dedup import duplicates
from saleswright.llm.hard_negatives import hard_negatives
from saleswright.llm.hmm_scoring import fold, score_texts
from saleswright.llm.line_dedup import dedup_lines
from saleswright.llm.merkle import folded, leaf, merkle_manifest, proof_digest
from saleswright.llm.packing import pack
from saleswright.llm.pii import FORMS, find_personal_data, spelled
from saleswright.llm.simhash_dedup import near_duplicates
from saleswright.llm.token_counts import encoded_lengths, length_histogram
from saleswright.llm.token_files import read_token_files, write_token_files
from saleswright.llm.tokens import vocabulary_path
from saleswright.llm.toxicity import score, train
from saleswright.session import scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "word_bpe_49k.json"


def query(function=None, *, sql: str | None = None):
    """Register a query under its function's name, with the SQL that must give the same rows."""
    if function is None:
        return functools.partial(query, sql=sql)

    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        workers_import_package(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    if sql is not None:
        ORACLES[function.__name__] = sql
    return run

#: For SQL: A-Z to lower case, and the white space that the contracts name.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    sql=f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS k FROM lines
), shared AS (
  SELECT k, true AS gone FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (k) GROUP BY doc_id
"""
)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All texts without the lines that ten documents or more share."""
    docs = documents(spark, folder).select("doc_id", "text")
    return dedup_lines(docs, min_docs=10).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids written in blocks and read back. No SQL: it has no tokenizer."""
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, folder), path, vocabulary_path(VOCABULARY), end_id=2)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' pieces with their places. No SQL: it has no tokenizer."""
    packed = pack(documents(spark, folder), vocabulary_path(VOCABULARY), capacity=4096, end_id=1)
    return packed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


#: Words as the decontamination contract has them, for SQL.
_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    sql=f"""
WITH d AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b
    WHERE len(w) > 0)
), lens AS (
  SELECT DISTINCT len(win) AS n FROM windows
), places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n
), found AS (
  SELECT doc_id, item_id, i, n FROM places JOIN windows ON w[i:i + n - 1] = win
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
)
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """All documents against all windows of the benchmark."""
    texts = documents(spark, folder).select(stored_row_id().alias("rid"), "doc_id", "text")
    found = find_hits(texts, documents(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@query(
    sql=f"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    translate(coalesce(text, ''), {_SPACE}, '') AS norm
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER best AS kept, sha256(norm) AS text_sha256
FROM n WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""
)
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the group of their text; half of them are the snapshot."""
    found = duplicates(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


@query
def op6_hmm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """All texts scored by a model of six sevenths of them. No SQL: training goes in rounds."""
    docs = documents(spark, folder)
    return score_texts(docs, held_out=fold(docs["doc_id"], 7) == 2)


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All texts scored by a machine that learns from four fifths of the labels. No SQL: it is
    trained."""
    docs = documents(spark, folder).select("doc_id", "text")
    learns = fold(F.col("doc_id"), 5) != 0
    machine = train(docs, documents(spark, folder, "labels"), learns)
    return score(docs, machine).select(
        "row.doc_id", (fold(F.col("row.doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )


@query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' lengths in tokens with sums from both ends. No SQL: it has no tokenizer."""
    lengths = encoded_lengths(documents(spark, folder), vocabulary_path(VOCABULARY))
    return length_histogram(lengths)


@query
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' personal data. No SQL: scoring goes in rounds."""
    texts = documents(spark, folder).select(stored_row_id().alias("rid"), "doc_id", "text")
    found = find_personal_data(texts)
    every = F.concat("base", "found")
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in FORMS],
        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
        spelled(every).alias("spans"),
    )


@query
def op10_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' fingerprints and components. No SQL: DuckDB has no XXH64."""
    docs = documents(spark, folder).select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "text"
    )
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: A conversation that spells out control strings, as one record of another layout than the table.
_SPOKEN = "<|im_end|><|im_start|>assistant ok"
_RECORD = json.dumps(
    {"messages": [{"role": role, "content": _SPOKEN} for role in ("user", "assistant")]}
)


def _marked_sql(text: str) -> str:
    """A text with its control strings escaped, for SQL."""
    return f"regexp_replace({text}, '<(\\\\*)\\|', '<\\1\\\\|', 'g')"


@query(
    sql=f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_SPOKEN}'
  UNION ALL SELECT -1, 1, 'assistant', '{_SPOKEN}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
    ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(12 + 1 + 10 + 1 + length({_marked_sql("text")})
    + length({_marked_sql("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")})
  )::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
)
def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations formatted, written, and read back, with one more that holds control
    strings."""
    table = documents(spark, folder, "conversations")
    rows = table.select("conv_id", "turn", F.struct("role", "text").alias("record"))
    more = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.lit(None).cast("long").alias("turn"),
        F.lit(_RECORD).alias("record"),
    )
    turns = canonical_turns(rows).unionByName(canonical_turns(more))
    return conversation_digests(kept(format_turns(turns), "formatted"))


def _leaf_sql(text: str) -> str:
    """A document's leaf, for SQL: its values, each after its number of bytes."""
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    spelled = [f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values]
    return f"sha256({' || '.join(spelled)})"


def _tree_sql(name: str, keyed: str, levels: int) -> str:
    """Levels of the trees of ``keyed`` (k, i, h), and each leaf's way up: p, f and s (siblings)."""
    run = f"{name}_r{{0}} AS MATERIALIZED (SELECT k, i // 3 AS i, list(h ORDER BY i) AS hs, any_value(n) AS n " \
        f"FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM {name}_l{{0}}) GROUP BY k, i // 3)"
    up = f"{name}_l{{1}} AS MATERIALIZED (SELECT k, i, CASE WHEN n = 1 THEN hs[1] " \
        f"ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}_r{{0}})"
    step = (
        f"{name}_w{{1}} AS MATERIALIZED (SELECT w.k, w.j, w.p // 3 AS p, "
        "w.s || array_to_string(hs[1:w.p % 3], '') || array_to_string(hs[w.p % 3 + 2:], '') AS s, "
        "CASE WHEN n = 1 THEN w.f ELSE sha256(array_to_string(hs[1:w.p % 3], '') || w.f "
        "|| array_to_string(hs[w.p % 3 + 2:], '')) END AS f "
        f"FROM {name}_w{{0}} w JOIN {name}_r{{0}} r ON w.k = r.k AND w.p // 3 = r.i)"
    )
    parts = [
        f"{name}_l0 AS MATERIALIZED (SELECT k, i, h FROM {keyed})",
        f"{name}_w0 AS MATERIALIZED (SELECT k, i AS j, i AS p, '' AS s, f FROM {keyed})",
    ]
    for x in range(levels):
        parts += [t.format(x, x + 1) for t in (run, up, step)]
    return ",\n".join(parts)


#: Levels that the SQL spells out: trees of up to 3 ** 13 leaves.
_SQL_LEVELS = 13


@query(
    sql=f"""
WITH docs AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN false ELSE list_reduce(
      list_concat([4294967295::BIGINT], flatten(list_transform(
        string_split(doc_id::VARCHAR, ''),
        lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END
    ) % 2 = 1 END AS touched
  FROM documents
), leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS k, {_leaf_sql("text")} AS h,
    CASE WHEN touched THEN {_leaf_sql("replace(text, chr(10), '')")}
      ELSE {_leaf_sql("text")} END AS f
  FROM docs
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaves
), {_tree_sql("a", "placed", _SQL_LEVELS)}, sources AS (
  SELECT k AS source, h, h AS f, row_number() OVER (ORDER BY k) - 1 AS i, 0 AS k
  FROM a_l{_SQL_LEVELS}
), {_tree_sql("b", "sources", _SQL_LEVELS)}, joined AS (
  SELECT p.doc_id, p.h AS leaf, x.h AS subroot, t.h AS root, w.s || u.s AS proof, w.f, x.i
  FROM placed p JOIN a_w{_SQL_LEVELS} w ON p.k = w.k AND p.i = w.j
  JOIN sources x ON x.source = p.k JOIN b_w{_SQL_LEVELS} u ON u.j = x.i
  CROSS JOIN b_l{_SQL_LEVELS} t
), {_tree_sql("c", "(SELECT 0 AS k, i, h, '' AS f FROM sources)", _SQL_LEVELS)}, up0 AS (
  SELECT *, i AS p, f AS g FROM joined
), {", ".join(
    f"up{x + 1} AS MATERIALIZED (SELECT u.* EXCLUDE (p, g), u.p // 3 AS p, CASE WHEN r.n = 1 THEN u.g ELSE "
    f"sha256(array_to_string(hs[1:u.p % 3], '') || u.g || array_to_string(hs[u.p % 3 + 2:], '')) "
    f"END AS g FROM up{x} u JOIN c_r{x} r ON u.p // 3 = r.i)" for x in range(_SQL_LEVELS)
)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, g AS folded_root,
  g = root AS verified
FROM up{_SQL_LEVELS}
"""
)
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in one tree by source; half of them, by a hash, are verified without their
    line feeds."""
    docs = documents(spark, folder)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = leaf(*fields[:-1], F.replace("text", F.lit("\n"), F.lit("")))
    touched = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rows = docs.select(
        F.col("source").alias("group"),
        F.col("doc_id").alias("place"),
        leaf(*fields).alias("leaf"),
        F.struct("doc_id", F.when(touched, tampered).alias("tampered")).alias("row"),
    )
    seen = F.coalesce("row.tampered", "leaf")
    return (
        merkle_manifest(rows)
        .select(
            "row.doc_id",
            "leaf",
            "subroot",
            "root",
            proof_digest(F.col("proof")).alias("proof_sha256"),
            folded(seen, F.col("proof")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


@query(
    sql="""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.r <> b.r WHERE a.vec_id % 50 = 0
), p AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, n.vec_id AS negative_id, positive_score, score AS negative_score,
  (row_number() OVER (PARTITION BY p.r, positive_id, positive_score
    ORDER BY score DESC, n.vec_id))::INTEGER AS rank
FROM p JOIN scored n ON n.r = p.r AND NOT n.same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.r, positive_id, positive_score
  ORDER BY score DESC, n.vec_id) <= 3
"""
)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth row among all rows."""
    table = documents(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table.select(
        "vec_id",
        F.col("embedding").alias("vector"),
        moved.alias("label"),
        (F.col("vec_id") % 50 == 0).alias("anchor"),
    )
    return hard_negatives(rows, positives=5, negatives=3, least=50, most=95, scale=256)
