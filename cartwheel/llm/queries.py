"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from cartwheel.llm import chat, katz, lines, minhash, mixing, personal, phrases, quality, repair, simhash, substrings, tokenfile, winnow
from cartwheel.llm.common import shared_dir, table, written


END_ID = 2


def op1_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return tokenfile.read_tokens(spark, path, digest=True)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.drop_repeated_substrings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def op4_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered_turns(table(spark, sf_dir, "conversations"))


def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = quality.judged(docs, table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return d.select("doc_id", *(F.col(quality.P + n).alias(n) for n in names))


def op10_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda c: F.expr(f"array_join(transform({c}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
    return found.select("doc_id", *map(count, personal.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.find_repeated_lines(table(spark, sf_dir, "documents"))
    removed = F.sha2(F.array_join("removed", ","), 256).alias("removed_sha256")
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), removed, "n_links", "class_id")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(winnow.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def contamination_digest(found: DataFrame) -> DataFrame:
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = written(mixing.with_size(docs, "text", "size").drop("text"))
    return mixing.taken_words(mixing.mix(sized)).select("doc_id", "size", "source_size", "target", "taken")


def op11_tensored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_hirschberg(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    found = repair.repair(repair.damaged(conv)).withColumnRenamed("conv_id", "found_id")
    ids = conv.select("conv_id").distinct()  # a conversation may lose all its turns
    d = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    numbers = (F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return d.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simple8b": op1_simple8b,
    "op2_mixing": op2_mixing,
    "op3_katz": op3_katz,
    "op4_snapshots": op4_snapshots,
    "op5_simhash": op5_simhash,
    "op6_substrings": op6_substrings,
    "op7_decision_list": op7_decision_list,
    "op8_segments": op8_segments,
    "op9_winnowing": op9_winnowing,
    "op10_skip_chain": op10_skip_chain,
    "op11_tensored": op11_tensored,
    "op12_hirschberg": op12_hirschberg,
    "op13_collocations": op13_collocations,
}

# Conversations compared turn by turn as lists: the prefix definition itself.
OP4_SQL = """
WITH turns AS (
    SELECT conv_id, turn, role, text, count(*) AS copies FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL),
convs AS (
    SELECT conv_id, count(*) AS n, max(turn) AS last, list({'t': turn, 'r': role, 'x': text, 'c': copies} ORDER BY turn, role, text) AS log
    FROM turns GROUP BY conv_id),
kept AS (
    SELECT a.conv_id FROM convs a WHERE NOT EXISTS (
        SELECT 1 FROM convs b WHERE b.conv_id <> a.conv_id AND b.n >= a.n AND b.log[1:a.n] = a.log
        AND (CASE WHEN b.n = a.n THEN b.conv_id < a.conv_id ELSE b.log[a.n + 1].t > a.last END)))
SELECT conv_id, turn, copies,
       repeat('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), CAST(copies AS INT)) AS rendered
FROM turns WHERE conv_id IN (SELECT conv_id FROM kept)
"""

# All pairs of documents that share a shingle.
OP11_SQL = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
s AS (
    SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])) END AS x FROM d),
p AS (SELECT r, len(x) AS n, unnest(x) AS g FROM s),
pairs AS (SELECT a.r AS a, b.r AS b, a.n + b.n AS n, count(*) AS c FROM p a JOIN p b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 85 * (n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r, r AS m FROM s UNION SELECT reach.r, b FROM reach JOIN both_ways ON m = a),
least AS (SELECT reach.r, min(s.doc_id) AS component_id FROM reach JOIN s ON s.r = m GROUP BY reach.r)
SELECT doc_id, CAST(len(x) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM s JOIN least USING (r)
"""

# Every stretch of one to five words, counted.
OP13_SQL = r"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM docs),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i : i + m - 1])) AS p FROM pieces, (SELECT unnest(range(1, 6)) AS m)),
f AS (SELECT lang, m, p, count(*) AS c FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(c) AS n FROM f WHERE m = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE c >= 100),
cuts AS (
    SELECT s.lang, s.m, s.p, s.c AS a, k, x.c AS l, y.c AS r, CAST(t.n AS BIGINT) AS n,
           CAST(1000::HUGEINT * s.c * t.n // (x.c::HUGEINT * y.c) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM often WHERE m > 1) s
    JOIN often x ON x.lang = s.lang AND x.p = s.p[1 : k] JOIN often y ON y.lang = s.lang AND y.p = s.p[k + 1 : s.m] JOIN totals t ON t.lang = s.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
parts AS (
    SELECT lang, c, p[i : i + q - 1] AS p FROM (SELECT *, unnest(range(1, m - q + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS q FROM often WHERE m > 2))),
inside AS (SELECT lang, p, max(c) AS most FROM parts GROUP BY ALL),
kept AS (
    SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, l, r, n, score FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.p = b.p
    WHERE most IS NULL OR 100 * most < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""

# Unsigned crc32, quality verdicts, hashes and tokens are beyond DuckDB's SQL: see tests/llm.
ORACLE_SQL: dict[str, str] = {"op4_snapshots": OP4_SQL, "op11_tensored": OP11_SQL, "op13_collocations": OP13_SQL}
