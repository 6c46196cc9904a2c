"""Mixing sources to target weights, in fixed-length blocks of words.

Each source's documents, in the order of a hash bucket and then id, form one stream of words that
is cut into blocks of ``block_words``.  The mix is a list of slots; every output shard draws how
many of its slots each source gets from a multinomial over what the sources still lack, never
more than that, so over all shards each source gets its target.  A source's slots are mapped to
its blocks by pseudorandom permutations of the block index, one per pass over the source, and
joined to the blocks by index.  With at most ``max_passes`` passes no word is taken more often.

Targets: sources by code point (null last) weigh ``weights``, repeating, and share ``share`` times
all words; a target stops at ``max_passes`` times the source's words and the excess is shared
again by weight among the others.

Defined cases: null, empty and blank texts have size 0 and are never taken; repeated rows are
separate documents, ordered by a hash of the whole row where the ids and sizes are equal; null ids come
first; an empty table gives an empty mix; source null is a source of its own; an extra column named like
one that the mix adds gives way to it in ``mix`` and stays in ``mixed_documents``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import mix64, slices, texts, written

SHARD_WORDS = BUCKET_WORDS = 1 << 24  # about so many words each, beyond the least numbers of shards and buckets
LEAST_SHARDS, LEAST_BUCKETS = 256, 1024
_OWN = ("source_size", "target", "taken")
MAX_SOURCES = 100_000  # sources are a list of a mixture's parts; more is an error, not a cut
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def with_size(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` and the number of words of its text."""

    def run(batches):
        for b in slices(batches, text, 16 << 20):
            n = pa.array([len(t.split()) for t in texts(b, text)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, n], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def targets(sizes: list[int], weights: tuple[float, ...], share: float, max_passes: int) -> list[float]:
    """Words for each source, in the sources' order."""
    w = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = share * sum(sizes)
    while open_:
        total = sum(w[i] for i in sorted(open_))
        over = [i for i in sorted(open_) if left * w[i] / total > max_passes * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * w[i] / total
            break
        for i in over:
            out[i] = float(max_passes * sizes[i])
        left -= sum(out[i] for i in over)
        open_ -= set(over)
    return out


def permuted(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at i: Feistel rounds, walked until inside the range."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x = i.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for r in range(4):
            left, right = right, left ^ (mix64(right + np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 % 2**64)) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo[todo] = x[todo] >= np.uint64(n)
    return x.astype(np.int64)


def draws(quota: list[int], shards: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot of the source, slots): a multinomial per shard over the remaining quotas."""
    rng, left, out = np.random.default_rng(seed), np.array(quota, np.int64), []
    used = np.zeros(len(quota), np.int64)
    for shard in range(shards):
        need = int(left.sum()) // (shards - shard)
        got = np.zeros(len(quota), np.int64)
        while need:
            open_ = left - got
            more = np.minimum(rng.multinomial(need, open_ / open_.sum()), open_)
            got += more
            need -= int(more.sum())
        out += [(shard, int(s), int(used[s]), int(got[s])) for s in np.flatnonzero(got)]
        used, left = used + got, left - got
    return out


class Mix:
    """``documents``: id, source, size, source_size, target and place of every row; ``pieces``: what the
    mix takes, (shard, slot_key, source_no, pass, doc_key, first word, words), a row per block and document."""

    def __init__(self, documents: DataFrame, pieces: DataFrame):
        self.documents, self.pieces = documents, pieces


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", size: str = "size", weights: tuple[float, ...] = (5, 2, 1),
        share: float = 1.5, max_passes: int = 2, block_words: int = 64, shards: int | None = None, buckets: int | None = None, seed: int = 17,
        tie: str | None = None) -> Mix:
    """``docs`` needs a BIGINT ``size`` (see ``with_size``); other columns stay in ``documents``.
    Each document's place is (``_mix_source``, ``_mix_at``), its first word in its source's stream.
    ``tie`` orders documents of equal id and size (default: a hash of the row).  Shards and buckets grow with the words."""
    spark = docs.sparkSession
    docs = docs.drop(*(c for c in docs.columns if c in _OWN and c not in (id_col, source, size)))
    per = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("n"))
    rows = per.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["source"] is None, str(r["source"]).encode()))
    sizes = [int(r["n"]) for r in rows]
    goal = targets(sizes, weights, share, max_passes)
    blocks = [-(-n // block_words) for n in sizes]
    quota = [min(max_passes * b, round(b * t / n)) if n else 0 for b, t, n in zip(blocks, goal, sizes, strict=True)]
    shards = shards or max(LEAST_SHARDS, -(-round(sum(goal)) // SHARD_WORDS))
    buckets = buckets or max(LEAST_BUCKETS, -(-max(sizes, default=0) // BUCKET_WORDS))
    kind = docs.schema[source].dataType.simpleString()
    listed = [(r["source"], i, n, t) for i, (r, n, t) in enumerate(zip(rows, sizes, goal, strict=True))]
    known = spark.createDataFrame(listed, f"_mix_name {kind}, _mix_source int, source_size long, target double")

    placed = docs.withColumn("_mix_bucket", F.expr(f"CAST(pmod(xxhash64({id_col}), {buckets}) AS INT)"))
    placed = placed.join(F.broadcast(known), placed[source].eqNullSafe(known["_mix_name"])).drop("_mix_name")
    sums = placed.groupBy("_mix_source", "_mix_bucket").agg(F.sum(size).alias("n"))
    before = Window.partitionBy("_mix_source").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_mix_source", "_mix_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mix_start"))
    order = [F.col(id_col).asc_nulls_first(), F.col(size), F.col(tie) if tie else F.xxhash64(*docs.columns)]
    inside = Window.partitionBy("_mix_source", "_mix_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_mix_before", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    placed = placed.join(starts, ["_mix_source", "_mix_bucket"])
    placed = written(placed.withColumn("_mix_at", F.col("_mix_start") + F.col("_mix_before")).drop("_mix_start", "_mix_before", "_mix_bucket"))

    drawn = [(s, i, first, n, blocks[i]) for s, i, first, n in draws(quota, shards, seed)]  # shards x sources rows at most
    runs = spark.createDataFrame(drawn, "shard int, source_no int, first long, n long, blocks long")
    runs = runs.withColumn("x", F.expr("explode(sequence(0L, n - 1, 16384L))"))
    runs = runs.select("shard", "source_no", F.expr("first + x AS first"), F.expr("least(16384L, n - x) AS n"), "blocks")

    def slots(batches):
        for b in batches:
            for s, i, first, n, total in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                j = np.arange(first, first + n)
                turn, out = j // total, np.empty(n, np.int64)
                for e in np.unique(turn).tolist():
                    out[turn == e] = permuted(j[turn == e] % total, total, seed * 1_000_003 + i * 101 + e)
                key = mix64(j.astype(np.uint64) + np.uint64(i << 40)).view(np.int64)
                cols = [np.full(n, s, np.int32), key, np.full(n, i, np.int32), turn.astype(np.int32), out]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), ["shard", "slot_key", "source_no", "pass", "block"])

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(quota) // 1_000_000))  # given, or Spark would merge them
    slot = runs.repartition(tasks, "shard", "first").mapInArrow(slots, "shard int, slot_key long, source_no int, pass int, block long")
    held = placed.where(F.col(size) > 0).select("_mix_source", "_mix_at", F.col(size).alias("words"))
    held = held.withColumn("block", F.expr(f"explode(sequence(_mix_at DIV {block_words}, (_mix_at + words - 1) DIV {block_words}))"))
    low, high = F.expr(f"greatest(_mix_at, block * {block_words})"), F.expr(f"least(_mix_at + words, (block + 1) * {block_words})")
    held = held.select(F.col("_mix_source").alias("source_no"), "block", "_mix_at", (low - F.col("_mix_at")).alias("first_word"), (high - low).alias("n_words"))
    # Both sides grow with the words, and Spark cannot size either: never a broadcast.
    return Mix(placed, slot.join(held.hint("merge"), ["source_no", "block"]))


def taken_words(m: Mix, size: str = "size") -> DataFrame:
    """``m.documents`` and ``taken``: the words that the mix takes of each, repeats counted."""
    got = m.pieces.groupBy("source_no", "_mix_at").agg(F.sum("n_words").alias("_mix_taken"))
    got = got.withColumnsRenamed({"source_no": "_mix_source"})
    key = F.when(F.col(size) > 0, F.col("_mix_at"))  # a document without words shares its place with the next
    d = m.documents.withColumn("_mix_key", key)
    got = got.withColumnRenamed("_mix_at", "_mix_key")
    joined = d.join(got, ["_mix_source", "_mix_key"], "left")
    return joined.withColumn("taken", F.coalesce("_mix_taken", F.lit(0).cast("long"))).drop("_mix_key", "_mix_taken")


def mixed_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row per document and pass with the words taken of it
    (a fully taken document keeps its text as it is; else its taken stretches, joined by newlines)."""
    spare = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}
    own = docs.withColumnsRenamed(spare).schema
    sized = with_size(docs.withColumnsRenamed(spare), spare[text], "_mix_size").withColumn("_mix_row", F.monotonically_increasing_id())
    sized = written(sized.withColumn("_mix_tie", F.xxhash64(*own.names)))
    # Texts are not ordered or numbered: they are met again by row, once what to take of them is known.
    narrow = sized.select("_mix_row", F.col(spare[id_col]).alias("id"), F.col(spare[source]).alias("source"), "_mix_size", "_mix_tie")
    m = mix(narrow, "id", "source", "_mix_size", tie="_mix_tie", **options)
    ranges = m.pieces.groupBy("source_no", "_mix_at", "pass").agg(
        F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("_mix_ranges")
    )  # bounded by one document's words
    d = m.documents.where("_mix_size > 0").select("_mix_source", "_mix_at", "_mix_row")
    ranges = d.join(ranges.withColumnsRenamed({"source_no": "_mix_source"}), ["_mix_source", "_mix_at"]).select("_mix_row", "_mix_ranges")
    got = sized.join(ranges.hint("merge"), "_mix_row").select(*own.names, "_mix_size", "_mix_ranges")

    def cut(batches):
        col = own.names.index(spare[text])
        for b in slices(batches, spare[text], 16 << 20):
            out = []
            for t, n, ranges_ in zip(b.column(spare[text]).to_pylist(), b.column("_mix_size").to_pylist(), b.column("_mix_ranges").to_pylist(), strict=True):
                runs: list[list[int]] = []
                for r in ranges_:
                    if runs and runs[-1][1] == r["first_word"]:
                        runs[-1][1] += r["n_words"]
                    else:
                        runs.append([r["first_word"], r["first_word"] + r["n_words"]])
                if runs != [[0, n]]:
                    at = [x.span() for x in _WORD.finditer(t)]
                    t = "\n".join(t[at[a][0] : at[z - 1][1]] for a, z in runs)
                out.append(t)
            cols = [*b.columns[:col], pa.array(out, b.schema.types[col]), *b.columns[col + 1 : len(own)]]
            yield pa.RecordBatch.from_arrays(cols, own.names)

    return got.mapInArrow(cut, own).withColumnsRenamed({v: k for k, v in spare.items()})
