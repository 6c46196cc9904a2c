"""SimHash near-duplicates: fingerprints linked by a binary-trie self-join.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a fingerprint bit is 1 if
it is set in over half of the XXH64 hashes (seed 42) of all k-word shingles, repeats included.

The self-join works on the *distinct* fingerprints, so a group of exact copies is one node.  The
trie of all fingerprints is dealt out by its top ``b`` levels: a cell is one subtree, and a task
is a pair of cells whose prefixes differ in at most the allowed bits.  A crowded cell is split
into sub-tries by hash and its pairs run as blocks.  In a task both sub-tries are descended
together, bit by bit; a node pair carries the differing bits so far and is dropped once they
exceed the budget.  A task returns a spanning forest of its links, never all pairs.

Defined cases: null or blank text has fingerprint 0, linked like any other; a null ``doc_id`` is
never the smallest of a component; repeated rows are copies; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import components, slices, texts, written

FP = "_simhash_fp"
MAX_CELL_BITS = 14


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        parts = zip(*(words[i:] for i in range(shingle)), strict=False)
        digest = xxhash.xxh64_intdigest
        hashes = [digest(s, 42) for s in map(b" ".join, parts)]
    bits, n = np.zeros(64, np.int64), len(hashes)
    for at in range(0, n, 8192):
        h = np.array(hashes[at : at + 8192], dtype="<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` and its fingerprint as BIGINT column ``_simhash_fp``."""
    schema = T.StructType([*docs.schema.fields, T.StructField(FP, T.LongType())])

    def run(batches):
        for b in slices(batches, text, 16 << 20):
            fp = np.array([fingerprint(t, shingle) for t in texts(b, text)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], [*b.schema.names, FP])

    return docs.mapInArrow(run, schema)


def trie_pairs(a: np.ndarray, b: np.ndarray | None, max_bits: int):
    """Index pairs (i into a, j into b) at ``max_bits`` or fewer differing bits, in blocks.  ``a`` and
    ``b`` are sorted distinct uint64; b None joins a with itself (i < j)."""
    own, b = b is None, a if b is None else b
    zeros = lambda x, k: np.concatenate(([0], np.cumsum((x >> np.uint64(k)) & np.uint64(1) == 0)))
    start = np.array([[0], [len(a)], [0], [len(b)], [0]], np.int64)
    stack = [(63, start)] if len(a) and len(b) else []
    while stack:
        k, f = stack.pop()
        if f.shape[1] > 200_000:
            half = f.shape[1] // 2
            stack += [(k, f[:, :half]), (k, f[:, half:])]
            continue
        size = (f[1] - f[0]) * (f[3] - f[2])
        small = size <= 64
        if k < 0:
            small[:] = True
        if small.any():
            g, n = f[:, small], size[small]
            row = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            wide = (g[3] - g[2])[row]
            i, j = g[0][row] + at // wide, g[2][row] + at % wide
            hit = np.bitwise_count(a[i] ^ b[j]) <= max_bits
            if own:
                hit &= i < j
            if hit.any():
                yield i[hit], j[hit]
            f = f[:, ~small]
        if not f.shape[1]:
            continue
        za, zb = zeros(a, k), zeros(b, k)
        ma, mb = f[0] + za[f[1]] - za[f[0]], f[2] + zb[f[3]] - zb[f[2]]
        same = own & (f[0] == f[2]) & (f[1] == f[3])
        parts = [
            np.stack((f[0], ma, f[2], mb, f[4])),
            np.stack((ma, f[1], mb, f[3], f[4])),
            np.stack((f[0], ma, mb, f[3], f[4] + 1)),
            np.stack((ma, f[1], f[2], mb, f[4] + 1))[:, ~same],
        ]
        f = np.concatenate(parts, axis=1)
        f = f[:, (f[1] > f[0]) & (f[3] > f[2]) & (f[4] <= max_bits)]
        if f.shape[1]:
            stack.append((k - 1, f))


def forest(n: int, pairs) -> np.ndarray:
    """Smallest node of each node's component, for blocks of index pairs among n nodes."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            li, lj = label[i], label[j]
            if (li == lj).all():
                break
            low = np.minimum(li, lj)
            np.minimum.at(label, li, low)
            np.minimum.at(label, lj, low)
            while not (label == label[label]).all():
                label = label[label]
    return label


def links(fps: DataFrame, max_bits: int, cell_rows: int = 4096) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints linked at ``max_bits`` or fewer bits."""
    n = fps.count()
    bits = min(MAX_CELL_BITS, max(1, math.ceil(math.log2(max(2, n / cell_rows)))))
    cell = fps.select(F.col(FP).alias("fp"), F.shiftrightunsigned(FP, 64 - bits).cast("int").alias("cell"))
    subs = F.ceil(F.count("*") / (4 * cell_rows)).cast("int")
    cells = F.broadcast(cell.groupBy("cell").agg(subs.alias("subs")))  # at most 2 ** MAX_CELL_BITS rows
    masks = [sum(1 << i for i in c) for r in range(max_bits + 1) for c in combinations(range(bits), r)]
    placed = cell.join(cells, "cell").withColumn("sub", F.expr("CAST(pmod(xxhash64(fp), subs) AS INT)"))
    near = placed.select("fp", "cell", "sub", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    other = cells.select(F.col("cell").alias("cell2"), F.col("subs").alias("subs2"))
    near = near.withColumn("cell2", F.expr("cell ^ mask")).join(other, "cell2")
    near = near.withColumn("sub2", F.expr("explode(sequence(0, subs2 - 1))"))
    own, to = F.expr("CAST(cell AS BIGINT) << 32 | sub"), F.expr("CAST(cell2 AS BIGINT) << 32 | sub2")
    dealt = near.select("fp", F.least(own, to).alias("lo"), F.greatest(own, to).alias("hi"), (own <= to).alias("first"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().view(np.uint64)
        first = pdf["first"].to_numpy()
        if pdf["lo"].iat[0] == pdf["hi"].iat[0]:
            a = both = np.sort(fp)
            pairs = trie_pairs(a, None, max_bits)
        else:
            a, b = np.sort(fp[first]), np.sort(fp[~first])
            both = np.concatenate((a, b))
            pairs = ((i, j + len(a)) for i, j in trie_pairs(a, b, max_bits))
        label = forest(len(both), pairs)
        linked = np.flatnonzero(label != np.arange(len(both)))
        return pd.DataFrame({"a": both[linked].view(np.int64), "b": both[label[linked]].view(np.int64)})

    return dealt.groupBy("lo", "hi").applyInPandas(join, "a long, b long")


def fingerprint_components(docs_fp: DataFrame, id_col: str = "doc_id", max_bits: int = 2) -> DataFrame:
    """(``_simhash_fp``, component_id): the smallest id reachable from each distinct fingerprint."""
    fps = written(docs_fp.groupBy(FP).agg(F.min(id_col).alias("least")))
    roots = components(links(fps, max_bits), "a", "b")
    named = fps.join(roots, fps[FP] == roots["node"], "left")
    named = named.select(FP, "least", F.coalesce("root", FP).alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select(FP, "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    fp = written(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "text", shingle).drop("text"))
    comp = fingerprint_components(fp, "doc_id", max_bits)
    hexed = F.lpad(F.lower(F.hex(FP)), 16, "0").alias("fingerprint")
    return fp.join(comp, FP).select(F.col("doc_id").alias(id_col), hexed, "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the smallest id (of repeated rows, one)."""
    spare = {c: f"_simhash_{i}" for i, c in enumerate(docs.columns)}
    fp = written(with_fingerprint(docs.withColumnsRenamed(spare), spare[text], shingle))
    comp = fingerprint_components(fp, spare[id_col], max_bits)
    key = F.coalesce(F.col("component_id"), F.col(FP)).alias("component_key")
    named = fp.join(comp.select(FP, key, F.col("component_id").isNull().alias("unnamed")), FP)
    order = Window.partitionBy("component_key", "unnamed").orderBy(F.col(spare[id_col]).asc_nulls_last(), F.xxhash64(spare[text]))
    kept = named.withColumn("_simhash_rank", F.row_number().over(order)).where("_simhash_rank = 1")
    return kept.select([F.col(v).alias(k) for k, v in spare.items()])
