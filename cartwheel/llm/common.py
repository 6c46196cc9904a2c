"""Helpers shared by the operators: reading, shared written tables, Arrow slices, components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIR: list[str] = []


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did (an installed package needs nothing)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the cluster's ``spark.checkpoint.dir``.  Only a single-process
    ``local[...]`` session without that setting gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL_DIR:
            _LOCAL_DIR.append(tempfile.mkdtemp(prefix="cw-llm-", dir="/tmp"))
        base = _LOCAL_DIR[0]
    return f"{base}/cw-{uuid.uuid4().hex}"


def written(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write once to the shared folder and scan the files: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts in each hold about ``max_bytes`` (a longer text stands alone)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < b.num_rows:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + max_bytes, side="right")))
            yield b.slice(start, end - start)
            start = end


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64), elementwise on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


MAX_FILTER_BITS = 28  # of a broadcast bitmap: 32 MB


class Bitmap:
    """Which 64-bit keys may be wanted: one bit a key, by its low bits, in an array of a fixed largest size, so
    a large set lets more keys through and never loses one.  Made on executors, broadcast to tasks."""

    def __init__(self, wanted: DataFrame, key: str):
        n = wanted.count()
        self.bits = min(MAX_FILTER_BITS, max(15, int(16 * n).bit_length()))
        cell = wanted.select((F.col(key).bitwiseAND((1 << self.bits) - 1) + 1).alias("cell"))
        maps = cell.groupBy(F.expr("bitmap_bucket_number(cell) AS bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell)) AS bits"))
        held = np.zeros(1 << (self.bits - 3), np.uint8)
        for r in maps.toLocalIterator():  # 2 ** (bits - 15) rows of 4 KB at most
            held[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
        self.shared = wanted.sparkSession.sparkContext.broadcast(held)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(np.uint64) & np.uint64((1 << self.bits) - 1)
        return (self.shared.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered for at most ``limit`` words."""

    def __init__(self, hash_word, limit: int = 400_000):
        super().__init__()
        self.hash_word, self.limit = hash_word, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = self.hash_word(word)
        return h


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected edges between BIGINT nodes, by alternating large-star and
    small-star steps; every step is one written table.  Returns (node, root) for nodes that have an
    edge, root the smallest node reachable."""

    def digest(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    x, y = F.col(a), F.col(b)
    e = written(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u != v").distinct())
    seen = digest(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        e = written(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = digest(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
