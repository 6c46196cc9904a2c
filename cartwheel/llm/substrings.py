"""Substring deduplication with a count-min prefilter.

A window is ``window`` consecutive words (``[^\\x20\\x09-\\x0D]+``, unchanged) of one document.  Each
word covered by a window whose word sequence also starts in a document with a smaller id is
removed; windows are judged on the input.

First pass: every chunk of documents sends the sketch cells its windows touch (twice or more is
marked), gap-coded by block of cells; the blocks' counts are merged, and what stays is one bit per
cell: counted twice or more.  A count-min estimate never falls below the true count, so windows
with a clear bit occur once and need no exact look.  The sketch has two rows of
``2 ** cell_bits`` cells, chosen by input size up to ``MAX_CELL_BITS`` (two rows of 32 MB of bits:
what is broadcast is bounded).  On larger inputs more windows pass; the result is the same.

Second pass: each chunk sends its distinct passing windows once each (a 96-bit hash and its
smallest id), packed by hash range; a range finds the smallest id of each window and returns one
bit per window and chunk.  A passage in a third of all documents is thus one entry a chunk.
Third pass: chunks meet their bits and cut their texts.

The chunks of the second and third pass are the same slices of the same scan, so ``docs`` must be
read alike twice (files, or a written table); a mismatch raises instead of giving wrong rows.

Defined cases: null and empty texts have no words; a document with a null id is kept whole and
removes nothing; repeated ids are the same document and don't remove each other; an empty table
gives an empty one.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import WordHashes, mix64, slices, texts

WINDOW = 13
MAX_CELL_BITS = 28
BLOCK_BITS = 20
CHUNK_BYTES = 6 << 20
_HASH = WordHashes(lambda w: xxhash.xxh3_64_intdigest(w), 150_000)


class Chunk:
    """Words and windows of some documents."""

    def __init__(self, ids: list[int | None], docs: list[bytes], window: int):
        self.words = [t.split() for t in docs]
        self.n = np.fromiter(map(len, self.words), np.int64, len(docs))
        self.first = np.cumsum(self.n) - self.n
        total = int(self.n.sum())
        h = np.empty(total, np.uint64)
        for w, a in zip(self.words, self.first.tolist(), strict=True):
            h[a : a + len(w)] = np.fromiter(map(_HASH.__getitem__, w), np.uint64, len(w))
        known = np.array([x is not None for x in ids], bool)
        count = np.where(known, np.maximum(self.n - window + 1, 0), 0)
        doc = np.repeat(np.arange(len(docs)), count)
        self.at = self.first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        self.doc_id = np.array([0 if x is None else x for x in ids], np.int64)[doc]
        hi, lo = np.zeros(max(0, total - window + 1), np.uint64), np.zeros(max(0, total - window + 1), np.uint64)
        for j in range(window):
            part = h[j : j + len(hi)]
            hi = hi * np.uint64(0x9E3779B97F4A7C15) + part
            lo = lo * np.uint64(0xD6E8FEB86659FD93) + (part ^ (part >> np.uint64(29)))
        self.hi = mix64(hi[self.at])
        self.lo = (mix64(lo[self.at]) >> np.uint64(32)).astype(np.uint32)

    def cells(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - bits)
        return (self.hi >> shift).astype(np.int64), (mix64(self.hi + np.uint64(2)) >> shift).astype(np.int64)

    def entries(self, sketch: np.ndarray, bits: int):
        """Of windows that may occur twice, sorted by hash: their order, entry of each, first of each entry."""
        c0, c1 = self.cells(bits)
        get = lambda row, c: (sketch[row, c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1
        passing = np.flatnonzero(get(0, c0) & get(1, c1))
        order = passing[np.argsort(self.hi[passing], kind="stable")]
        hi, lo = self.hi[order], self.lo[order]
        new = np.ones(len(order), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        return order, np.cumsum(new) - 1, np.flatnonzero(new)


def gaps(at: np.ndarray) -> bytes:
    """Sorted distinct positions as gaps: bytes of 255 add up, any other byte ends a gap."""
    g = np.diff(at, prepend=-1) - 1
    full = g // 255
    out = np.full(int(full.sum()) + len(g), 255, np.uint8)
    out[np.cumsum(full + 1) - 1] = g % 255
    return out.tobytes()


def ungaps(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    end = b < 255
    return (np.cumsum(b, dtype=np.int64)[end] + np.arange(1, int(end.sum()) + 1)) - 1


def _sketch(plain: DataFrame, bits: int, window: int) -> np.ndarray:
    block_bits = min(BLOCK_BITS, bits)

    def touch(batches):
        for b in slices(batches, "text", CHUNK_BYTES):
            chunk = Chunk(b.column("id").to_pylist(), texts(b, "text"), window)
            for row, c in enumerate(chunk.cells(bits)):
                c, n = np.unique(c, return_counts=True)
                cut = np.searchsorted(c, np.arange(1, 1 << (bits - block_bits)) << block_bits)
                for k, (part, many) in enumerate(zip(np.split(c, cut), np.split(n > 1, cut), strict=True)):
                    if len(part):
                        part = part - (k << block_bits)
                        cols = [pa.array([(row << 32) + k]), pa.array([gaps(part)], pa.binary()), pa.array([gaps(part[many])], pa.binary())]
                        yield pa.RecordBatch.from_arrays(cols, ["block", "once", "more"])

    def merge(parts: pa.Table) -> pa.Table:
        out = np.zeros(1 << block_bits, np.uint8)
        for once, more in zip(parts.column("once").to_pylist(), parts.column("more").to_pylist(), strict=True):
            c = ungaps(once)
            out[c] = np.minimum(out[c] + 1, 2)
            out[ungaps(more)] = 2
        return pa.table([parts.column("block").slice(0, 1), pa.array([np.packbits(out >= 2).tobytes()])], ["block", "bits"])

    parts = plain.mapInArrow(touch, "block long, once binary, more binary")
    merged = parts.groupBy("block").applyInArrow(merge, "block long, bits binary")
    sketch = np.zeros((2, max(1, 1 << (bits - 3))), np.uint8)
    size = (1 << block_bits) // 8
    found = merged.toArrow()  # 2 ** (bits - 2) bytes at most
    for block, data in zip(found.column("block"), found.column("bits"), strict=True):
        row, k = block.as_py() >> 32, block.as_py() & 0xFFFFFFFF
        sketch[row, k * size : (k + 1) * size] = np.frombuffer(data.as_buffer(), np.uint8)
    return sketch


def drop_repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                             cell_bits: int | None = None, ranges: int | None = None) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept (the words that stay, joined by one space)."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = cell_bits or min(MAX_CELL_BITS, max(16, math.ceil(math.log2(max(1, size / 4)))))
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sketch = spark.sparkContext.broadcast(_sketch(plain, bits, window))

    def numbered(batches):
        part = TaskContext.get().partitionId()
        for k, b in enumerate(slices(batches, "text", CHUNK_BYTES)):
            yield (part << 32) + k, b

    def split(chunk: Chunk):
        """Entries of a chunk and where each hash range starts among them."""
        order, entry, first = chunk.entries(sketch.value, bits)
        hi = chunk.hi[order[first]]
        of = ((hi >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        least = np.minimum.reduceat(chunk.doc_id[order], first) if len(first) else np.empty(0, np.int64)
        return order, entry, first, hi, least, np.searchsorted(of, np.arange(ranges + 1))

    def send(batches):
        for number, b in numbered(batches):
            chunk = Chunk(b.column("id").to_pylist(), texts(b, "text"), window)
            order, _, first, hi, least, cut = split(chunk)
            lo = chunk.lo[order[first]]
            for k in np.flatnonzero(np.diff(cut)).tolist():
                a, z = cut[k], cut[k + 1]
                data = hi[a:z].tobytes() + lo[a:z].tobytes() + least[a:z].view(np.uint8).reshape(-1, 8).T.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([number]), pa.array([int(z - a)]), pa.array([data], pa.binary())], ["range", "chunk", "n", "data"])

    def decide(parts: pa.Table) -> pa.Table:
        hi, lo, least = [], [], []
        n = parts.column("n").to_pylist()
        for m, d in zip(n, parts.column("data").to_pylist(), strict=True):
            hi.append(np.frombuffer(d, np.uint64, m))
            lo.append(np.frombuffer(d, np.uint32, m, 8 * m))
            least.append(np.ascontiguousarray(np.frombuffer(d, np.uint8, 8 * m, 12 * m).reshape(8, m).T).view(np.int64).ravel())
        hi, lo, least = map(np.concatenate, (hi, lo, least))
        order = np.lexsort((lo, hi))
        new = np.ones(len(order), bool)
        new[1:] = (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1])
        smallest = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        earlier = np.empty(len(order), bool)
        earlier[order] = smallest < least[order]
        bits_ = [np.packbits(x).tobytes() for x in np.split(earlier, np.cumsum(n)[:-1])]
        return pa.table([parts.column("chunk"), parts.column("range"), parts.column("n"), pa.array(bits_, pa.binary())], ["chunk", "range", "n", "bits"])

    def label(batches):
        for number, b in numbered(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, number)), *b.columns], ["chunk", "id", "text"])

    def cut_texts(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.combine_chunks().to_batches()
        if not rows:
            return out_schema.empty_table()
        ids, docs_ = rows[0].column("id").to_pylist(), texts(rows[0], "text")
        chunk = Chunk(ids, docs_, window)
        order, entry, first, _, least, cut = split(chunk)
        flags = np.zeros(len(first), bool)
        got = 0
        for k, n, data in zip(*(right.column(c).to_pylist() for c in ("range", "n", "bits")), strict=True):
            if n != cut[k + 1] - cut[k]:
                raise RuntimeError("the documents were read differently in two passes: write them first")
            flags[cut[k] : cut[k + 1]] = np.unpackbits(np.frombuffer(data, np.uint8), count=n)
            got += n
        if got != len(first):
            raise RuntimeError("the documents were read differently in two passes: write them first")
        gone = chunk.at[order[flags[entry] | (chunk.doc_id[order] > least[entry])]]
        edge = np.zeros(int(chunk.n.sum()) + 1, np.int64)
        np.add.at(edge, gone, 1)
        np.add.at(edge, gone + window, -1)
        keep = np.cumsum(edge)[:-1] == 0
        kept, removed = [], []
        for w, a in zip(chunk.words, chunk.first.tolist(), strict=True):
            k = keep[a : a + len(w)]
            removed.append(int(len(w) - k.sum()))
            kept.append(b" ".join(compress(w, k.tolist()) if removed[-1] else w).decode())
        return pa.table([pa.array(ids, pa.int64()), pa.array(chunk.n), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], out_schema)

    out_schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    found = plain.mapInArrow(send, "range long, chunk long, n long, data binary").groupBy("range")
    bits_df = found.applyInArrow(decide, "chunk long, range long, n long, bits binary")
    dealt = plain.mapInArrow(label, "chunk long, id long, text string").groupBy("chunk").cogroup(bits_df.groupBy("chunk"))
    return dealt.applyInArrow(cut_texts, "doc_id long, n_words long, n_removed long, kept string").withColumnRenamed("doc_id", id_col)
