"""Benchmark decontamination by winnowing.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.  A window is
``span`` consecutive words of a benchmark item; an item of fewer words is one window.  Every
``gram``-word sequence is hashed and the rightmost smallest hash of each ``span - gram + 1``
neighbours is kept, on both sides, so any shared run of ``span`` words shares a kept hash at the
same place.  Kept hashes are joined and every match is extended word by word in both directions;
runs of at least ``span`` words are hits (all their windows lie in the item).  Items below
``span`` words are matched by the hash of the whole item against all runs of that length.

The benchmark's fingerprints are broadcast only if a count of its words shows that they are few
(``max_broadcast_words``); beyond that both sides' fingerprints are joined by Spark and the matches
extended in groups of one distinct text.

Defined cases: null or wordless documents and items have no words, so no hit; an item with a null
id marks words but is not listed; repeated rows get the same result each; an empty benchmark
leaves every document clean.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import WordHashes, mix64, slices, texts

SPAN, GRAM = 10, 5
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_HASH = WordHashes(lambda w: xxhash.xxh64_intdigest(w, 7))
FOUND = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
FOUND_SCHEMA = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("n_words", pa.int64()), ("spans", SPANS), ("items", pa.list_(pa.string()))])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position (as many as have k words)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    g = np.zeros(m, np.uint64)
    for j in range(k):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[j : j + m]
    return mix64(g ^ np.uint64(k))


def winnowed(g: np.ndarray, w: int) -> np.ndarray:
    """Positions of the rightmost minimum of every w neighbours."""
    return distinct(smallest(g, w))


def smallest(g: np.ndarray, w: int) -> np.ndarray:
    """Position of the rightmost minimum of the w neighbours from each place on; it never falls."""
    m = len(g) - w + 1
    if m <= 0:
        return np.empty(0, np.int64)
    best, after = g[w - 1 :], np.full(m, w - 1, np.int64)
    for j in range(w - 2, -1, -1):
        less = g[j : j + m] < best
        after[less] = j
        best = np.minimum(best, g[j : j + m])
    return after + np.arange(m)


def distinct(at: np.ndarray) -> np.ndarray:
    """``at``, which never falls, without repeats."""
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at


def fingerprints(words: list[bytes], short: tuple[int, ...] | None, span: int, gram: int):
    """Arrays (length, hash, position).  ``short`` None: of an item, else of a document, lengths of short items."""
    h = np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))
    if short is None and 0 < len(words) < span:
        return [(len(words), gram_hashes(h, len(words)), np.zeros(1, np.int64))]
    out = []
    if len(words) >= span:
        g = gram_hashes(h, gram)
        at = winnowed(g, span - gram + 1)
        out.append((0, g[at], at))
    for n in short or ():
        g = gram_hashes(h, n)
        out.append((n, g, np.arange(len(g))))
    return out


def extended(doc: list[bytes], item: list[bytes], i: int, j: int, span: int) -> tuple[int, int] | None:
    """The longest shared run through doc[i] = item[j], if long enough."""
    a = b = 0
    while i - a > 0 and j - a > 0 and doc[i - a - 1] == item[j - a - 1]:
        a += 1
    while i + b < len(doc) and j + b < len(item) and doc[i + b] == item[j + b]:
        b += 1
    return (i - a, i + b) if a + b >= min(span, len(item)) else None


def hits(doc: list[bytes], matches, span: int):
    """Merged word spans and sorted item ids, from (position, item words, item ids, item position) in any order.

    ``item words`` is one list per distinct item text, ``item ids`` the ids of that text.  A match inside the run of an
    earlier one on its diagonal is skipped; by position, since a run tells nothing of the places before it."""
    done: dict = {}
    runs, items = [], set()
    for i, item, ids, j in sorted(matches, key=itemgetter(0)):
        key = (id(item), i - j)
        if done.get(key, -1) > i:
            continue
        run = extended(doc, item, i, j, span)
        done[key] = max(i + 1, run[1] if run else 0)
        if run:
            runs.append(run)
            items.update(ids)
    merged: list[list[int]] = []
    for a, b in sorted(runs):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return merged, sorted(items)


class Index:
    """Fingerprints of a benchmark of bounded size."""

    def __init__(self, rows, span: int, gram: int):
        self.span, self.gram = span, gram
        ids: dict[str, set[str]] = defaultdict(set)
        for item_id, text in rows:
            ids[text or ""].update(() if item_id is None else (str(item_id),))
        self.items = [(tuple(x), words_of(t.encode())) for t, x in ids.items()]
        self.at = defaultdict(list)
        for n, (_, words) in enumerate(self.items):
            for length, g, at in fingerprints(words, None, span, gram):
                for x, j in zip(g.tolist(), at.tolist(), strict=True):
                    self.at[length, x].append((n, j))
        self.short = tuple(sorted({k for k, _ in self.at} - {0}))
        self.hashes = {k: np.unique(np.array([x for n, x in self.at if n == k], np.uint64)) for k in (0, *self.short)}

    def scan(self, batch: list[bytes]) -> list[tuple[int, list, list]]:
        """(n_words, merged spans, item ids) of each text; the words of a batch are hashed as one array."""
        docs = [words_of(t) for t in batch]
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        ends = np.cumsum(sizes)
        h = np.fromiter(map(_HASH.__getitem__, chain.from_iterable(docs)), np.uint64, int(sizes.sum()))
        left = np.repeat(ends, sizes) - np.arange(len(h))  # words from each place to the end of its text
        found: dict[int, list] = defaultdict(list)
        for length, known in self.hashes.items():
            if not len(known):
                continue
            g = gram_hashes(h, length or self.gram)
            if length:
                at = np.flatnonzero(left[: len(g)] >= length)
            else:
                at = smallest(g, self.span - self.gram + 1)
                at = distinct(at[left[: len(at)] >= self.span])
            place = np.minimum(np.searchsorted(known, g[at]), len(known) - 1)
            at = at[known[place] == g[at]]
            owner = np.searchsorted(ends, at, side="right")
            for d, i, x in zip(owner.tolist(), (at - (ends - sizes)[owner]).tolist(), g[at].tolist(), strict=True):
                found[d] += [(i, *self.items[n][::-1], j) for n, j in self.at[length, x]]
        return [(len(doc), *(hits(doc, found[d], self.span) if d in found else ([], []))) for d, doc in enumerate(docs)]


def _bounded(benchmark: DataFrame, item_text: str, limit: int) -> bool:
    size = F.sum(F.length(item_text)).alias("n")
    return (benchmark.agg(size).first()["n"] or 0) <= 2 * limit  # a word and its gap are two characters at least


def _found_by_text(docs: DataFrame, benchmark: DataFrame, span: int, gram: int) -> DataFrame:
    """(k1, k2, FOUND) of each distinct text with hits, by a join of fingerprints; benchmark: item_id, text."""
    keyed = docs.select(F.xxhash64("text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2"), "text")
    keyed = keyed.dropDuplicates(["k1", "k2"])
    lengths = benchmark.select(F.explode(F.sequence(F.lit(1), F.lit(span - 1))).alias("n")).distinct()
    short = tuple(r["n"] for r in lengths.collect())  # below span values

    def prints(of_items: bool):
        def run(batches):
            for b in slices(batches, "text", 4 << 20):
                for r, t in enumerate(texts(b, "text")):
                    for n, g, at in fingerprints(words_of(t), None if of_items else short, span, gram):
                        keep = b.slice(r, 1).drop_columns(["text"]) if not of_items else b.slice(r, 1)
                        idx = pa.array(np.zeros(len(at), np.int64))
                        cols = [c.take(idx) for c in keep.columns]
                        more = [pa.array(np.full(len(at), n, np.int32)), pa.array(g.view(np.int64)), pa.array(at)]
                        yield pa.RecordBatch.from_arrays(cols + more, [*keep.schema.names, "len", "hash", "at"])

        return run

    items = benchmark.where("text != ''").groupBy("text").agg(F.collect_set("item_id").alias("ids"))  # null ids left out
    items = items.select("ids", "text").mapInArrow(prints(True), "ids array<string>, text string, len int, hash long, at long")
    items = items.withColumnsRenamed({"text": "item", "at": "j"})
    spots = keyed.mapInArrow(prints(False), "k1 long, k2 long, len int, hash long, at long")
    matches = spots.join(items, ["len", "hash"]).select("k1", "k2", "at", "ids", "item", "j")

    def extend(text: pa.Table, found: pa.Table) -> pa.Table:
        if not len(found) or not len(text):
            return FOUND_SCHEMA.empty_table()
        at, item, ids, j = (found.column(c).to_pylist() for c in ("at", "item", "ids", "j"))
        split = {t: words_of(t.encode()) for t in set(item)}
        doc = words_of((text.column("text")[0].as_py() or "").encode())
        spans, items_ = hits(doc, zip(at, (split[t] for t in item), ids, j, strict=True), span)
        row = {"k1": text.column("k1")[0].as_py(), "k2": text.column("k2")[0].as_py(), "n_words": len(doc)}
        return pa.Table.from_pylist([row | {"spans": [{"start": x, "end": z} for x, z in spans], "items": items_}], FOUND_SCHEMA)

    out = keyed.groupBy("k1", "k2").cogroup(matches.groupBy("k1", "k2"))
    return out.applyInArrow(extend, f"k1 long, k2 long, {FOUND}")


def _plain(df: DataFrame, id_col: str, text: str, name: str) -> DataFrame:
    return df.select(F.col(id_col).alias(name), F.col(text).cast("string").alias("text"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", span: int = SPAN, gram: int = GRAM, max_broadcast_words: int = 1_000_000) -> DataFrame:
    """One row per document: id, n_words, spans (merged word ranges that are hit), items (ids, sorted)."""
    items, plain = _plain(benchmark, item_id, item_text, "item_id"), _plain(docs, id_col, text, "doc_id")
    items = items.withColumn("item_id", F.col("item_id").cast("string"))
    if _bounded(items, "text", max_broadcast_words):
        index = Index([tuple(r) for r in items.collect()], span, gram)

        def run(batches):
            for b in slices(batches, "text", 4 << 20):
                n, spans, found = zip(*index.scan(texts(b, "text")), strict=True)
                spans = pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], SPANS)
                cols = [b.column("doc_id"), pa.array(n, pa.int64()), spans, pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "spans", "items"])

        kind = plain.schema["doc_id"].dataType.simpleString()
        return plain.mapInArrow(run, f"doc_id {kind}, {FOUND}").withColumnRenamed("doc_id", id_col)

    def count(batches):
        for b in slices(batches, "text", 16 << 20):
            n = pa.array([len(words_of(t)) for t in texts(b, "text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"), n], ["doc_id", "k1", "k2", "n"])

    found = _found_by_text(plain, items, span, gram).drop("n_words")
    rows = plain.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64("text", F.lit(1))})
    rows = rows.mapInArrow(count, T.StructType([plain.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("k1", "k2", "n"))]))
    none = "array<struct<start:int,end:int>>"
    return rows.join(found, ["k1", "k2"], "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_words"),
        F.coalesce("spans", F.array().cast(none)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                      span: int = SPAN, gram: int = GRAM, max_broadcast_words: int = 1_000_000) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    items = _plain(benchmark, item_id, item_text, "item_id").withColumn("item_id", F.col("item_id").cast("string"))
    if _bounded(items, "text", max_broadcast_words):
        index = Index([tuple(r) for r in items.collect()], span, gram)

        def run(batches):
            for b in slices(batches, text, 4 << 20):
                yield b.filter(pa.array([not spans for _, spans, _ in index.scan(texts(b, text))]))

        return docs.mapInArrow(run, docs.schema)
    plain = docs.select(F.col(text).cast("string").alias("text"))
    found = _found_by_text(plain, items, span, gram).where("size(spans) > 0").select("k1", "k2")
    keys = (F.xxhash64(docs[text]) == found["k1"]) & (F.xxhash64(docs[text], F.lit(1)) == found["k2"])
    return docs.join(found, keys, "left_anti")
