"""Katz backoff scoring with a bigram model over whole texts.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end token; the first history is a
start symbol.  Counts r up to ``K`` get Good-Turing discounts d(r), larger ones keep r - 1/2, so
every history keeps some mass; the same holds for single words, whose spare mass goes to one
unknown word.  The probability of w after h is d(r) r / c(h) if the pair was seen r times in
training and alpha(h) P(w) if not, with alpha(h) such that the probabilities after h sum to one:

    alpha(h) = (1 - sum d(r) r / c(h)) / (1 - sum P(w)),  sums over the words seen after h.

Work flow.  One exchange: every chunk of documents groups its pairs by hash buckets of the second
word and sends each distinct pair once per bucket, with the documents it occurs in.  A bucket then
has, in a partition of its own, all counts of its pairs and of its second words, and writes, in tables partitioned by kind:
partial sums by document, partial sums by history, and the unseen pairs of held-out documents.
Buckets are as many as the input needs (``bucket_bytes``).  Words with a share above a bucket's
fair part are spread over buckets by the whole pair; they are at most ``4 * buckets`` words, found on
every ``layout_every``-th document (this only lays out the work) and counted exactly on all.  Discounts come
from counts of counts; backoff weights are one aggregate by history, written as a table; unseen
pairs, and only those, are joined to it, the recursion's second step.

Words are told apart by a 64-bit hash.  Defined cases: null and empty texts hold only the end
token; a null id counts as the empty text, so it is held out; repeated rows are separate documents;
without training documents every known count is 0 and P(unknown) is 1; an empty table stays empty.
"""

from __future__ import annotations

import math
import struct
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import WordHashes, mix64, slices, texts, written

K = 5
START, END = 1, 2
CHUNK_BYTES = 8 << 20
_HASH = WordHashes(lambda w: xxhash.xxh3_64_intdigest(w) | 4, 150_000)  # never START or END
DOC, HISTORY, UNSEEN, STATS, META = range(5)
OUT = pa.schema([("kind", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("v", pa.list_(pa.int64())), ("f", pa.list_(pa.float64()))])
SENT = pa.schema([("bucket", pa.int32()), ("base", pa.int64()), ("docs", pa.int64()), ("held", pa.binary()), ("pairs", pa.binary()), ("meta", pa.binary())])
OUT_DDL = "kind int, k1 long, k2 long, v array<long>, f array<double>"


class Pairs(NamedTuple):
    first: np.ndarray
    second: np.ndarray
    doc: np.ndarray
    n: np.ndarray  # tokens of each document


def pairs_of(docs: list[bytes]) -> Pairs:
    parts = []
    for t in docs:  # words of one text at a time are kept as objects
        w = t.lower().split()
        parts.append(np.fromiter(map(_HASH.__getitem__, w), np.uint64, len(w)))
    n = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    end = np.cumsum(n)
    second = np.full(int(n.sum()), END, np.uint64)
    for w, z in zip(parts, end.tolist(), strict=True):
        second[z - len(w) - 1 : z - 1] = w
    first = np.empty_like(second)
    first[1:] = second[:-1]
    first[end - n] = START
    return Pairs(first, second, np.repeat(np.arange(len(docs), dtype=np.int32), n), n)


def bucket_of(first: np.ndarray, second: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    x = mix64(second)
    wide = np.isin(second, hot)
    x[wide] = mix64(x[wide] + first[wide])
    return ((x >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _bytes(a: np.ndarray) -> bytes:
    """32-bit values by byte plane, so that the shuffle's compression sees the zeros."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _ints(data: memoryview, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, 4 * n).reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def to_blob(first: np.ndarray, second: np.ndarray, doc: np.ndarray) -> bytes:
    """Occurrences sorted by (second, first) of one chunk and bucket."""
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    at = np.flatnonzero(new)
    f, s = first[at], second[at]
    seconds, per = np.unique(s, return_counts=True)  # sorted, as the occurrences are
    firsts, index = np.unique(f, return_inverse=True)
    head = struct.pack("<IIII", len(seconds), len(firsts), len(at), len(doc))
    return b"".join((head, seconds.tobytes(), firsts.tobytes(), _bytes(per), _bytes(index), _bytes(np.diff(at, append=len(doc))), _bytes(doc)))


def from_blob(data: pa.Buffer):
    """(first, second, occurrences) by pair and the document of each occurrence."""
    s, f, p, n = struct.unpack_from("<IIII", data)
    view, at = memoryview(data), 16
    seconds = np.frombuffer(data, np.uint64, s, at)
    firsts = np.frombuffer(data, np.uint64, f, at + 8 * s)
    at += 8 * (s + f)
    parts = []
    for size in (s, p, p, n):
        parts.append(_ints(view[at:], size))
        at += 4 * size
    per, index, occurs, doc = parts
    return firsts[index], np.repeat(seconds, per), occurs, doc


def discounts(n: list[int]) -> list[float]:
    """d(0) unused, d(1)..d(K) by Good-Turing from counts of counts n[r], renormalised as Katz does; where
    those counts are too thin for it, (r - 1/2) / r."""
    flat = [1.0, *((r - 0.5) / r for r in range(1, K + 1))]
    if any(x <= 0 for x in n[1 : K + 2]):
        return flat
    a = (K + 1) * n[K + 1] / n[1]
    d = [1.0, *(((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) if a < 1 else 0.0 for r in range(1, K + 1))]
    return d if all(0 < x < 1 for x in d[1:]) else flat


def _classes(count: np.ndarray, group: np.ndarray, size: int) -> list[np.ndarray]:
    """Per group: how many counts equal 1..K, how many exceed K and their sum."""
    out = [np.bincount(group[count == r], minlength=size) for r in range(1, K + 1)]
    big = count > K
    return [*out, np.bincount(group[big], minlength=size), np.bincount(group[big], weights=count[big], minlength=size).astype(np.int64)]


def _rows(kind: int, k1, k2, v: list[np.ndarray], f: list[np.ndarray]) -> pa.Table:
    n = len(k1)
    lists = lambda cols, t: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(cols), pa.int32()), pa.array(np.stack(cols, 1).ravel() if cols else np.empty(0, t)))
    cols = [pa.array(np.full(n, kind, np.int32)), pa.array(k1), pa.array(k2), lists([np.asarray(x, np.int64) for x in v], np.int64), lists([np.asarray(x, float) for x in f], float)]
    return pa.Table.from_arrays(cols, schema=OUT)


def _sliced(rows: pa.Table) -> list[pa.RecordBatch]:
    return rows.to_batches(max_chunksize=1 << 15)


@contextmanager
def settings(spark: SparkSession, **values: int):
    """Spark SQL settings, with ``__`` for a dot and without ``spark.sql.``, while it lasts."""
    names = {f"spark.sql.{k.replace('__', '.')}": str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class Model(NamedTuple):
    """Global figures: N, V, training documents, discounts and the unknown word's probability."""

    n: int
    v: int
    docs: int
    d1: list[float]
    d2: list[float]
    unknown: float


def _model(uni: list[int], uni_big: int, n: int, docs: int, bi: list[int]) -> Model:
    d1, d2 = discounts(uni), discounts(bi)
    spare = sum(uni[r] * r * (1 - d1[r]) for r in range(1, K + 1)) + 0.5 * uni_big
    return Model(n, sum(uni[1 : K + 1]) + uni_big, docs, d1, d2, spare / n if n else 1.0)


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bucket_bytes: int = 16 << 20, layout_every: int = 64) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    named = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    plain = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"),
        (F.crc32(named.cast("binary")) % 10 == 0).alias("held"), F.col(text).cast("string").alias("text"),
    )
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))

    def word_counts(only: np.ndarray | None):
        def run(batches):
            for b in slices(batches, "text", CHUNK_BYTES):
                p = pairs_of(texts(b, "text"))
                train = p.second
                if only is not None:
                    train = train[~b.column("held").to_numpy(zero_copy_only=False)[p.doc]]
                    train = train[np.isin(train, only)]
                w, n = np.unique(train, return_counts=True)
                if only is None:  # a share of 1 / (4 buckets) of all is one in some chunks
                    often = n > len(train) / (8 * buckets)
                    w, n = np.append(w[often], 0), np.append(n[often], len(train))
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], ["w", "n"])

        return run

    sample = plain.where(f"pmod(xxhash64(key, id), {layout_every}) = 0").mapInArrow(word_counts(None), "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    total = sample.where("w = 0").first()
    often = sample.where(F.col("n") > (total["n"] if total else 0) / (4 * buckets)).where("w != 0").collect()  # 4 * buckets words at most
    hot = np.sort(np.array([r["w"] for r in often], np.int64).view(np.uint64))
    exact = plain.mapInArrow(word_counts(hot), "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).collect() if len(hot) else []
    hot_count = np.zeros(len(hot), np.int64)
    for r in exact:
        hot_count[np.searchsorted(hot, np.int64(r["w"]).astype(np.uint64))] = r["n"]

    def send(batches):
        for b in slices(batches, "text", CHUNK_BYTES):
            p = pairs_of(texts(b, "text"))
            to = bucket_of(p.first, p.second, hot, buckets)
            order = np.lexsort((p.first, p.second, to))
            first, second, doc, to = p.first[order], p.second[order], p.doc[order], to[order]
            cut = np.searchsorted(to, np.arange(buckets + 1))
            held = b.column("held").to_numpy(zero_copy_only=False)
            base = b.column("key")[0].as_py()
            known = b.column("id").is_valid().to_numpy(zero_copy_only=False)
            ids = b.column("id").fill_null(0).to_numpy()
            home = base % buckets
            for k in np.union1d(np.flatnonzero(np.diff(cut)), home).tolist():
                part = slice(cut[k], cut[k + 1])
                meta = np.concatenate((ids, known, held, p.n)).astype(np.int64).tobytes() if k == home else b""
                row = [k, base, len(held), np.packbits(held).tobytes(), to_blob(first[part], second[part], doc[part]), meta]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, SENT, strict=True)], schema=SENT)

    def decoded(batch: pa.RecordBatch):
        """Of each chunk: its base, documents, (first, second, occurrences, document, in training) and meta."""
        for base, size, held, pairs, meta in zip(*(batch.column(c) for c in SENT.names[1:]), strict=True):
            first, second, occurs, doc = from_blob(pairs.as_buffer())
            train = np.unpackbits(np.frombuffer(held.as_buffer(), np.uint8), count=size.as_py())[doc] == 0
            yield base.as_py(), size.as_py(), (first, second, occurs.astype(np.int32), doc.astype(np.int32), train), np.frombuffer(meta.as_buffer(), np.int64).copy()

    def reduce(batches):
        """Of one bucket: its tables, kind by kind; every array goes as soon as it has been used."""
        bases, sizes, cols = [], [], [[] for _ in range(5)]
        for batch in batches:
            for base, size, arrays, meta in decoded(batch):
                bases.append(base)
                sizes.append(size)
                for c, x in zip(cols, arrays, strict=True):
                    c.append(x)
                if len(meta):
                    ids, known, held, n = meta.reshape(4, size)
                    yield from _sliced(_rows(META, base + np.arange(size), ids, [known, held, n], []))
        if not bases:
            return
        del batch, arrays, x, meta
        bases, slots_at = np.array(bases, np.int64), np.cumsum([0, *sizes])
        slot_type = np.int64 if slots_at[-1] >> 31 else np.int32
        cols[3] = [x.astype(slot_type) + slot_type(at) for x, at in zip(cols[3], slots_at.tolist(), strict=False)]
        for i in range(5):
            cols[i] = np.concatenate(cols[i])
        first, second, occurs, slot, train = cols
        del cols
        pa.default_memory_pool().release_unused()
        order = np.lexsort((first, second))
        first, second = first[order], second[order]
        new = np.ones(len(order), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        number = np.empty(len(order), np.int32)
        number[order] = np.cumsum(new) - 1
        pair = np.repeat(number, occurs)
        first, second = first[new], second[new]
        del order, number, occurs
        c12 = np.bincount(pair[train], minlength=len(first))
        del train
        start = np.ones(len(second), bool)
        start[1:] = second[1:] != second[:-1]
        word = np.cumsum(start) - 1
        words = second[start]
        c2 = np.bincount(word, weights=c12).astype(np.int64)
        is_hot = np.isin(words, hot)
        c2[is_hot] = hot_count[np.searchsorted(hot, words[is_hot])]
        # counts of counts; those of hot words are added from their exact counts
        own, bi = c2[~is_hot & (c2 > 0)], c12[c12 > 0]
        of = lambda c: [int((c == r).sum()) for r in range(1, K + 2)]
        stats = [*of(own), int((own > K).sum()), int(own.sum()), *of(bi), int(c12[first == START].sum())]
        yield from _sliced(_rows(STATS, np.zeros(1, np.int64), np.zeros(1, np.int64), [np.array([x]) for x in stats], []))
        seen = c12 > 0
        h, group = np.unique(first[seen], return_inverse=True)
        sums = _classes(c12[seen], group, len(h)) + _classes(c2[word[seen]], group, len(h))
        yield from _sliced(_rows(HISTORY, h.view(np.int64), np.zeros(len(h), np.int64), sums, []))
        del h, group, sums
        key_of = lambda x: x - slots_at[(c := np.searchsorted(slots_at, x, side="right") - 1)] + bases[c]
        unseen = np.flatnonzero(~seen[pair])
        yield from _sliced(_rows(UNSEEN, key_of(slot[unseen].astype(np.int64)), first[pair[unseen]].view(np.int64), [c2[word[pair[unseen]]]], []))
        del unseen
        # by document
        count, known = c2[word], c2[word] > 0
        safe = np.where(known, count, 1)
        base_term, history_term = np.log10(count + 0.1), np.where(known & (second != END), np.log10(safe), 0.0)
        big_term = np.where(c12 > K, np.log10(np.maximum(c12, 1) - 0.5), 0.0)
        del first, second, word, seen
        docs_, at = np.unique(slot, return_inverse=True)
        del slot
        at = at.astype(np.int32)
        add = lambda x: np.bincount(at, weights=x[pair], minlength=len(docs_))
        ints = [add(known).astype(np.int64), *(add(c12 == r).astype(np.int64) for r in range(1, K + 1))]
        yield from _sliced(_rows(DOC, key_of(docs_.astype(np.int64)), np.zeros(len(docs_), np.int64), ints, [add(base_term), add(big_term - history_term)]))

    sent = plain.mapInArrow(send, "bucket int, base long, docs long, held binary, pairs binary, meta binary")
    # a partition is one bucket: neither a sort by bucket nor several buckets' tables in one task
    # rows of a megabyte each go to Python in small batches; a file for each kind is open at once, so rows are not sorted by kind
    with settings(docs.sparkSession, execution__arrow__maxBytesPerBatch=CHUNK_BYTES, maxConcurrentOutputFileWriters=META + 1):
        parts = written(sent.repartitionById(buckets, F.col("bucket")).mapInArrow(reduce, OUT_DDL), ["kind"])
    stats = [sum(x) for x in zip(*(r["v"] for r in parts.where(F.col("kind") == STATS).select("v").collect()), strict=True)] or [0] * (2 * K + 5)
    uni, (uni_big, n), bi, train_docs = [0, *stats[: K + 1]], stats[K + 1 : K + 3], [0, *stats[K + 3 : 2 * K + 4]], stats[2 * K + 4]
    for c in hot_count.tolist():
        if 0 < c <= K + 1:
            uni[c] += 1
        uni_big, n = uni_big + (c > K), n + c
    m = _model(uni, uni_big, n, train_docs, bi)

    v = lambda i: F.col("v")[i]
    r_ = range(1, K + 1)
    spare = sum((v(r - 1) * (r * (1 - m.d2[r])) for r in r_), v(K) * 0.5)
    size_ = sum((v(r - 1) * r for r in r_), v(K + 1))
    covered = sum((v(K + 1 + r) * (r * m.d1[r]) for r in r_), v(2 * K + 3) - 0.5 * v(2 * K + 2)) / max(m.n, 1)
    history = parts.where(F.col("kind") == HISTORY).select(F.col("k1").alias("h"), spare.alias("spare"), size_.alias("c"), covered.alias("p"))
    history = history.groupBy("h").agg(*(F.sum(c).alias(c) for c in ("spare", "c", "p")))
    alphas = written(history.select("h", "c", (F.col("spare") / F.col("c") / (1 - F.col("p"))).alias("alpha")))

    p1 = F.when(v(0) == 0, F.lit(m.unknown))
    for r in r_:
        p1 = p1.when(v(0) == r, F.lit(r * m.d1[r] / max(m.n, 1)))
    p1 = p1.otherwise((v(0) - 0.5) / max(m.n, 1))
    unseen = parts.where(F.col("kind") == UNSEEN).select("k1", F.col("k2").alias("h"), F.log10(p1).alias("lp"))
    unseen = unseen.join(alphas, "h", "left").select(
        F.col("k1").alias("key"), (F.col("lp") + F.coalesce(F.log10(F.col("alpha") * F.when(F.col("h") == START, 1).otherwise(F.col("c"))), F.lit(0.0))).alias("score"),
    )
    # The start symbol's count is taken off every document below, so it is put back for its unseen pairs.
    back = math.log10(m.docs) if m.docs else 0.0
    first_unseen = parts.where((F.col("kind") == UNSEEN) & (F.col("k2") == START)).select(F.col("k1").alias("key"), F.lit(back).alias("score"))
    null, zero, nil = F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(0.0)
    seen_score = sum((v(r) * math.log10(r * m.d2[r]) for r in r_), F.col("f")[1])
    names = ("key", "id", "known", "held", "n_tokens", "n_known", "base", "score")

    def frame(df: DataFrame, key, id_, known, held, n_tokens, n_known, base, score_) -> DataFrame:
        cols = (key, id_, known, held, n_tokens, n_known, base, score_)
        return df.select(*(c.alias(x) for c, x in zip(cols, names, strict=True)))

    doc = parts.where(F.col("kind") == DOC)
    meta = parts.where(F.col("kind") == META)
    rows = frame(doc, F.col("k1"), null, null, null, zero, v(0), F.col("f")[0], seen_score)
    rows = rows.union(frame(meta, F.col("k1"), F.col("k2"), v(0), v(1), v(2), zero, nil, F.lit(-back)))
    for extra in (unseen, first_unseen):
        rows = rows.union(frame(extra, F.col("key"), null, null, null, zero, zero, nil, F.col("score")))
    by_doc = rows.groupBy("key").agg(*(F.max(c).alias(c) for c in ("id", "known", "held")), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")))
    norm = math.log10(m.n + 0.1 * (m.v + 1))
    return by_doc.select(
        F.when(F.col("known") == 1, F.col("id")).alias(id_col), (F.col("held") == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(m.n).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * norm).alias("base_score"), "score",
    )
