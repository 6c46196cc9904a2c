"""MinHash near-duplicates by tensored banding, links confirmed on full sets.

A document's set holds its distinct k-word shingles (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``; fewer words:
the whole sequence; none: empty, linked with nothing).  Two sets link if ``100 * intersection >= percent * union``.

Two collections of ``groups`` sub-keys, each of ``width`` minima, are computed per distinct set; every pair of a
sub-key of the first and one of the second collection is the key of a table.  That is ``groups ** 2`` tables of
``2 * width`` minima for ``2 * groups * width`` minima computed, about the square root of what separate tables take.
Two sets of similarity s share a table with probability ``(1 - (1 - s ** width) ** groups) ** 2``: with 14 groups of
3, all but 4 in a million of those at 0.85.  Keys are made only of sub-keys that two sets share.

A table's bucket is tested as a star first: each member against the bucket's hub, the member with the most
partners, so a group of n near copies costs about n tests.  Members that the stars leave in different
components are then tested against each other.  Before a test, sizes and 1,024 parities of the sets
bound the symmetric difference and drop pairs that cannot link; neither loses a link.

Shingles are told apart by 64-bit hashes, sets by 128-bit ones.  Defined cases: a null id is never the smallest of a
component (a component of null ids has component null); repeated rows and equal sets are one node; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Bitmap, WordHashes, components, mix64, slices, texts, written

GROUPS, WIDTH, PERCENT, SHINGLE = 14, 3, 85, 3
PARITY_BITS = 10  # 1,024 parities a set
_ROWS = "id long, key long, n long, d1 long, d2 long, parity array<long>, sig array<long>"


def shingle_set(words: np.ndarray, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text's word hashes."""
    if not len(words):
        return words
    width = min(shingle, len(words))
    n = len(words) - width + 1
    h = mix64(words[:n] + np.uint64(width))
    for i in range(1, width):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return np.unique(h)


class Sketcher:
    """Sub-keys and parities of shingle sets; the same for any process."""

    def __init__(self, groups: int, width: int):
        rng = np.random.default_rng(2)
        n = 2 * groups * width
        self.groups, self.width = groups, width
        self.salt = rng.integers(0, 1 << 63, (n, 1), dtype=np.uint64)
        self.odd = rng.integers(0, 1 << 63, (n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sub_keys(self, h: np.ndarray) -> np.ndarray:
        least = np.full(len(self.odd), np.iinfo(np.uint64).max)
        for a in range(0, len(h), 2048):
            least = np.minimum(least, ((h[a : a + 2048] ^ self.salt) * self.odd).min(axis=1))
        least = least.reshape(2 * self.groups, self.width)
        key = np.zeros(2 * self.groups, np.uint64)
        for i in range(self.width):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + least[:, i])
        return key.view(np.int64)

    @staticmethod
    def parity(h: np.ndarray) -> np.ndarray:
        odd = np.bincount((h >> np.uint64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _plain(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return d.withColumn("key", F.xxhash64("text"))


def _text_sets(batch: pa.RecordBatch, known: WordHashes, shingle: int):
    for t in texts(batch, "text"):
        w = t.lower().split()
        yield shingle_set(np.fromiter(map(known.__getitem__, w), np.uint64, len(w)), shingle)


def _digest(data: bytes) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(data), np.int64)


def _sketches(plain: DataFrame, shingle: int, groups: int, width: int) -> DataFrame:
    """A row per document: row, id, key (of its text), n, d1, d2 (digest of the set), parity, sig (sub-keys)."""

    def run(batches):
        sketch, known = Sketcher(groups, width), WordHashes(xxhash.xxh3_64_intdigest)
        for b in slices(batches, "text", 8 << 20):
            out: list[list] = [[] for _ in range(5)]
            for h in _text_sets(b, known, shingle):
                d1, d2 = _digest(h.tobytes())
                for column, x in zip(out, (len(h), d1, d2, sketch.parity(h).tolist(), sketch.sub_keys(h).tolist() if len(h) else []), strict=True):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), *map(pa.array, out, kinds)], ["id", "key", "n", "d1", "d2", "parity", "sig"])

    return written(plain.mapInArrow(run, _ROWS).withColumn("row", F.monotonically_increasing_id()))


def _sets_of(plain: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, hashes) of the nodes in ``wanted`` (node, key, d1, d2), from a second pass over the texts.

    Only texts whose key is in a bitmap of the wanted keys are cut into shingles and sent on, copies once a
    task; the bitmap has a fixed largest size, and what it lets through needlessly the join drops."""
    held = Bitmap(wanted, "key")

    def run(batches):
        known, sent = WordHashes(xxhash.xxh3_64_intdigest), set()
        for b in slices(batches, "text", 8 << 20):
            hit = held.may_hold(b.column("key").to_numpy())
            new = []
            for i in np.flatnonzero(hit).tolist():
                k = b.column("key")[i].as_py()
                if k not in sent:
                    sent.add(k)
                    new.append(i)
            if len(sent) > 1_000_000:
                sent.clear()
            b = b.take(pa.array(new, pa.int64()))
            data = [h.tobytes() for h in _text_sets(b, known, shingle)]
            digests = np.array([_digest(x) for x in data], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(data, pa.binary())], ["d1", "d2", "hashes"])

    found = plain.where("text IS NOT NULL").mapInArrow(run, "d1 long, d2 long, hashes binary")
    return written(found.join(wanted.select("node", "d1", "d2"), ["d1", "d2"]).groupBy("node").agg(F.first("hashes").alias("hashes")))


def _possible(percent: int, a: str, b: str) -> str:
    """SQL of what must hold of two linked sets' sizes and parities."""
    bits = " + ".join(f"bit_count({a}_parity[{i}] ^ {b}_parity[{i}])" for i in range(1 << (PARITY_BITS - 6)))
    return (f"100 * least({a}_n, {b}_n) >= {percent} * greatest({a}_n, {b}_n)"
            f" AND {100 + percent} * ({bits}) <= {100 - percent} * ({a}_n + {b}_n)")  # fmt: skip


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets link, written."""

    def run(batches):
        for batch in batches:
            for b in slices([batch], "a_set", 8 << 20):
                keep = []
                for x, y in zip(b.column("a_set").to_pylist(), b.column("b_set").to_pylist(), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = np.sort(np.concatenate((x, y)), kind="stable")
                    same = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * same >= percent * (len(both) - same))
                yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    both = pairs.select("a", "b").join(sets.toDF("a", "a_set"), "a").join(sets.toDF("b", "b_set"), "b")
    return written(both.mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                    groups: int = GROUPS, width: int = WIDTH) -> DataFrame:
    """One row per document: id, n_shingles, component_id and kept (the id is its component's)."""
    plain = _plain(docs, id_col, text)
    rows = _sketches(plain, shingle, groups, width)
    nodes = written(rows.where("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("node"), F.min("id").alias("least")))
    sketches = written(rows.drop("id").withColumnRenamed("row", "node").join(nodes.select("node"), "node"))

    subs = sketches.select("node", F.posexplode("sig").alias("pos", "val"))
    shared = subs.groupBy("pos", "val").agg(F.count("*").alias("c")).where("c > 1")
    held = subs.join(shared, ["pos", "val"]).groupBy("node").agg(F.sum("c").alias("partners"), F.collect_list(F.struct("pos", "val")).alias("subs"))
    tables = f"transform(filter(subs, x -> x.pos < {groups}), x -> transform(filter(subs, y -> y.pos >= {groups}), y -> xxhash64(x.pos, x.val, y.pos, y.val)))"
    keyed = written(held.select("node", "partners", F.explode(F.expr(f"flatten({tables})")).alias("key")))
    hubs = keyed.groupBy("key").agg(F.count("*").alias("c"), F.max(F.struct("partners", "node")).alias("hub")).where("c > 1")
    members = written(keyed.join(hubs.select("key", F.col("hub.node").alias("hub")), "key").select("key", "node", "hub"))

    known = written(sketches.drop("sig").join(members.select("node").distinct(), "node"))
    side = lambda c: known.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("parity").alias(f"{c}_parity"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return _confirmed(pairs, _sets_of(plain, written(known.select("node", "key", "d1", "d2").join(ends, "node")), shingle), percent)

    stars = members.where("node != hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    stars = written(stars.join(side("a"), "a").join(side("b"), "b").where(_possible(percent, "a", "b")).select("a", "b"))
    links = confirmed(stars)

    roots = components(links, "a", "b")
    placed = members.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key")
    rest = written(placed.join(open_, "key").join(known.drop("key"), "node").select("key", "node", "root", "n", "parity"))
    left, right = rest.toDF("key", "a", "a_root", "a_n", "a_parity"), rest.toDF("key", "b", "b_root", "b_n", "b_parity")
    pairs = left.join(right.hint("merge"), "key").where(f"a < b AND a_root != b_root AND {_possible(percent, 'a', 'b')}").select("a", "b").distinct()
    pairs = written(pairs.join(stars, ["a", "b"], "left_anti"))
    if not pairs.isEmpty():
        roots = components(links.union(confirmed(pairs)), "a", "b")

    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("d1", "d2", "component_id", F.lit(True).alias("has"))
    out = rows.select("id", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("has"), F.col("component_id")).otherwise(F.col("id"))  # an empty set is alone
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
