"""Line deduplication by a segment-partition edit join.

Lines are the ``\\n``-split parts of a text that hold a word.  Two different lines link if both have
at least ``min_chars`` characters and their edit distance is at most ``max_edits`` (t).  A line is
cut into t + 1 even segments; t edits leave one of them whole, so any linked line holds that
segment at a place that its length allows.  Segments are indexed by (length, number, content), every
line probes the indexes of its own and the t shorter lengths with the substrings that can match,
and the pairs that meet, less those whose letter-pair signatures are too far apart for t edits, are
verified by a banded bit-parallel edit distance: of each pair, one bit
per diagonal of the band and number of edits, all pairs of a batch at once.

Lines of a key that more than ``crowd`` lines share (templates, near copies) are not paired by it.  They are cut into
2 t + 1 segments, and meet if they agree on all but t of them, at the places that the edits allow; t edits always leave
such a rest.  Of these pairs, a longer signature of letter pairs and letters passes those that go on.

An occurrence of a line stays if it is the first, by (id, line number), of its line and of all lines
that link to it; other occurrences are removed.  Lines are told apart by a 64-bit hash.

Defined cases: null and empty texts have no lines; lines of documents with a null id stay and remove
nothing; repeated rows of one id are the same document; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Bitmap, components, mix64, slices, written

MAX_EDITS, MIN_CHARS = 2, 20
CROWD = 64  # lines of one segment key, beyond which they are paired by the rest of their text instead
MARKS = ("pairs0", "pairs1", "pairs2", "pairs3", "letters")


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """(line number, line) of the lines that hold a word."""
    return [(n, x) for n, x in enumerate((text or "").split("\n")) if x.strip(" \t\n\r\x0b\x0c")]


def line_id(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode()) - (1 << 63)


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64


def _segment(size: np.ndarray, number: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of one of the t + 1 even segments of lines of these sizes."""
    least, longer = np.divmod(size, t + 1)
    return number * least + np.maximum(number - (t + 1 - longer), 0), least + (number > t - longer)


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2 ** bits of each."""
    return tuple(np.cumprod(np.append(np.uint64(1), np.full((1 << bits) - 1, b, np.uint64))) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def _mixed_codes(lines: list[str]) -> np.ndarray:
    """A 64-bit hash of every character of the lines' concatenation, looked up by character."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
    return mix64(np.arange(1, int(codes.max(initial=0)) + 2, dtype=np.uint64))[codes]


def segment_keys(lines: list[str], t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the line each belongs to, and whether it is an index key, of one of the line's own segments; every
    key is a probe, of a substring that may be a segment of a line at most t shorter.  Contents are polynomial
    hashes modulo 2 ** 64, taken from running sums over all lines at once; two contents of one hash only make a
    pair to verify."""
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.cumsum(size) - size
    mixed = _mixed_codes(lines)
    power, back = _powers(max(20, len(mixed).bit_length()))
    total = np.zeros(len(mixed) + 1, np.uint64)
    np.cumsum(mixed * power[: len(mixed)], out=total[1:])
    keys, rows, own = [], [], []
    for gap in range(t + 1):
        length = size - gap
        for i in range(t + 1):
            a, n = _segment(np.maximum(length, 0), i, t)
            salt = mix64((length * 64 + i).astype(np.uint64))
            low = np.maximum(np.maximum(a - i, a + gap - (t - i)), 0)
            high = np.minimum(np.minimum(a + i, a + gap + (t - i)), size - n)
            row, at = np.flatnonzero((low <= high) & (length >= 0)), 0
            while len(row):
                p = start[row] + low[row] + at
                content = (total[p + n[row]] - total[p]) * back[p]
                keys.append(mix64(content ^ salt[row]))
                rows.append(row)
                own.append((low[row] + at == a[row]) & (gap == 0))
                at += 1
                row = row[low[row] + at <= high[row]]
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate(keys).view(np.int64), np.concatenate(rows), np.concatenate(own)


def signatures(lines: list[str]) -> np.ndarray:
    """64 bits per line: the parities of its numbers of letter pairs, dealt to 64 places by hash.  An edit takes
    away and adds four pairs at most, so t edits leave the signatures of two lines 4 * t or fewer bits apart."""
    if not lines:
        return np.empty(0, np.int64)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.cumsum(size) - size
    pairs = _mixed_codes(lines) * np.uint64(_BASE)
    pairs[:-1] += pairs[1:] >> np.uint64(7)
    bits = np.uint64(1) << (pairs >> np.uint64(58))
    bits[start + size - 1] = 0  # the last letter's pair would reach into the next line
    return np.bitwise_xor.reduceat(bits, start).view(np.int64)


def cut_keys(lines: list[str], t: int, cuts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``segment_keys``, but of all that is left when t of ``cuts`` even segments are taken out: t edits lie in t
    segments at most, and in a line of t linked ones the rest stands whole, moved by the edits before it."""
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.cumsum(size) - size
    mixed = _mixed_codes(lines)
    power, back = _powers(max(20, len(mixed).bit_length()))
    total = np.zeros(len(mixed) + 1, np.uint64)
    np.cumsum(mixed * power[: len(mixed)], out=total[1:])
    keys, rows, own = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
    for gap in range(t + 1):
        length = size - gap
        ends = [np.zeros_like(size), *(a + n for a, n in (_segment(np.maximum(length, 0), i, cuts - 1) for i in range(cuts)))]
        for number, out in enumerate(combinations(range(cuts), t)):
            runs = [(a, b) for a, b in zip((0, *(i + 1 for i in out)), (*out, cuts), strict=True)]
            moves = {tuple(sum(steps[:r]) if a < b else 0 for r, (a, b) in enumerate(runs)) for steps in product((-1, 0, 1), repeat=t) if sum(steps) == gap}
            salt = mix64((length * 4096 + number).astype(np.uint64))
            for by in sorted(moves):
                fits = length >= 0
                for (a, b), move in zip(runs, by, strict=True):
                    fits = fits & (ends[a] + move >= 0) & (ends[b] + move <= size)
                row = np.flatnonzero(fits)
                key = salt[row]
                for (a, b), move in zip(runs, by, strict=True):
                    if a < b:
                        x, y = start[row] + ends[a][row] + move, start[row] + ends[b][row] + move
                        key = mix64(key ^ ((total[y] - total[x]) * back[x]))
                keys.append(key)
                rows.append(row)
                own.append(np.full(len(row), gap == 0 and not any(by)))
    return np.concatenate(keys).view(np.int64), np.concatenate(rows), np.concatenate(own)


def wide_signatures(lines: list[str]) -> np.ndarray:
    """Five numbers per line: parities of its numbers of letter pairs, dealt to 256 places, and of its letters, dealt
    to 64.  Of two lines, t edits leave the pairs' 4 * t or fewer bits apart and the letters' 2 * t."""
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    if not len(size):
        return np.empty((0, 5), np.int64)
    start = np.cumsum(size) - size
    mixed = _mixed_codes(lines)
    pairs = mixed * np.uint64(_BASE)
    pairs[:-1] += pairs[1:] >> np.uint64(7)
    pairs = mix64(pairs)
    bits = np.uint64(1) << (pairs >> np.uint64(58))
    bits[start + size - 1] = 0  # as in ``signatures``
    words = [np.where(pairs & np.uint64(3) == i, bits, np.uint64(0)) for i in range(4)] + [np.uint64(1) << (mixed >> np.uint64(58))]
    return np.stack([np.bitwise_xor.reduceat(w, start) for w in words], 1).view(np.int64)


def index_keys(line: str, t: int) -> list[int]:
    keys, _, own = segment_keys([line], t)
    return keys[own].tolist()


def probe_keys(line: str, t: int) -> set[int]:
    return set(segment_keys([line], t)[0].tolist())


def within(left: list[str], right: list[str], t: int) -> np.ndarray:
    """Which pairs have an edit distance of at most t."""
    out = np.zeros(len(left), bool)
    order = np.argsort([max(len(a), len(b)) for a, b in zip(left, right, strict=True)], kind="stable")
    start = 0
    while start < len(order):
        longest, end = 1, start
        while end < len(order) and (end - start + 1) * max(len(left[order[end]]), len(right[order[end]]), 1) <= 1 << 20 or end == start:
            longest = max(longest, len(left[order[end]]), len(right[order[end]]))
            end += 1
        rows = order[start:end]
        a, b = (np.full((len(rows), longest + 2 * t + 1), pad, np.int32) for pad in (-1, -2))
        for grid, side, first in ((a, left, t), (b, right, 0)):
            part = [side[i] for i in rows.tolist()]
            n = np.fromiter(map(len, part), np.int64, len(part))
            r = np.repeat(np.arange(len(part)), n)
            grid[r, first + np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)] = np.frombuffer("".join(part).encode("utf-32-le"), "<i4")
        la, lb = (np.array([len(x[i]) for i in rows], np.int64) for x in (left, right))
        band = np.uint32((1 << (2 * t + 1)) - 1)
        # bit k of state e: a prefix of ``left`` that is k - t longer than that of ``right`` is e edits away at most
        state = np.zeros((t + 1, len(rows)), np.uint32)
        for e in range(t + 1):
            state[e] = sum(1 << (t + d) for d in range(e + 1))
        goal = np.where(np.abs(la - lb) <= t, la - lb + t, 0).astype(np.uint32)
        for j in range(int(lb.max(initial=0))):
            same = np.zeros(len(rows), np.uint32)
            for k in range(2 * t + 1):
                same |= (a[:, j + k] == b[:, j]).astype(np.uint32) << np.uint32(k)
            new = state & same
            for e in range(1, t + 1):
                new[e] |= state[e - 1] | (state[e - 1] >> np.uint32(1)) | ((new[e - 1] << np.uint32(1)) & band)
            state = np.where(lb > j, new, state)
            if not state[t].any():
                break
        out[rows] = (np.abs(la - lb) <= t) & ((state[t] >> goal) & 1 == 1)
        start = end
    return out


def _several(batches):
    """Of rows sorted by (k, line), own last, those of keys that different lines share.  Of a key that goes on in the next
    batch, either two lines are known, and its rows pass, or two rows at most (of one line) wait."""
    wait, passing = None, None
    for b in batches:
        if not b.num_rows:
            continue
        names = b.schema.names
        cols = [b.column(c).to_numpy(zero_copy_only=False) for c in names]
        if wait is not None:
            cols = [np.concatenate((x, y)) for x, y in zip(wait, cols, strict=True)]
        k, line, own = cols[0], cols[1], cols[-1]
        first = np.append(0, np.flatnonzero(k[1:] != k[:-1]) + 1)
        ends = np.append(first[1:], len(k))
        several = line[first] != line[ends - 1]
        several[0] |= passing is not None and k[0] == passing
        keep = np.repeat(several, ends - first)
        wait, passing = None, k[-1] if several[-1] else None
        if not several[-1]:
            last = own[first[-1] :]
            rows = first[-1] + np.array([i for i in {int(last.argmax()), int(last.argmin())}])
            wait = [x[rows] for x in cols]
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in cols], names)


def linked_lines(docs: DataFrame, t: int, min_chars: int, crowd: int = CROWD) -> DataFrame:
    """Links (a, b), a < b, between line hashes.  ``docs`` has id and text."""

    def keys(batches):
        for b in slices(batches, "text", 4 << 20):
            lines = list({x for text in b.column("text").to_pylist() for _, x in lines_of(text) if len(x) >= min_chars})
            ids = np.fromiter(map(line_id, lines), np.int64, len(lines))
            found, rows, own = segment_keys(lines, t)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(ids[rows]), pa.array(signatures(lines)[rows]), pa.array(own)], ["k", "line", "sign", "own"])

    def shared(dealt: DataFrame) -> DataFrame:
        dealt = dealt.repartition(F.col("k")).sortWithinPartitions("k", "line")
        rows = dealt.mapInArrow(_several, dealt.schema)
        marks = [c for c in rows.columns if c not in ("k", "line", "own")]
        return written(rows.groupBy("k", "line").agg(*(F.first(c).alias(c) for c in marks), F.max("own").alias("own")))

    def met(rows: DataFrame, near: str) -> DataFrame:
        other = rows.select("k", *(F.col(c).alias(f"other_{c}") for c in rows.columns if c not in ("k", "own")))
        pairs = rows.where("own").join(other, "k").where(f"line != other_line AND {near}")
        return pairs.select(F.least("line", "other_line").alias("a"), F.greatest("line", "other_line").alias("b")).distinct()

    rows = shared(docs.mapInArrow(keys, "k long, line long, sign long, own boolean"))
    crowded = written(rows.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("k"))
    pairs = written(met(rows.join(crowded, "k", "left_anti"), f"bit_count(sign ^ other_sign) <= {4 * t}"))
    many = written(rows.join(crowded, "k", "left_semi").select("line").distinct())
    wanted = written(pairs.select(F.col("a").alias("line")).union(pairs.select("b")).union(many).distinct())
    held = Bitmap(wanted, "line")

    def contents(batches):
        for b in slices(batches, "text", 4 << 20):
            lines = list({x for text in b.column("text").to_pylist() for _, x in lines_of(text) if len(x) >= min_chars})
            ids = np.fromiter(map(line_id, lines), np.int64, len(lines))
            hit = np.flatnonzero(held.may_hold(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array([lines[i] for i in hit.tolist()], pa.string())], ["line", "content"])

    found = docs.mapInArrow(contents, "line long, content string").join(wanted, "line", "left_semi")
    known = written(found.groupBy("line").agg(F.first("content").alias("content")))

    def cut(batches):
        for b in slices(batches, "content", 1 << 20):
            lines, ids = b.column("content").to_pylist(), b.column("line").to_numpy()
            found, rows, own = cut_keys(lines, t, 2 * t + 1)
            marks = [pa.array(m[rows]) for m in wide_signatures(lines).T]
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(ids[rows]), *marks, pa.array(own)], ["k", "line", *MARKS, "own"])

    if not many.isEmpty():
        marks = ", ".join(f"{m} long" for m in MARKS)
        apart = [f"bit_count({m} ^ other_{m})" for m in MARKS]
        rows = shared(known.join(many, "line", "left_semi").mapInArrow(cut, f"k long, line long, {marks}, own boolean"))
        pairs = written(pairs.union(met(rows, f"{' + '.join(apart[:-1])} <= {4 * t} AND {apart[-1]} <= {2 * t}")).distinct())
    both = pairs.join(known.toDF("a", "left"), "a").join(known.toDF("b", "right"), "b")

    def verify(batches):
        for batch in batches:
            for b in slices([batch], "left", 4 << 20):
                yield b.filter(pa.array(within(b.column("left").to_pylist(), b.column("right").to_pylist(), t))).select(["a", "b"])

    return both.mapInArrow(verify, "a long, b long")


def find_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, crowd: int = CROWD) -> DataFrame:
    """One row per document: id, n_lines, removed (line numbers, ascending), n_links (of its lines to
    other lines) and class_id, the smallest id whose lines are in a class with one of its lines."""
    plain = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def occurrences(batches):
        for b in slices(batches, "text", 8 << 20):
            rows = [(k, i, n, line_id(x) if n >= 0 else None) for k, i, t in zip(*(b.column(c).to_pylist() for c in ("key", "id", "text")), strict=True)
                    for n, x in (lines_of(t) or [(-1, "")])]
            kinds = zip(("key", "id", "n", "line"), (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)], ["key", "id", "n", "line"])

    found = written(plain.mapInArrow(occurrences, "key long, id long, n int, line long"))
    links = written(linked_lines(plain.where("id IS NOT NULL"), max_edits, min_chars, crowd))
    first = found.where("line IS NOT NULL AND id IS NOT NULL").groupBy("line").agg(F.min(F.struct("id", "n")).alias("first"))
    ends = links.union(links.select("b", "a")).toDF("line", "other")
    other = ends.join(first.toDF("other", "there"), "other").groupBy("line").agg(F.min("there").alias("there"), F.count("*").alias("links"))
    roots = components(links, "a", "b").toDF("line", "root")
    info = first.join(other, "line", "left").join(roots, "line", "left").withColumn("root", F.coalesce("root", "line"))
    info = info.withColumn("stays", F.col("there").isNull() | (F.col("first") < F.col("there")))
    classes = info.groupBy("root").agg(F.min("first.id").alias("class"))
    info = info.join(classes, "root").select("line", "first", "stays", "class", F.coalesce("links", F.lit(0)).alias("links"))
    rows = found.join(info, "line", "left")
    gone = F.col("line").isNotNull() & F.col("id").isNotNull() & ~(F.col("stays") & (F.struct("id", "n") == F.col("first")))
    own = F.when(F.col("id").isNotNull(), F.col("class"))
    by_doc = rows.groupBy("key").agg(
        F.max("id").alias("id"), F.count("line").alias("n_lines"), F.sort_array(F.collect_list(F.when(gone, F.col("n")))).alias("removed"),
        F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("links"))), F.lit(0)).alias("n_links"), F.coalesce(F.min(own), F.max("id")).alias("class_id"),
    )  # fmt: skip  # a document's line numbers: bounded by its text
    return by_doc.select(F.col("id").alias(id_col), "n_lines", "removed", "n_links", "class_id")
