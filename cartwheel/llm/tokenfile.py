"""Token ids in a word-aligned Simple-8b file format.

Documents are dealt to shards by ranges of their id, encoded in ascending id order, an end id
after each, and written as Parquet rows of one self-contained *group* each (whole documents,
about ``group_ids`` ids).  A group's payload holds the documents' ids and lengths and the token ids
in 64-bit words: four selector bits name how many ids of how many bits the other sixty hold.
Ids of 60 bits or more are escapes: a marker word, the value in a list of its own.  Every
``BLOCK`` ids start a new word; the offsets of these blocks among the words and escapes let a reader
decode any block, and all words of one selector at once.

Defined cases: null and empty texts hold only the end id; null ids come first; repeated rows are
written each; an empty table writes an empty table.  Ids must be BIGINT (or cast to it).
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import slices

BLOCK = 1024
MAGIC = b"S8W1"
# Fixed values of the format: ids per word and bits per id, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = (1 << 60) - 1
FILE_SCHEMA = "shard int, group_no long, start long, n_ids long, payload binary"


# -- words ------------------------------------------------------------------------------------


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """uint64 ids -> words, word offset of each block, escaped values, escape offset of each block."""
    n = len(ids)
    starts = np.arange(0, n, BLOCK)
    if not n:
        none = np.empty(0, np.uint64)
        return none, np.zeros(1, np.uint32), none, np.zeros(1, np.uint32)
    escaped = ids >= np.uint64(ESCAPE)
    # A row per block, zeros after its ids: what a word would take beyond a block's end fits any selector.
    width, full = BLOCK + int(COUNTS[0]), n // BLOCK
    grid = np.zeros((len(starts), width), np.uint64)
    grid[:full, :BLOCK] = ids[: full * BLOCK].reshape(full, BLOCK)
    grid[full:, : n - full * BLOCK] = ids[full * BLOCK :]
    v = np.minimum(grid.ravel(), np.uint64(ESCAPE))
    largest, need = int(v.max()), np.zeros(len(v), np.uint8)  # the first selector of enough bits, then the largest of a run's
    for s in range(15):
        if largest >= 1 << int(BITS[s]):
            need += v >= np.uint64(1 << int(BITS[s]))
    chosen, held = np.full(len(v), 15, np.uint8), 1
    for s in range(15, -1, -1):
        more = int(COUNTS[s]) - held  # at most ``held``, so two runs cover the longer one
        if more:
            need[:-more] = np.maximum(need[:-more], need[more:])
            held += more
        np.copyto(chosen, np.uint8(s), where=need <= s)
    rows = np.arange(len(starts)) * width
    first, pos, end = [], rows, rows + np.diff(np.append(starts, n))
    while len(pos):
        first.append(pos)
        pos = pos + COUNTS[chosen[pos]]
        open_ = pos < end
        pos, end = pos[open_], end[open_]
    first = np.sort(np.concatenate(first))
    kind = chosen[first]
    words = kind.astype(np.uint64)
    for s in range(2, 16):
        at = np.flatnonzero(kind == s)
        if len(at):
            part, begin = words[at], first[at]
            for j in range(int(COUNTS[s])):
                part |= v[begin + j] << np.uint64(4 + int(BITS[s]) * j)
            words[at] = part
    word_at = np.append(np.searchsorted(first, rows), len(first)).astype(np.uint32)
    esc_at = np.concatenate(([0], np.add.reduceat(escaped, starts).cumsum())).astype(np.uint32)
    return words, word_at, ids[escaped], esc_at


def unpack(words: np.ndarray, word_at: np.ndarray, n: int, escapes: np.ndarray) -> np.ndarray:
    """The n ids of ``words``, whose blocks start at ``word_at``."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    kind = (words & np.uint64(15)).astype(np.int64)
    held = COUNTS[kind]
    sizes = np.diff(np.append(np.arange(0, n, BLOCK), n))
    held[word_at[1:].astype(np.int64) - 1] -= np.add.reduceat(held, word_at[:-1].astype(np.int64)) - sizes
    first = np.cumsum(held) - held
    for s in range(2, 16):
        rows = np.flatnonzero(kind == s)
        bits, mask = int(BITS[s]), np.uint64((1 << int(BITS[s])) - 1)
        for j in range(int(COUNTS[s])):
            r = rows[held[rows] > j]
            out[first[r] + j] = (words[r] >> np.uint64(4 + bits * j)) & mask
    out[out == np.uint64(ESCAPE)] = escapes
    return out


def to_payload(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, word_at, escapes, esc_at = pack(ids)
    head = struct.pack("<4sIQIII", MAGIC, len(doc_ids), len(ids), len(words), len(word_at), len(escapes))
    null = np.array([x is None for x in doc_ids], np.uint8)
    known = np.array([0 if x is None else x for x in doc_ids], np.int64)
    return b"".join([head, *(a.tobytes() for a in (known, null, lengths.astype("<u8"), word_at, esc_at, words, escapes))])


class Payload:
    """A group's parts; ids decode as a whole or by block."""

    def __init__(self, data: bytes):
        magic, docs, self.n_ids, n_words, n_at, n_esc = struct.unpack_from("<4sIQIII", data)
        if magic != MAGIC:
            raise ValueError("not a token group")
        at = struct.calcsize("<4sIQIII")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            a = np.frombuffer(data, kind, n, at)
            at += a.nbytes
            return a

        ids, null = take("<i8", docs), take("<u1", docs)
        self.doc_ids = [None if z else int(x) for x, z in zip(ids.tolist(), null.tolist(), strict=True)]
        self.lengths = take("<u8", docs).astype(np.int64)
        self.word_at, self.esc_at = take("<u4", n_at), take("<u4", n_at)
        self.words, self.escapes = take("<u8", n_words), take("<u8", n_esc)

    def ids(self) -> np.ndarray:
        return unpack(self.words, self.word_at, self.n_ids, self.escapes)

    def block(self, k: int) -> np.ndarray:
        a, z = self.word_at[k : k + 2]
        n = min(BLOCK, self.n_ids - k * BLOCK)
        return unpack(self.words[a:z], np.array([0, z - a]), n, self.escapes[self.esc_at[k] : self.esc_at[k + 1]])


# -- tokens -----------------------------------------------------------------------------------

# Two white-space characters in a row, one of them a space: such texts are encoded whole.
_ODD = "[\\s\\v\\x1c-\\x1f\\x{85}\\p{Z}] | [\\s\\v\\x1c-\\x1f\\x{85}\\p{Z}]"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    spaced = np.zeros(t.get_vocab_size(with_added_tokens=True), bool)
    for token, i in t.get_vocab(with_added_tokens=True).items():
        spaced[i] = token.startswith("Ġ")  # the byte-level alphabet's space
    return t, spaced


JOINED = 50  # pieces a text: the tokenizer slows down on long ones


class Pieces:
    """The ids of pieces of text: one pool, and where each piece's begin and how many they are."""

    def __init__(self, t, spaced: np.ndarray):
        self.t, self.spaced = t, spaced
        self.pool, self.begin, self.length = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, pieces: list[str], leading: bool) -> None:
        """Append pieces.  With ``leading`` every piece starts with its only space, which starts a token, so
        pieces that do not end in white space are encoded together and cut at such tokens."""
        begin, length, done = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), np.zeros(len(pieces), bool)
        joint = [i for i, p in enumerate(pieces) if len(p) > 1 and not p[1].isspace() and not p[-1].isspace()] if leading else []
        chunks, size = [self.pool], len(self.pool)
        for a in range(0, len(joint), 20_000):
            part = joint[a : a + 20_000]
            parts = ["".join([pieces[i] for i in part[k : k + JOINED]]) for k in range(0, len(part), JOINED)]
            found = [e.ids for e in self.t.encode_batch_fast(parts, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(found), np.uint64, sum(map(len, found)))
            at = np.flatnonzero(self.spaced[ids.astype(np.int64)])
            # one space in every piece, so as many starts as pieces, and one at each text's first id, put every cut right
            if len(at) == len(part) and all(self.spaced[x[0]] for x in found):
                begin[part], length[part], done[part] = size + at, np.diff(np.append(at, len(ids))), True
                chunks.append(ids)
                size += len(ids)
        rest = np.flatnonzero(~done).tolist()
        for i, e in zip(rest, self.t.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            begin[i], length[i] = size, len(e.ids)
            chunks.append(np.array(e.ids, np.uint64))
            size += length[i]
        self.pool = np.concatenate(chunks)
        self.begin, self.length = np.concatenate((self.begin, begin)), np.concatenate((self.length, length))


MAX_PIECES = 1_000_000  # space-led pieces that a worker remembers from slice to slice
_LED: dict[str, tuple[Pieces, dict[str, int]]] = {}


def _led(path: str, names: list[str]) -> tuple[Pieces, np.ndarray]:
    """The worker's pieces, and which of them each name, led by a space, is."""
    if path not in _LED or len(_LED[path][1]) > MAX_PIECES:
        _LED[path] = Pieces(*tokenizer(path)), {}
    known, at = _LED[path]
    rows = np.fromiter((at.get(x, -1) for x in names), np.int64, len(names))
    new = [names[i] for i in np.flatnonzero(rows < 0).tolist()]
    if new:
        rows[rows < 0] = np.arange(len(at), len(at) + len(new))
        at.update(zip(new, range(len(at), len(at) + len(new)), strict=True))
        known.add([" " + x for x in new], True)
    return known, rows


def encode(column: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids per text) of a string array, an end id after each text.

    A byte-level tokenizer never joins text across the boundary before a single space, so each
    distinct space-led piece of the batch is encoded once and looked up."""
    t, spaced = tokenizer(path)
    column = pc.fill_null(column, "")
    odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False)
    # A text with odd spacing is one piece: as if it held no space.
    lists = pc.split_pattern(column.filter(pa.array(~odd)), " ")
    coded = lists.flatten().dictionary_encode()
    names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    per = np.zeros(len(column), np.int64)
    per[~odd] = pc.list_value_length(lists).to_numpy()
    whole = column.filter(pa.array(odd)).to_pylist()
    per[odd] = 1
    first = np.cumsum(per) - per
    kind = np.ones(int(per.sum()), bool)  # led by a space
    kind[first] = False
    table = np.empty(len(kind), np.int64)
    is_odd = np.repeat(odd, per)
    table[~is_odd] = codes
    led = kind & ~is_odd
    led_codes = np.unique(table[led])
    bare_codes = np.unique(table[~kind & ~is_odd])
    known, led_rows = _led(path, [names[i] for i in led_codes.tolist()])
    own = Pieces(t, spaced)
    own.add([names[i] for i in bare_codes.tolist()] + whole, False)
    pool = np.concatenate((known.pool, own.pool, np.array([end_id], np.uint64)))
    begin = np.concatenate((known.begin, own.begin + len(known.pool), [len(pool) - 1]))
    length = np.concatenate((known.length, own.length, [1]))
    n_led = len(known.length)
    where = np.full((2, max(1, len(names))), -1, np.int64)
    where[1, led_codes] = led_rows
    where[0, bare_codes] = n_led + np.arange(len(bare_codes))
    rows = np.empty(len(kind), np.int64)
    rows[~is_odd] = where[kind[~is_odd].astype(np.int64), table[~is_odd]]
    rows[is_odd] = n_led + len(bare_codes) + np.arange(len(whole))
    rows = np.insert(rows, first + per, len(length) - 1)
    n = length[rows]
    ids = pool[np.repeat(begin[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    return ids, np.add.reduceat(n, first + np.arange(len(column))) if len(column) else per


# -- files ------------------------------------------------------------------------------------


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text: str = "text",
                 shards: int | None = None, group_ids: int = 1 << 19) -> None:
    """Write the token files of ``docs`` to ``path`` (a folder for Spark's Parquet writer)."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    plain = plain.repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def run(batches):
        shard, group, start = TaskContext.get().partitionId(), 0, 0
        for b in slices(batches, "text", 16 << 20):
            ids, n = encode(b.column("text"), tokenizer_path, end_id)
            doc_ids, ends = b.column("id").to_pylist(), np.cumsum(n)
            a = 0
            while a < len(n):
                base = int(ends[a - 1]) if a else 0
                z = max(a + 1, int(np.searchsorted(ends, base + group_ids, side="right")))
                part = ids[base : int(ends[z - 1])]
                row = [shard, group, start, len(part), to_payload(doc_ids[a:z], n[a:z], part)]
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, types, strict=True)], ["shard", "group_no", "start", "n_ids", "payload"])
                a, group, start = z, group + 1, start + len(part)

    plain.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """A row per document of the files: doc_id, start (ids of all documents before), n_tokens, and
    ``ids`` or, with ``digest``, their crc32 as little-endian unsigned 32-bit integers."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # a row per shard
    base, bases = 0, []
    for r in totals:
        bases.append((r["shard"], base))
        base += r["n"]
    placed = files.join(F.broadcast(spark.createDataFrame(bases, "shard int, base long")), "shard")
    placed = placed.select((F.col("base") + F.col("start")).alias("start"), "payload")
    last = "ids_crc32 long" if digest else "ids array<long>"

    def run(batches):
        for b in batches:
            for start, data in zip(b.column("start").to_pylist(), b.column("payload").to_pylist(), strict=True):
                p = Payload(data)
                ids, n = p.ids(), p.lengths
                ends = np.cumsum(n)
                if digest:
                    raw = ids.astype("<u4").tobytes()
                    found = pa.array([zlib.crc32(raw[4 * (z - k) : 4 * z]) for z, k in zip(ends.tolist(), n.tolist(), strict=True)], pa.int64())
                else:
                    found = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.view(np.int64)))
                cols = [pa.array(p.doc_ids, pa.int64()), pa.array(start + ends - n), pa.array(n), found]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", last.split()[0]])

    return placed.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")
