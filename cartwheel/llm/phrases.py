"""Phrase collocations, counted level by level with broadcast double-array tries.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words ``[^\\x20\\x09]+``.
They are encoded once, per slice of texts of one language, as positions in the slice's own list of
words.  The slices' lists are dealt by a hash of the word; each hash range adds up the counts, numbers the words that
occur ``min_count`` times in their language and sends the numbers back to the slices: one exchange, no join.  A phrase can only reach
``min_count`` if all its parts do (Apriori), so phrases of k words are counted as follows:

* candidates of two words are pairs of frequent words, those of k + 1 words stretches of the texts whose first
  and last k words are both frequent, and of these the ones whose counts, summed over all tasks, can
  reach ``min_count`` (all Apriori joins would be far too many for a broadcast);
* the candidates are dealt into groups of about ``max_nodes`` by a hash of all words but the last; each group
  is a double-array trie, broadcast in turn, so that what is broadcast does not grow with the texts;
* numpy advances the states of all positions of a slice at once, word by word, and bincounts the
  accepting states; the tasks' counts are summed by Spark in hash ranges.

Scores use decimals, so products may pass 64 bits.  Defined cases: null text is empty; null language
is ``und``; documents without words give nothing; repeated rows count again; an empty table, or one
without frequent phrases, gives an empty result.
"""

from __future__ import annotations

import functools
import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import mix64, slices, written

LONGEST = 5
SLICE_BYTES = 8 << 20  # of texts of one language
HELD_BYTES = 4 * SLICE_BYTES  # of texts of all languages that wait in a task
MAX_NODES = 1 << 19  # of a broadcast trie, about; under 50 bytes each
RANGE_ENTRIES = 2_000_000
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_CODED = "lang string, vocab array<string>, counts array<long>, codes binary"
_SUMS = "part int, keys binary, counts binary"
_DEALT = "part int, row long, lang string, words binary, pos binary, counts binary"
_NUMBERED = "id long, lang string, word string, n long, row long, pos binary, ids binary"


def squeezed(x: np.ndarray, ascending: bool = False) -> bytes:
    """64-bit integers, as differences if ``ascending``, byte plane by byte plane, compressed."""
    x = np.diff(x, prepend=0) if ascending else x
    return zstandard.compress(np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unsqueezed(blob: bytes, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    x = np.ascontiguousarray(planes.T).view(np.int64).ravel()
    return np.cumsum(x) if ascending else x


def ranges_of(hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the entries by hash range, ranges that occur, their bounds in that order)."""
    of = ((mix64(hashes) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    found, first = np.unique(of[order], return_index=True)
    return order, found, np.append(first, len(order))


# -- texts as codes -----------------------------------------------------------------------------


def encode(blob: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, their counts, per word its place among them, -1 between pieces) of texts joined by newlines."""
    spaced = blob.translate(_TABLE).replace(b"\n", b" \n ")
    tokens = pc.split_pattern(pa.array([spaced], pa.binary()), b" ").values
    coded = tokens.filter(pc.greater(pc.binary_length(tokens), 0)).dictionary_encode()
    codes, names = coded.indices.to_numpy(), coded.dictionary
    is_cut = pc.equal(names, b"\n").to_numpy(zero_copy_only=False)
    place = np.where(is_cut, -1, np.cumsum(~is_cut) - 1).astype(np.int32)
    codes = place[codes] if len(codes) else np.empty(0, np.int32)
    names = names.filter(pa.array(~is_cut)).cast(pa.string())
    return names, np.bincount(codes[codes >= 0], minlength=len(names)), codes


def coded_texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """A row per slice and language: row, lang, vocab, counts, codes."""
    plain = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))

    def coded(name: str, parts: list[bytes]):
        vocab, counts, codes = encode(b"\n".join(parts))
        if len(vocab):
            lists = [pa.array([name]), pa.array([vocab.to_pylist()], pa.list_(pa.string())), pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([codes.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(lists, ["lang", "vocab", "counts", "codes"])

    def run(batches):
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for b in slices(batches, "text", SLICE_BYTES):
            for name, t in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if t:
                    held.setdefault(name, []).append(t)
                    sizes[name] = sizes.get(name, 0) + len(t)
                    if sizes[name] >= SLICE_BYTES:
                        sizes.pop(name)
                        yield from coded(name, held.pop(name))
            while sum(sizes.values()) > HELD_BYTES:
                name = max(sizes, key=sizes.get)
                sizes.pop(name)
                yield from coded(name, held.pop(name))
        for name, parts in held.items():
            yield from coded(name, parts)

    return written(plain.mapInArrow(run, _CODED).withColumn("row", F.monotonically_increasing_id()))


def numbered_words(coded: DataFrame, ranges: int, min_count: int) -> DataFrame:
    """The words that occur ``min_count`` times in their language (id, lang, word, n) and, in rows of their own, the
    places of such words in the list of each slice (row, pos, ids)."""

    def deal(batches):
        for b in batches:
            for i in range(b.num_rows):
                words, counts = b.column("vocab")[i].values, b.column("counts")[i].values.to_numpy()
                order, found, cut = ranges_of(pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False), ranges)
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), words.take(pa.array(order))), "\n").to_pylist()
                spans = [order[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
                columns = [
                    pa.array(found, pa.int32()), pa.array([b.column("row")[i].as_py()] * len(found), pa.int64()), pa.array([b.column("lang")[i].as_py()] * len(found)),
                    pa.array([zstandard.compress(t.encode(), 1) for t in texts], pa.binary()), pa.array([squeezed(at, True) for at in spans], pa.binary()),
                    pa.array([squeezed(counts[at]) for at in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "row", "lang", "words", "pos", "counts"])

    def merge(t: pa.Table) -> pa.Table:
        part, first, out = t.column("part")[0].as_py(), 0, []
        for lang in pc.unique(t.column("lang")).to_pylist():
            of = t.filter(pc.equal(t.column("lang"), lang))
            blob = b"\n".join(zstandard.decompress(x) for x in of.column("words").to_pylist())
            words = pc.split_pattern(pa.array([blob], pa.binary()), b"\n").values.dictionary_encode()
            codes, names = words.indices.to_numpy(), words.dictionary.cast(pa.string())
            sums = np.zeros(len(names), np.int64)
            np.add.at(sums, codes, np.concatenate([unsqueezed(x) for x in of.column("counts").to_pylist()]))
            keep = np.flatnonzero(sums >= min_count)
            ids = np.full(len(names), -1, np.int64)
            ids[keep] = (first + np.arange(len(keep))) * ranges + part
            first += len(keep)
            out.append(pa.table([pa.array(ids[keep]), pa.array([lang] * len(keep), pa.string()), names.take(pa.array(keep)), pa.array(sums[keep])], ["id", "lang", "word", "n"]))
            rows, at, end = [], 0, 0
            for row, blob in zip(of.column("row").to_pylist(), of.column("pos").to_pylist(), strict=True):
                pos = unsqueezed(blob, True)
                at, end = end, end + len(pos)
                on = ids[codes[at:end]] >= 0
                if on.any():
                    rows.append((row, squeezed(pos[on], True), squeezed(ids[codes[at:end]][on])))
            row, pos, num = zip(*rows, strict=True) if rows else ((), (), ())
            out.append(pa.table([pa.array(row, pa.int64()), pa.array(pos, pa.binary()), pa.array(num, pa.binary())], ["row", "pos", "ids"]))
        empty = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("row", pa.int64()), ("pos", pa.binary()), ("ids", pa.binary())])
        return pa.concat_tables([empty.empty_table(), *out], promote_options="default")

    return written(coded.select("row", "lang", "vocab", "counts").mapInArrow(deal, _DEALT).groupBy("part").applyInArrow(merge, _NUMBERED))


# -- double-array tries -------------------------------------------------------------------------


class Trie:
    """Double array over rows of word numbers.  A node of many children has several bases, one for each value of
    its children's low bits: from state s, word w takes row ``r = block[s] + (w & mask[s])`` and leads to
    ``base[r] + w`` if ``check`` there is r.  Rows of few children fill the array densely.  Words are first mapped to
    their place in ``words``, the sorted words of the phrases; at a phrase's last state ``block`` is its row."""

    def __init__(self, phrases: np.ndarray):
        """``phrases``: distinct rows, sorted, each of k word numbers."""
        n, k = phrases.shape
        self.size, self.length = n, k
        self.words = np.unique(phrases)
        width = max(1, len(self.words))
        codes = np.searchsorted(self.words, phrases).astype(np.int32)
        # Nodes level by level: parent and word of each, in the order of the sorted rows.
        parents, letters, last = [], [], np.zeros(n, np.int32)
        nodes = 1
        for i in range(k):
            new = np.ones(n, bool)
            new[1:] = (last[1:] != last[:-1]) | (codes[1:, i] != codes[:-1, i])
            parents.append(last[new])
            letters.append(codes[new, i])
            last = (nodes - 1 + np.cumsum(new)).astype(np.int32)
            nodes += int(new.sum())
        parent, letter = np.concatenate(parents), np.concatenate(letters)  # of node 1, 2, ...
        children = np.bincount(parent, minlength=nodes)
        mask = (1 << np.ceil(np.log2(np.maximum(children / 4, 1))).astype(np.int64)) - 1
        rows_of = np.where(children > 0, mask + 1, 0)
        block = np.cumsum(rows_of) - rows_of
        row = block[parent] + (letter & mask[parent])
        fan = np.bincount(row, minlength=int(rows_of.sum()))
        begin = np.cumsum(fan) - fan
        kids = letter[np.argsort(row, kind="stable")]
        room, rng = 2 * nodes, np.random.default_rng(7)
        base, used = np.zeros(len(fan), np.int64), np.zeros(room + width + 1, bool)
        used[0] = True  # the root
        # Rows of many children first.  All waiting rows of a size try a random base at once; of those that
        # claim the same free slot the first keeps it.
        for low, high in ((4096, 1 << 62), (256, 4096), (32, 256), (8, 32), (3, 8), (2, 3), (1, 2)):
            waiting, stuck = np.flatnonzero((fan >= low) & (fan < high)), 0
            while len(waiting):
                group = waiting[:1] if low >= 4096 else waiting
                at = rng.integers(1, room + 1, len(group))
                m = fan[group]
                who = np.repeat(np.arange(len(group)), m)
                inside = np.arange(len(who)) - np.repeat(np.cumsum(m) - m, m)
                slot = at[who] + kids[begin[group][who] + inside]
                _, first, back = np.unique(slot, return_index=True, return_inverse=True)
                lost = np.zeros(len(group), bool)
                lost[who[used[slot] | (first[back] != np.arange(len(slot)))]] = True
                base[group[~lost]] = at[~lost]
                used[slot[~lost[who]]] = True
                waiting = np.concatenate((group[lost], waiting[len(group) :]))
                stuck = 0 if not lost.all() else stuck + 1
                if stuck == 20:
                    used, room, stuck = np.concatenate((used, np.zeros(room, bool))), 2 * room, 0
        state = np.zeros(nodes, np.int64)  # the slot of each node
        state[1:] = base[row] + letter
        self.base, self.check = base.astype(np.int32), np.full(len(used), -1, np.int32)
        self.block, self.mask = np.zeros(len(used), np.int32), np.zeros(len(used), np.int32)
        self.block[state], self.mask[state] = block, mask
        self.check[state[1:]] = row
        self.block[state[last]] = np.arange(n)

    def rows(self, word: np.ndarray) -> np.ndarray:
        """For every position, the phrase that starts there, else -1.  ``word``: the place of each word in
        ``words``, -1 for any other or a cut."""
        at = np.flatnonzero(word >= 0)
        at = at[at + self.length <= len(word)]
        state = np.zeros(len(at), np.int32)
        for i in range(self.length):
            w = word[at + i]
            on = w >= 0
            w = np.where(on, w, 0)
            row = self.block[state] + (w & self.mask[state])
            to = self.base[row] + w
            on &= self.check[to] == row
            at, state = at[on], to[on]
        out = np.full(len(word), -1, np.int64)
        out[at] = self.block[state]
        return out


# -- counting -----------------------------------------------------------------------------------


def _packed(part: int, keys: np.ndarray, counts: np.ndarray, ranges: int):
    """Rows (part, keys, counts) of one kind, dealt by a hash of the (ascending) key; part = 2 * range + kind."""
    order, found, cut = ranges_of(keys.view(np.uint64), ranges)
    spans = [order[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
    columns = [pa.array(2 * found + part, pa.int32()), pa.array([squeezed(keys[at], True) for at in spans], pa.binary()), pa.array([squeezed(counts[at]) for at in spans], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["part", "keys", "counts"])


def _summed(parts: DataFrame, least: int) -> DataFrame:
    """(kind, key, n) with n the sum of a key's counts, at least ``least`` for kind 1."""

    def merge(t: pa.Table) -> pa.Table:
        keys = np.concatenate([unsqueezed(x, True) for x in t.column("keys").to_pylist()])
        n = np.concatenate([unsqueezed(x) for x in t.column("counts").to_pylist()])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, n = keys[first], np.add.reduceat(n, first)
        kind = t.column("part")[0].as_py() % 2
        if kind:
            keys, n = keys[n >= least], n[n >= least]
        return pa.table([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], ["kind", "key", "n"])

    return written(parts.groupBy("part").applyInArrow(merge, "kind int, key long, n long"))


def _words(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, number of each place of the vocabulary that is frequent, else -1) of a coded row."""
    codes = np.frombuffer(b.column("codes")[i].as_buffer(), np.int32)
    ids = np.full(int(codes.max(initial=0)) + 1, -1, np.int64)
    for pair in b.column("ids")[i].as_py():
        ids[unsqueezed(pair["pos"], True)] = unsqueezed(pair["ids"])
    return codes, ids


def pairs_of(coded: DataFrame, ranges: int, min_count: int) -> DataFrame:
    """(a, b): pairs of frequent words that follow each other ``min_count`` times."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                codes, ids = _words(b, i)
                word = np.where(codes >= 0, ids[codes], -1)
                on = (word[:-1] >= 0) & (word[1:] >= 0)
                key, n = np.unique((word[:-1][on] << 32) | word[1:][on], return_counts=True)
                yield from _packed(1, key, n, ranges)

    found = _summed(coded.mapInArrow(run, _SUMS), min_count)
    return found.select(F.array(F.shiftright("key", 32), F.col("key").bitwiseAND(0xFFFFFFFF)).alias("words"))


def built_tries(dealt: DataFrame) -> DataFrame:
    """(grp, key, words, trie): the phrases of every group, numbered, and one row a group with the group's trie.
    Tries are built in tasks; the driver only passes each on."""

    def build(t: pa.Table) -> pa.Table:
        lists = t.column("words").combine_chunks()
        phrases = lists.flatten().to_numpy().astype(np.int32).reshape(t.num_rows, -1)
        phrases = phrases[np.lexsort(phrases.T[::-1])]
        n, k = phrases.shape
        words = pa.ListArray.from_arrays(pa.array(np.append(np.arange(n + 1) * k, n * k), pa.int32()), pa.array(phrases.ravel(), pa.int64()))
        grp = pa.array(np.full(n + 1, t.column("grp")[0].as_py(), np.int32))
        trie = pa.array([None] * n + [pickle.dumps(Trie(phrases))], pa.binary())
        return pa.table([grp, pa.array([*range(n), None], pa.int64()), words, trie], ["grp", "key", "words", "trie"])

    return written(dealt.groupBy("grp").applyInArrow(build, "grp int, key long, words array<long>, trie binary"))


def count_group(coded: DataFrame, trie: bytes, ranges: int, both: bool, min_count: int) -> DataFrame:
    """(kind, key, n): counts of the trie's phrases (kind 0, key their row) and the longer stretches met ``min_count``
    times (kind 1, key row << 32 | next word).  With ``both`` a stretch's last words must be one of the phrases too."""
    shared = coded.sparkSession.sparkContext.broadcast(trie)

    def run(batches):
        trie = pickle.loads(shared.value)
        total = np.zeros(trie.size, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                codes, ids = _words(b, i)
                place = np.searchsorted(trie.words, ids)
                place[place == len(trie.words)] = 0
                place = np.where(trie.words[place] == ids, place, -1)
                row = trie.rows(np.where(codes >= 0, place[codes], -1))
                total += np.bincount(row[row >= 0], minlength=trie.size)
                if trie.length == LONGEST:
                    continue
                start = np.flatnonzero(row[: len(row) - trie.length] >= 0)
                after = codes[start + trie.length]
                after = np.where(after >= 0, ids[after], -1)
                on = after >= 0
                if both:
                    on &= row[start + 1] >= 0
                key, n = np.unique((row[start[on]] << 32) | after[on], return_counts=True)
                yield from _packed(1, key, n, ranges)
        key = np.flatnonzero(total)
        yield from _packed(0, key, total[key], ranges)

    found = _summed(coded.mapInArrow(run, _SUMS), min_count)
    shared.destroy()
    return found


def frequent_phrases(coded: DataFrame, words: DataFrame, total: int, min_count: int, longest: int, max_nodes: int) -> DataFrame:
    """(words, n) of all phrases of 1 to ``longest`` words that occur ``min_count`` times.  ``words``: id, n."""
    spark = coded.sparkSession
    ranges = max(1, math.ceil(total / RANGE_ENTRIES))
    out = words.select(F.array("id").alias("words"), "n")
    candidates = written(pairs_of(coded, ranges, min_count))
    heads = words.count()
    for k in range(2, longest + 1):
        size = candidates.count()
        if not size:
            break
        # Dealt by all words but the last, which are a frequent phrase: a trie's nodes are mostly its last words.
        groups = math.ceil((size + min(size, heads)) / max_nodes)
        dealt = candidates.withColumn("grp", F.expr(f"CAST(pmod(xxhash64(slice(words, 1, {k - 1})), {groups}) AS INT)"))
        built = built_tries(dealt)
        counted, longer = [], []
        for g in range(groups):
            group = built.where(F.col("grp") == g)
            data = group.where("trie IS NOT NULL").select("trie").toArrow().column("trie")
            if not len(data):
                continue
            found = count_group(coded, data[0].as_py(), ranges, groups == 1, min_count)
            named = group.where("trie IS NULL").select("key", "words")
            sums = found.where("kind = 0").select("key", "n").where(F.col("n") >= min_count)
            kept = written(named.join(sums, "key"))
            counted.append(kept.select("words", "n"))
            if k < longest:
                more = found.where("kind = 1").select(F.shiftright("key", 32).alias("key"), F.col("key").bitwiseAND(0xFFFFFFFF).alias("after"))
                longer.append(more.join(kept.select("key", "words"), "key").select(F.concat("words", F.array("after")).alias("words")))
        frequent = functools.reduce(DataFrame.union, counted)
        out = out.union(frequent)
        heads = frequent.count()
        if k < longest:
            last = frequent.select(F.col("words").alias("tail"))
            candidates = functools.reduce(DataFrame.union, longer).withColumn("tail", F.expr(f"slice(words, 2, {k})"))
            candidates = written(candidates.join(last, "tail", "left_semi").select("words"))
    return out


# -- scores -------------------------------------------------------------------------------------


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 100, longest: int = LONGEST,
                 top: int = 2000, max_nodes: int = MAX_NODES) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a: occurrences; l, r: those of the parts at the lowest-scoring cut; n: the language's words; score:
    floor(1000 * a * n / (l * r)).  A phrase inside a longer one that occurs as often is left out."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"longest: 2 to {LONGEST} words")
    coded = coded_texts(docs, text, lang)
    totals = written(coded.select("lang", F.expr("aggregate(counts, 0L, (s, x) -> s + x)").alias("n")).groupBy("lang").agg(F.sum("n").alias("total")))
    total = totals.agg(F.sum("total")).first()[0] or 0
    found = numbered_words(coded, max(1, math.ceil(total / RANGE_ENTRIES)), min_count)
    words = found.where("row IS NULL").select("id", "lang", "word", "n")
    held = found.where("row IS NOT NULL").groupBy("row").agg(F.collect_list(F.struct("pos", "ids")).alias("ids"))  # bounded by the slice
    numbers = written(coded.select("row", "codes").join(held, "row").select("codes", "ids"))
    known = written(frequent_phrases(numbers, words, total, min_count, longest, max_nodes))

    long_ = known.where("size(words) > 1")
    cuts = long_.withColumn("k", F.expr("explode(sequence(1, size(words) - 1))"))
    cuts = cuts.withColumns({"left": F.expr("slice(words, 1, k)"), "right": F.expr("slice(words, k + 1, size(words) - k)")})
    cuts = cuts.join(known.toDF("left", "l"), "left").join(known.toDF("right", "r"), "right")
    first = words.select(F.col("id").alias("head"), "lang").join(totals, "lang")
    cuts = cuts.withColumn("head", F.col("words")[0]).join(first, "head")
    wide = lambda a, b: f"CAST({a} AS DECIMAL(19, 0)) * CAST({b} AS DECIMAL(19, 0))"
    score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * CAST({wide('n', 'total')} AS DECIMAL(34, 0))) div ({wide('l', 'r')})")
    best = cuts.withColumn("score", score).groupBy("words").agg(F.min(F.struct("score", "k", "lang", "n", "l", "r", "total")).alias("x"))
    parts = "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))"
    parts = long_.where("size(words) > 2").select("n", F.explode(F.expr(parts)).alias("words"))
    inside = parts.groupBy("words").agg(F.max("n").alias("most"))
    best = best.join(inside, "words", "left").where(F.col("most").isNull() | (100 * F.col("most") < 100 * F.col("x.n")))
    spelled = best.select("words", F.posexplode("words").alias("pos", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("words").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("w"))  # at most five
    best = best.join(spelled.select("words", F.array_join(F.col("w.word"), " ").alias("phrase")), "words")
    best = best.select("x.lang", "phrase", F.col("x.n").alias("a"), "x.l", "x.r", F.col("x.total").alias("n"), "x.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
