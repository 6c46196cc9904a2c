"""Line joins, chat snapshots, token files, mixing and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import op5, op7_base, op9, words
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import chat, lines, mixing, tokenfile
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(r, s, n):
    s = list(s)
    for _ in range(n):
        k, p = r.randrange(3), r.randrange(len(s) + 1)
        s[p : p + (k > 0)] = [r.choice("abcé")] if k < 2 else []
    return "".join(s)


@pytest.mark.parametrize("t", [1, 2, 3])
def test_segments_and_distance(t):
    r = random.Random(t)
    for _ in range(400):
        a = "".join(r.choice("abcé") for _ in range(r.randrange(t + 1, 40)))
        b = changed(r, a, r.randrange(t + 2))
        near = edits(a, b) <= t
        assert lines.within([a], [b], t)[0] == near
        if near and len(b) > t:
            long_, short = (a, b) if len(a) >= len(b) else (b, a)
            assert set(lines.index_keys(short, t)) & lines.probe_keys(long_, t)


def brute_lines(rows, t=2, least=20):
    occ = [(i, n, x) for i, text in rows if i is not None for n, x in lines.lines_of(text)]
    first = {}
    for i, n, x in occ:
        first[x] = min(first.get(x, (i, n)), (i, n))
    near = {x: [y for y in first if y != x and min(len(x), len(y)) >= least and abs(len(x) - len(y)) <= t and edits(x, y) <= t] for x in first}
    label = {x: x for x in first}
    while True:
        new = {x: min([label[x], *(label[y] for y in near[x])]) for x in first}
        if new == label:
            break
        label = new
    least_id = {}
    for x, c in label.items():
        least_id[c] = min(least_id.get(c, first[x][0]), first[x][0])
    out = []
    for i, text in rows:
        own = lines.lines_of(text)
        if i is None:
            out.append((i, len(own), [], 0, None))
            continue
        gone = [n for n, x in own if (i, n) != first[x] or any(first[y] < first[x] for y in near[x])]
        out.append((i, len(own), gone, sum(len(near[x]) for _, x in own), min((least_id[label[x]] for _, x in own), default=i)))
    return sorted(out, key=str)


def test_line_join(docs_of, spark):
    r = random.Random(9)
    pool = ["".join(r.choice("abcdefé ") for _ in range(r.randrange(5, 60))) + "x" for _ in range(25)]
    rows = [(i, "\n".join(changed(r, r.choice(pool), r.randrange(4)) for _ in range(r.randrange(6)))) for i in range(40)]
    rows += [(None, "\n".join(pool[:3])), (None, None), (50, None), (51, ""), (52, " \n\n"), (7, rows[7][1]), (60, "\n".join(pool)), (61, "z" * 300), (62, "z" * 301)]
    got = lines.find_repeated_lines(docs_of(rows)).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_lines(rows)
    assert lines.find_repeated_lines(docs_of(rows).limit(0)).count() == 0


def test_snapshots(spark):
    r, log = random.Random(2), []
    turns = [("user", "hi"), ("assistant", "hello"), ("user", None), (None, ""), ("user", "x")]
    for c in range(40):
        n = r.randrange(1, 6)
        log += [(c, t, *(turns[t] if r.random() < 0.9 else ("user", "other"))) for t in range(n)]
    log += [(None, 0, "user", "hi"), (3, 0, "user", "hi"), (100, None, "user", "hi")]
    log += [(200, t, "user", f"long {t}") for t in range(700)] + [(201, t, "user", f"long {t}") for t in range(300)]
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, text string")
    convs = {}
    for c, t, a, b in log:
        if c is not None:
            convs.setdefault(c, Counter())[-1 if t is None else t, a, b] += 1
    def proper(a, b):
        last = max(t for t, _, _ in a)
        return a != b and a == Counter({k: n for k, n in b.items() if k[0] <= last})
    want = {c for c, a in convs.items() if not any(d != c and (proper(a, b) or a == b and d < c) for d, b in convs.items())}
    got = chat.rendered_turns(df)
    assert {x["conv_id"] for x in got.collect()} == want and 201 not in want
    assert got.count() == sum(len(convs[c]) for c in want)
    assert chat.rendered_turns(df.limit(0)).count() == 0


def test_snapshot_sql(spark):
    from __spark_entry__ import oracle_sql
    from oracle.compare import compare

    got = compare(spark, "op4_snapshots", QUERIES["op4_snapshots"], oracle_sql()["op4_snapshots"], SF)
    assert got["mismatches"] == 0 and got["spark_rows"] == got["oracle_rows"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 70), st.integers(0, 2**20), st.integers(0, 2**64 - 1)), max_size=5000))
def test_words_round_trip(ids):
    ids = np.array(ids, np.uint64)
    p = tokenfile.Payload(tokenfile.to_payload([1], np.array([len(ids)]), ids))
    assert (p.ids() == ids).all()
    for k in range(len(p.word_at) - 1):
        assert (p.block(k) == ids[k * tokenfile.BLOCK : (k + 1) * tokenfile.BLOCK]).all()


def brute_tokens(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for i, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(docs_of, small, spark, tmp_root):
    import public_tokenizers

    odd = [" lead", "tail ", "two  spaces", "a \n b", "a\n\nb", "x  y", "tab\t q", "   ", "it's 12 o'clock!? 　z", "<|endoftext|> a<|endoftext|>", "é \U0001f600 ok"]
    rows = [r for r in small if r[0] is not None and r[0] != 40] + [(500 + n, t) for n, t in enumerate(odd)] + [(None, None)]
    tokenfile.write_tokens(docs_of(rows), f"{tmp_root}/t", public_tokenizers.path("byte_bpe_50k.json"), 2, shards=5, group_ids=2000)
    got = tokenfile.read_tokens(spark, f"{tmp_root}/t", digest=True).orderBy("start").collect()
    assert [tuple(r) for r in got] == brute_tokens(rows)
    ids = {r["doc_id"]: r["ids"] for r in tokenfile.read_tokens(spark, f"{tmp_root}/t").collect()}
    assert ids[None] == [2]


def test_mix(docs_of, spark):
    r = random.Random(4)
    rows = [(i, " ".join("w" * r.randrange(1, 5) for _ in range(r.randrange(0, 300))), r.choice(["a", "b", "é", "z", None])) for i in range(300)]
    rows += [(None, None, "a"), (5, rows[5][1], rows[5][2]), (999, "one", "only")]
    docs = mixing.with_size(docs_of(rows).drop("size"), "text", "size")
    take = lambda: sorted(map(tuple, mixing.taken_words(mixing.mix(docs, block_words=16)).select("doc_id", "source", "size", "source_size", "target", "taken").collect()), key=str)
    got = take()
    assert got == take() and len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    goal = dict(zip(order, mixing.targets([sizes[s] for s in order], (5, 2, 1), 1.5, 2), strict=True))
    assert sum(goal.values()) == pytest.approx(1.5 * sum(sizes.values()))
    taken = Counter()
    for _, s, n, source_size, target, k in got:
        assert 0 <= k <= 2 * n and source_size == sizes[s] and target == pytest.approx(goal[s])
        taken[s] += k
    for s in order:
        assert abs(taken[s] - goal[s]) <= max(32, 0.01 * goal[s])
    mixed = mixing.mixed_documents(docs_of(rows), block_words=16)
    assert mixed.columns == docs_of(rows).columns
    assert sum(len(words(x["text"])) for x in mixed.collect()) == sum(taken.values())


def test_permutation():
    for n in (1, 2, 3, 10, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 7).tolist()) == list(range(n))


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = p.quality_rules(spark, docs, SF)
    assert good.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    assert not any(op7_base(t)[5] for t in kept.values())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    lost = [i for i in rows if i not in kept and labels.get(i) == 1 and not op7_base(rows[i])[5]]
    assert len(lost) <= 0.02 * len(rows)
    one = p.near_duplicates(spark, good, SF)
    left = {r["doc_id"]: r["text"] for r in one.collect()}
    assert set(left) == {c for _, _, c in op5(list(kept.items()))}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = p.decontamination(spark, one, SF)
    assert sorted(r["doc_id"] for r in clean.collect()) == [r[0] for r in sorted(op9(list(left.items()), bench)) if not r[2]]
    out = p.mixed(spark, clean, SF)
    mixed = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert out.columns == docs.columns and {i for i, _ in mixed} <= {r["doc_id"] for r in clean.collect()}
    final = p.run(spark, SF)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in final.collect()) == sorted((i, n) for i, _, n, _ in brute_tokens(mixed))
