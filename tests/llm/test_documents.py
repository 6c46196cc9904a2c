"""Operators over documents against brute force, on edge cases and on the small test tables."""

import pytest
from brute import op5, op6, op7_base, op9, op10_base, sha
from pyspark.sql import functions as F

from cartwheel.llm import personal, quality, simhash, substrings, winnow
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_simhash(docs_of, small, spark):
    got = simhash.simhash_components(docs_of(small))
    assert tuples(got, "doc_id", "fingerprint", "component_id") == op5(small)
    assert tuples(QUERIES["op5_simhash"](spark, SF), "doc_id", "fingerprint", "component_id") == op5(documents(spark))


def test_simhash_keeps_one_of_each_component(docs_of, small):
    rows = op5(small)
    kept = simhash.drop_near_copies(docs_of(small))
    assert kept.columns == docs_of(small).columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({r[2] for r in rows if r[2] is not None})


def test_trie_finds_all_pairs():
    import numpy as np

    rng = np.random.default_rng(0)
    seeds = rng.integers(0, 2**63, 300, dtype=np.uint64)
    noise = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(3000)], np.uint64)
    a = np.unique(seeds[rng.integers(0, 300, 3000)] ^ noise)
    want = {(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 2).tolist() if i < j}
    got = [(int(x), int(y)) for i, j in simhash.trie_pairs(a, None, 2) for x, y in zip(i, j, strict=True)]
    assert len(got) == len(set(got)) and set(got) == want
    b, c = a[::2], a[1::2]
    got = {(int(x), int(y)) for i, j in simhash.trie_pairs(b, c, 2) for x, y in zip(i, j, strict=True)}
    assert got == {(i, j) for i in range(len(b)) for j in np.flatnonzero(np.bitwise_count(c ^ b[i]) <= 2).tolist()}


def test_small_cells_give_the_same_components(docs_of, small):
    fp = simhash.with_fingerprint(docs_of(small)).select(F.col(simhash.FP)).distinct()
    few = simhash.links(fp, 2, cell_rows=2).count()
    assert few >= simhash.links(fp, 2).count() > 0


@pytest.mark.parametrize("bits", [None, 4])
def test_substrings(docs_of, small, spark, bits):
    got = substrings.drop_repeated_substrings(docs_of(small), cell_bits=bits)
    cols = ("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert tuples(got, *cols) == op6(small)
    if bits is None:
        assert tuples(QUERIES["op6_substrings"](spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256") == op6(documents(spark))


def test_gaps_round_trip():
    import numpy as np

    at = np.unique(np.random.default_rng(1).integers(0, 100_000, 500))
    assert (substrings.ungaps(substrings.gaps(at)) == at).all()


def test_quality_base(docs_of, small, spark):
    d = quality.judged(docs_of(small), spark.createDataFrame([], "doc_id long, quality int"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = tuples(d, "doc_id", *(quality.P + n for n in names))
    assert got == sorted(((i, *op7_base(t)) for i, t in small), key=str)
    assert d.where(f"{quality.P}kept = {quality.P}base_failed").count() == 0


def test_quality_rules_on_held_out_labels(spark):
    """Learned on the sample, judged on the labelled rows outside it."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = quality.fit(docs, labels, sample_rows=200)
    used = labels.orderBy(F.xxhash64("doc_id")).limit(200)
    d = quality.with_statistics(docs).withColumn("rule", quality.reject_rule(rules)).join(labels.join(used, "doc_id", "left_anti"), "doc_id")
    d = d.withColumn("kept", ~F.col(quality.P + "base_failed") & F.col("rule").isNull()).toPandas()
    good = d[(d.quality == 1) & ~d[quality.P + "base_failed"]]
    assert good.kept.mean() > 0.97
    assert (~d[d.quality == 0].kept).mean() > 0.8


def test_winnowing(docs_of, small, spark):
    texts = [t for _, t in small if t]
    items = [(1, texts[10][5:200]), (2, None), (3, ""), (4, "again again AGAIN"), (None, texts[5][400:900]), (5, texts[12][40:250]), (5, texts[12][40:250])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    from cartwheel.llm.queries import contamination_digest

    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for limit in (1_000_000, 0):
        got = contamination_digest(winnow.find_contamination(docs_of(small), bench, max_broadcast_words=limit))
        assert tuples(got, *cols) == op9(small, items)
        left = winnow.drop_contaminated(docs_of(small), bench, max_broadcast_words=limit)
        assert left.columns == docs_of(small).columns
        assert left.count() == sum(not r[2] for r in op9(small, items))
    rows = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert tuples(QUERIES["op9_winnowing"](spark, SF), *cols) == op9(documents(spark), rows)
    none = winnow.find_contamination(docs_of(small), bench.limit(0))
    assert none.where("size(spans) > 0").count() == 0 and none.count() == len(small)


PII = [
    (1, "Mail ann.b@ex.co or call +1 (202) 555-0150. Later: (202) 555-0150, see ann.b and 2025550150."),
    (2, "10.0.0.1 300.1.1.1 4111 1111 1111 1111 4111-1111-1111-1112 1.2.3.4.5 @ a@b a@b.c.d@e.f +12 +1((((1234567 89"),
    (3, "9" * 50_000 + "." + "a" * 50_000 + "@x." + "+1" * 3000),
    (4, None), (5, ""), (6, "no data, 12345 only"), (7, "é ñ x_y%z+1@host-1.org\n+49 30 1234567 and 49 30 1234567"),
]


def test_personal_base(docs_of, spark):
    found = personal.find_personal_data(docs_of(PII + PII[:1])).toPandas()
    for (i, text) in PII:
        for r in found[found.doc_id == i].itertuples():
            join = lambda spans: [f"{s['kind']}:{s['start']}:{s['end']}" for s in spans]
            base = join(r.base)
            if i != 3:  # plain expressions are quadratic there
                assert base == op10_base(text)
            assert set(base) <= set(join(r.spans))
    got = QUERIES["op10_skip_chain"](spark, SF).toPandas().set_index("doc_id")
    for i, text in documents(spark):
        base = op10_base(text)
        assert got.loc[i].base_sha256 == sha(",".join(base))
        assert [got.loc[i][f"n_{k}"] for k in personal.KINDS] == [sum(b.startswith(k) for b in base) for k in personal.KINDS]


def test_skip_chain_adds_repeated_mentions(docs_of):
    r = personal.find_personal_data(docs_of(PII)).where("doc_id = 1").first()
    text = PII[0][1]
    more = {(s["kind"], text[s["start"] : s["end"]]) for s in r["spans"]} - {(s["kind"], text[s["start"] : s["end"]]) for s in r["base"]}
    assert ("phone", "2025550150") in more and ("email", "ann.b") in more
    clean = personal.find_personal_data(docs_of([(1, "numbers 2025550150 and 10203040506 alone")])).first()
    assert not clean["spans"]


def test_empty_tables(docs_of):
    empty = docs_of([(1, "a")]).where("doc_id < 0")
    bench = empty.select(F.col("doc_id").alias("item_id"), "text")
    labels = empty.select("doc_id", F.lit(1).alias("quality"))
    for df in (simhash.simhash_components(empty), substrings.drop_repeated_substrings(empty), winnow.find_contamination(empty, bench),
               personal.find_personal_data(empty), quality.judged(empty, labels), simhash.drop_near_copies(empty)):
        assert df.count() == 0


