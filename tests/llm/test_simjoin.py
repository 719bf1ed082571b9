"""The similarity join next to brute force, and the pipeline's stages."""
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabulon.llm import common, simjoin


def shingles(text, width=5):
    w = (text or "").lower().split()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a], links[b] = links[a] + 1, links[b] + 1
                root[find(a)] = find(b)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return sorted((repr(name), repr(least.get(find(i))), links[i]) for i, (name, _) in enumerate(rows))


def near_copies(rng, groups, size, words=60, changes=2):
    out = []
    vocabulary = [f"w{i}" for i in range(400)]
    for _ in range(groups):
        base = list(rng.choice(vocabulary, words))
        for _ in range(size):
            w = list(base)
            for k in rng.integers(0, words, rng.integers(0, changes + 1)):
                w[k] = str(rng.choice(vocabulary))
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_join_equals_brute_force(spark, block):
    rng = np.random.default_rng(7)
    texts = near_copies(rng, 12, 3) + near_copies(rng, 1, 40, words=90, changes=1)
    texts += ["", None, "  ", "one", "One", "one two three", "a b c d e", "a b c d e f", texts[0], texts[0], texts[0].upper(), "z " * 3000]
    rows = list(zip([None, *range(1, len(texts))], texts)) + [(5, texts[5]), (5, "other words under the same id here")]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, node string, Tie int, unit string").repartition(4)
    got = simjoin.join(df, block=block).collect()
    assert sorted((repr(r.doc_id), repr(r.class_id), r.n_links) for r in got) == brute(rows)


def test_long_texts_and_empty_tables(spark):
    rng = np.random.default_rng(8)
    long = " ".join(rng.choice([f"v{i}" for i in range(3000)], 60_000))
    df = spark.createDataFrame([(1, long), (2, long + " end"), (3, long[:100_000])], "doc_id long, text string")
    assert {r.doc_id: (r.class_id, r.n_links) for r in simjoin.join(df).collect()} == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    assert simjoin.join(df.limit(0)).count() == 0 and simjoin.keep_one(df.limit(0)).count() == 0


def test_keep_one(spark):
    rng = np.random.default_rng(9)
    texts = near_copies(rng, 5, 4, changes=1) + [None, "", ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "alone with a null id")]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, _key string, _KEPT_ID string")
    out = simjoin.keep_one(df)
    assert out.columns == df.columns
    want = {r.class_id for r in simjoin.join(df).collect()}
    kept = [r.doc_id for r in out.collect()]
    assert len(kept) == len(set(kept)) and set(kept) == want


def test_pruning_loses_no_pair_in_practice():
    """Pairs at the threshold pass the posterior test; pairs far below are dropped early."""
    rng = np.random.default_rng(10)
    need = simjoin.least_matches()
    lost = dropped = 0
    for _ in range(300):
        common_part = rng.integers(0, 1 << 63, 800, dtype=np.int64).astype(np.uint64)
        a, b = (np.unique(np.r_[common_part, rng.integers(0, 1 << 63, 100, dtype=np.int64).astype(np.uint64)]) for _ in range(2))
        c = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.int64).astype(np.uint64))
        (ka, sa), (kb, sb), (_, sc) = map(simjoin.signature, (a, b, c))
        same = lambda x, y: all(sum(p == q for p, q in zip(x[:n], y[:n])) >= m for n, m in need.items())
        lost += not (same(sa, sb) and (ka == kb).any())
        dropped += not same(sa, sc)
    assert lost == 0 and dropped == 300


STAGE_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_stages_keep_columns_and_clean_documents(spark, folder):
    docs = common.table(spark, folder, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stored(stage(spark, docs, folder), f"test-{name}")
        assert out.columns == columns and 0.7 * docs.count() <= out.count() <= docs.count(), name
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in docs.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, last.collect()))


def test_pipeline_catches_what_is_planted(spark):
    folder = "/root/testdata/sf0.01"  # enough labels to learn from
    item = common.table(spark, folder, "benchmark").first().text
    clean = [f"clean{k} " + " ".join(f"c{k}word{i}" for i in range(80)) for k in range(4)]
    texts = {1: clean[0], 2: clean[0], 3: clean[0] + " more", 4: clean[1], 5: f"{clean[2]} {item} tail", 6: "you stupid idiot and scum, moron trash " + clean[3], 7: None, 8: ""}
    planted = spark.createDataFrame([(10**9 + i, t, None, f"host{i}", None) for i, t in texts.items()], STAGE_COLUMNS)
    docs = common.table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars").unionByName(planted)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, folder), "test-planted")
    left = {r.doc_id - 10**9 for r in docs.where(F.col("doc_id") > 10**9).collect()}
    assert left == {1, 4, 7, 8}


def test_pipeline_stages_on_an_empty_table(spark, folder):
    docs = spark.createDataFrame([], STAGE_COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
