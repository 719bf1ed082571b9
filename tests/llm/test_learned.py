"""Toxicity and importance resampling: held-out accuracy, brute force and edge cases."""
import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import common, resample, toxicity

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in toxicity.op6_toxicity(spark, DATA).collect()}


def test_toxicity_on_held_out_labels(spark, scored):
    docs = common.table(spark, DATA, "documents")
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scored.items())
    pairs = [(scored[r.doc_id].predicted, r.toxic) for r in common.table(spark, DATA, "labels").collect() if scored[r.doc_id].held_out]
    assert len(pairs) > 50 and np.mean([p == t for p, t in pairs]) >= 0.93


@pytest.fixture(scope="module")
def model(spark):
    """Labels by two words in invented prose, some labels wrong or missing."""
    rng = np.random.default_rng(0)
    words = ["table", "river", "stone", "walking", "letters", "garden", "yellow", "music", "season", "country", "winter", "paper"]
    texts, labels = [], []
    for i in range(900):
        w = list(rng.choice(words, 60))
        bad = i % 3 == 0
        if bad:
            k = 1 + i // 3 % 3
            w[:20 * k:20] = list(rng.choice(["vermin", "blockhead"], k))
        texts.append((i, " ".join(w) + "."))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (10_000, 1), labels[0]], "doc_id long, toxic int")
    return toxicity.fit(docs, marks)


def test_deobfuscation(model):
    read = toxicity.Reader(model.counts)
    for token, word in [("v3rm1n", "vermin"), ("bl0ckh3@d", "blockhead"), ("veeeermin", "vermin"), ("v.e.r.m.i.n", "vermin"), ("v e r m i n", "vermin"),
                        ("bl*ckhead", "blockhead"), ("v€rmin", "vermin"), ("wa1king", "walking")]:
        assert word in read(token)[1], token
    assert read("winter")[1] == [] and read("2024")[1] == [] and read("river,")[1] == []


def test_scores_of_obfuscated_and_clean_texts(spark, model):
    texts = ["the v3rm1n again", "b l o c k h e a d said the river", "yellow music of the season", "", None, "river " * 100_000, "river " * 40 + "verrrmin " * 4,
             "yellow music of the season"]
    df = spark.createDataFrame([(i, t, "x", 2) for i, t in enumerate(texts)], "doc_id long, text string, Score string, _given int")
    out = toxicity.score(df, model)
    assert out.columns == ["doc_id", "text", "_given", "score"] and out.count() == len(texts)
    s = {r.doc_id: r.score for r in out.collect()}
    assert min(s[0], s[1], s[6]) >= 0.5 and max(s[2], s[3], s[4], s[5]) < 0.5 and s[3] == s[4] and s[2] == s[7]
    assert toxicity.score(df.limit(0), model).count() == 0
    restored = {r.doc_id: r.restored for r in toxicity.restore(df, model).collect()}
    assert restored[0] == "the vermin again" and restored[1].startswith("blockhead said") and restored[2] == texts[2] and restored[4] == ""


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.remove_toxic(docs, none).count() == 2 and toxicity.remove_toxic(docs.limit(0), none).count() == 0
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, toxic int")
    assert toxicity.remove_toxic(docs, ones).count() == 0


def test_viterbi_finds_the_best_reading(model):
    """Against all readings of short tokens."""
    lm = toxicity.LanguageModel(model.counts)

    def value(word):
        k, total = "^", 0.0
        for c in word + "$":
            total += lm.score(k, c)
            k = (k + c)[1 - toxicity.ORDER:]
        return total
    for token in ("v3rm1n", "w1nt3r", "st.0ne", "leeett3rs", "r!v3r"):
        best = max((value("".join(x for x, _ in path)) - sum(c for _, c in path), "".join(x for x, _ in path))
                   for path in product(*toxicity.readings(token)))
        assert toxicity.restore_token(token, lm) == best[1]


def test_resampling_equals_brute_force(spark, folder):
    docs = {r.doc_id: r.text or "" for r in common.table(spark, folder, "documents").collect()}
    good = {r.doc_id for r in common.table(spark, folder, "labels").collect() if r.quality == 1}
    got = {r.doc_id: r for r in resample.op4_importance_resampling(spark, folder).collect()}
    grams = resample.Grams()
    raw, target, own = Counter(), Counter(), {}
    for i, t in docs.items():
        own[i] = Counter(grams(t).tolist())
        raw.update(own[i])
        if i in good:
            target.update(own[i])
    total = [sum(c.values()) + resample.BUCKETS for c in (raw, target)]
    weight = {i: sum(n * (math.log((target[b] + 1) / total[1]) - math.log((raw[b] + 1) / total[0])) for b, n in c.items()) for i, c in own.items()}
    assert len(got) == len(docs) and all(abs(got[i].log_weight - w) < 1e-6 * (1 + abs(w)) for i, w in weight.items())
    k = round(resample.SHARE * len(docs))
    best = sorted(got.values(), key=lambda r: -r.key)[:k]
    assert {r.doc_id for r in best} == {r.doc_id for r in got.values() if r.selected}
    noise = np.array([r.key - r.log_weight for r in got.values()])
    assert abs(noise.mean() - 0.5772) < 0.4 and abs(noise.std() - math.pi / math.sqrt(6)) < 0.4


def test_resampling_prefers_the_target(spark):
    """Held-out labels: good documents get larger weights."""
    labels = common.table(spark, DATA, "labels")
    docs = common.table(spark, DATA, "documents")
    out = resample.resample(docs, labels.where("quality = 1 AND doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = [np.array([r.log_weight for r in out if r.quality == q]) for q in (1, 0)]
    assert np.mean(good[:, None] > bad[None, :]) > 0.9


def test_resampling_edges(spark):
    schema = "doc_id long, text string, target string, tie string"
    data = [(1, "good words here", "", ""), (2, None, "", ""), (2, "", "", ""), (None, "other text", "", ""), (3, "long " * 100_000, "", ""),
            (4, "same", "", ""), (4, "same", "", "")]
    df, ids = spark.createDataFrame(data, schema), spark.createDataFrame([(1,), (1,), (None,), (99,)], "doc_id long")
    got = resample.resample(df, ids, share=0.5).collect()
    assert len(got) == 7 and sum(r.selected for r in got) in (4, 5)
    zero = resample.resample(df, ids.limit(0)).collect()
    assert all(r.log_weight == 0 for r in zero)
    assert resample.resample(df.limit(0), ids).count() == 0
    frame = spark.range(2000).select((F.col("id") % 17).alias("x"))
    values = sorted((r.x for r in frame.collect()), reverse=True)
    for k in (1, 118, 119, 1999, 2000):
        value, above = resample.kth_largest(frame, "x", k)
        assert value == values[k - 1] and above == sum(v > value for v in values)


def test_ngram_counts_are_exact(spark):
    texts = ["Hello, hello world", "naïve ΑΒΓ abc abc1 don't", None, "", "x " * 5000, "zażółć gęślą jaźń"]
    df = spark.createDataFrame([(t,) for t in texts * 3], "text string").repartition(4)
    lm = toxicity.LanguageModel(toxicity.count_characters(df))
    want = Counter()
    for t in texts * 3:
        for token in (t or "").lower().split():
            word = token.strip(".,;:!?\"'()")
            if word.isalpha():
                marked = f"^{word}$"
                want["^"] += 1
                want[""] += len(word) + 1
                for end in range(1, len(marked)):
                    for n in range(1, toxicity.ORDER + 1):
                        if end - n + 1 >= 0:
                            want[marked[end - n + 1:end + 1]] += 1
    assert {g: lm.count(g) for g in want} == dict(want) and len(lm.counts) == len(want)
    assert lm.count("qqq") == 0
    assert "blick" in {"".join(x) for x in product(*[[o for o, _ in options] for options in toxicity.readings("bl**k")])}
