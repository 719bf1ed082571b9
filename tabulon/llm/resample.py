"""Quality selection by importance resampling.

Two generative models are bags of hashed word unigrams and bigrams (``BUCKETS`` buckets, add-one smoothing): one of the target text
(documents with a good label), one of the raw text (all documents). A document's log weight is the sum of the log
ratios of its n-grams; adding Gumbel noise, a function of its id and text, and taking the k largest keys draws k documents
without replacement in proportion to the weights. The k-th key is found by narrowing histograms, not by a sort.

The target model is fitted on about ``TARGET_ROWS`` labelled documents, chosen by a hash of their id; the raw model and the
weights cover all documents. Words are runs of letters and digits or of other marks, lower-cased. Defined cases: a null or
empty text has weight 0; texts of any length are read whole; a null id is an id like any other but never labelled; rows
equal in id and text have equal keys and are taken together; without good labels all weights are 0; an empty table gives no
rows. Other columns are not read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tabulon.llm.common import stored, table

BUCKETS, TARGET_ROWS, SHARE, SEED = 10_000, 100_000, 0.8, 11
WORDS_KEPT, BINS = 500_000, 1024
_WORD = re.compile(r"\w+|[^\w\s]+")
_M1, _M2, _32 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


class Grams:
    """Bucket numbers of a text's unigrams and bigrams."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.known = np.uint64(buckets), {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORD.findall((text or "").lower())
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in {w for w in words if w not in known}:
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.array([known[w] for w in words], np.uint64)
        pairs = h[:-1] * _M1 + h[1:]
        pairs = (pairs ^ (pairs >> _32)) * _M2
        return (np.concatenate([h, pairs ^ (pairs >> _32)]) % self.buckets).astype(np.int64)


def log_ratios(docs: DataFrame, good: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
               limit: int = TARGET_ROWS) -> np.ndarray:
    """log(target / raw) of each bucket; ``good`` has the ids of target documents."""
    ids = good.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id")).distinct()
    share = min(1.0, limit / max(ids.count(), 1))
    # About ``limit`` ids.
    chosen = ids.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).withColumn("target", F.lit(True))
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id", "left")
            .select("text", F.coalesce("target", F.lit(False)).alias("target")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, raw, target = Grams(buckets), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            for x, is_target in zip(b.column("text").to_pylist(), b.column("target").to_pylist()):
                n = np.bincount(grams(x), minlength=buckets)
                raw += n
                if is_target:
                    target += n
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])

    found = (rows.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket")
             .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())  # at most ``buckets`` rows
    raw, target = np.ones(buckets), np.ones(buckets)
    raw[found["bucket"]] += found["raw"]
    target[found["bucket"]] += found["target"]
    if target.sum() == buckets:
        return np.zeros(buckets)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratios: np.ndarray, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, tie, log_weight, key): the log weight of each whole text and its Gumbel key."""
    tie = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 1)
    d = docs.select(F.col(doc_id).alias("doc_id"), tie.alias("tie"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # 8 bytes per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        grams = Grams(len(ratios))
        for b in batches:
            done = [float(ratios[grams(x)].sum()) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tie"), pa.array(done, pa.float64())], ["doc_id", "tie", "log_weight"])

    kind = d.schema["doc_id"].dataType.simpleString()
    uniform = (F.shiftrightunsigned("tie", 10).cast("double") + 0.5) / float(1 << 53)
    return d.mapInArrow(run, f"doc_id {kind}, tie long, log_weight double").withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def kth_largest(df: DataFrame, column: str, k: int):
    """(value, number of rows above it) of the k-th largest value: histograms of ``BINS`` bins close in on it."""
    above = 0
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low != high:
        place = (F.col(column) - F.lit(low)).cast("double") * (BINS / float(high - low))
        bins = (df.where(F.col(column).between(low, high)).groupBy(F.least(F.floor(place), F.lit(BINS - 1)).alias("bin"))
                .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect())
        for b in sorted(bins, key=lambda b: -b["bin"]):
            if above + b["n"] >= k:
                low, high = b["low"], b["high"]
                break
            above += b["n"]
    return low, above


def sample(weighed: DataFrame, k: int) -> DataFrame:
    """``weighed`` with ``selected``: the rows with the k largest keys; equal keys by the larger hash."""
    if k <= 0:
        return weighed.withColumn("selected", F.lit(False))
    value, above = kth_largest(weighed, "key", k)
    tie, _ = kth_largest(weighed.where(F.col("key") == F.lit(value)), "tie", k - above)
    return weighed.withColumn("selected", (F.col("key") > F.lit(value)) | ((F.col("key") == F.lit(value)) & (F.col("tie") >= F.lit(tie))))


def resample(docs: DataFrame, good: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE,
             seed: int = SEED) -> DataFrame:
    """(doc_id, tie, log_weight, key, selected) of all documents; ``share`` of them are selected."""
    weighed = stored(weigh(docs, log_ratios(docs, good, doc_id, text), doc_id, text, seed), "importance-weights")
    return sample(weighed, round(share * weighed.count()))


def op4_importance_resampling(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return resample(docs, labels.where("quality = 1")).select("doc_id", "log_weight", "key", "selected")
