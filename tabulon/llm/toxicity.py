"""Toxicity of noisy text: deobfuscation by a noisy channel, then a score of the restored words.

A character language model (orders 1 to ``ORDER``, stupid back-off) is counted over the words of all documents. Its table has
one entry for each n-gram that occurs (16 bytes: a 64-bit hash and the count), so it grows with the corpus. A suspicious token (leetspeak or look-alike characters, separators between its letters, a letter three
times or more in a row, single letters in a row) spans a lattice of readings: each character may stand for some
letters, for nothing, or a run for one or two letters. Viterbi search over the last ``ORDER`` - 1 letters finds the best
restored word, which joins the words as they stand.

Words are scored by a lexicon learned from labelled documents: prefixes of 4 to 8 letters and whole words that toxic
documents hold significantly more often. A document's features are the log likelihood ratio of its words (those
outside the lexicon included, so that length counts) and the mean and sum of its hits, where a token that a document repeats
counts at most ``REPEATS`` times; logistic regression makes the score.
Labels are read from at most about ``TRAIN_ROWS`` labelled documents, chosen by a hash of their id; the language model
and the scores cover all documents.

Defined cases: a null or empty text has no words and gets the score of a text without evidence; texts of any length are
read whole; repeated rows are scored alike; null ids and null labels teach nothing, of several labels of a document the
largest counts; without labels of both kinds every score is the share of toxic labels (0 without any); an empty table
gives no rows. Other columns pass through; a column with the name of the score is replaced.
"""
from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabulon.llm.common import free_name, let_go, stored, table

ORDER, BACKOFF = 4, math.log(0.4)
TRAIN_ROWS = 20_000
#: Least number of toxic documents with a lexicon entry, least evidence (minus the log of the binomial tail's bound), least log ratio.
LEAST_DOCS, EVIDENCE, LEAST_RATIO = 5, 10.0, 1.0
PREFIXES = range(4, 9)
#: Tokens whose readings a worker keeps in each of two generations, the longest of them; n-grams whose scores it keeps.
TOKENS_KEPT, LONGEST_KEPT, GRAMS_KEPT = 200_000, 100, 400_000
#: Letters of a token that marks can hide.
MASKED = 3
#: Texts that a worker holds as strings at once.
ROWS_AT_ONCE = 500
#: Repetitions of one token in a document that count.
REPEATS = 20
#: Letters that a character can stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "§": "s",
        "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ο": "o", "ѕ": "s", "ԁ": "d"}
_GAPS = frozenset(".-_*·'`~,:;/\\^​‌‍⁠­")
_WORD = re.compile(r"[^\W\d_]+")
#: What is cut off a token's ends: marks, but no letter-like sign that stands alone or twice.
_EDGE = re.compile(r"^(?:[^\w@$€£]|([@$€£])\1{2,})+|(?:[^\w@$€£]|([@$€£])\2{2,})+$")
_SPACED = re.compile(r"(?<!\S)(?:[\w@$!] ){2,}[\w@$!](?!\S)")
_RUN = re.compile(r"([^\W\d_])\1\1")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Marks at a token's ends that never stand for letters there, and letters that stand for others.
_MARKS = ".,;:!?\"'()"
_LIKE_LETTERS = frozenset(c for c in LEET if c.isalpha())


_M1, _M2, _64 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1


def _hash(gram: str) -> int:
    """Hash of an n-gram; ``_grams`` computes the same for arrays."""
    h = 0
    for c in gram:
        h = (h * _M1 + ord(c) + 1) & _64
    return ((h ^ (h >> 32)) * _M2) & _64


def _summed(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place, keys = pd.factorize(hashes)
    return keys, np.bincount(place, n, len(keys)).astype(np.int64)


def _grams(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the n-grams of orders 0 to ``ORDER`` of words (with both ends marked)."""
    codes = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    n = np.fromiter(words.values(), np.int64, len(words))
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weight = np.repeat(n, lengths)
    found = [(np.array([_hash(""), _hash("^")], np.uint64), np.array([(n * (lengths - 1)).sum(), n.sum()]))]
    for k in range(ORDER):  # grams of k + 1 characters that end at a character after the first
        ends = np.flatnonzero(place >= max(k, 1))
        h = np.zeros(len(ends), np.uint64)
        for j in range(k, -1, -1):
            h = h * np.uint64(_M1) + codes[ends - j]
        found.append(_summed((h ^ (h >> np.uint64(32))) * np.uint64(_M2), weight[ends]))
    return _summed(*map(np.concatenate, zip(*found)))


class LanguageModel:
    """Back-off scores of characters from n-gram counts, given as hashes and their counts."""

    def __init__(self, counts: tuple[np.ndarray, np.ndarray]):
        self.counts = dict(zip(*(x.tolist() for x in counts)))
        self.kept: dict[str, float] = {}

    def count(self, gram: str) -> int:
        return self.counts.get(_hash(gram), 0)

    def score(self, context: str, c: str) -> float:
        key = context + c
        found = self.kept.get(key)
        if found is None:
            penalty, found = 0.0, -20.0
            for k in range(len(context) + 1):
                n = self.count(context[k:] + c)
                if n > 0:
                    found = penalty + math.log(n / max(self.count(context[k:]), n))
                    break
                penalty += BACKOFF
            if len(self.kept) > GRAMS_KEPT:
                self.kept.clear()
            self.kept[key] = found
        return found


def readings(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a token: for each character or run the strings it can stand for, with their costs."""
    out, i = [], 0
    masked = token.count("*") <= min(MASKED, max(1, len(token) // 2))  # each of the signs can hide a letter
    while i < len(token):
        c, j = token[i], i + 1
        while j < len(token) and token[j] == c and not (c == "*" and masked):
            j += 1
        letters = LEET.get(c) or (c if c.isalpha() else "")
        options = []
        for k, x in enumerate(letters):
            base = 0.0 if x == c else 0.3 + 0.2 * k
            options.append((x, base))
            if j - i > 1:
                options.append((x + x, base if j - i == 2 else base + 0.5))
        if c in _GAPS:
            options.append(("", 0.3))
            if c == "*" and masked and 0 < i < len(token) - 1:
                options += [(x, 2.0) for x in _LETTERS]
        if c == "!" or not options:
            options.append(("", 1.5))
        out.append(options)
        i = j
    return out


def suspicious(token: str) -> bool:
    letters = sum(c.isalpha() for c in token)
    if not letters:
        return False
    if _RUN.search(token):
        return True
    return any(c in LEET or (c in _GAPS and 0 < i < len(token) - 1) for i, c in enumerate(token))


def restore_token(token: str, model: LanguageModel) -> str:
    """The likeliest reading of a token: Viterbi search whose states are the last letters."""
    states = {"^": (0.0, "")}
    for options in readings(token):
        new: dict[str, tuple[float, str]] = {}
        for context, (score, word) in states.items():
            for x, cost in options:
                s, k = score - cost, context
                for c in x:
                    s += model.score(k, c)
                    k = (k + c)[1 - ORDER:]
                if k not in new or s > new[k][0]:
                    new[k] = (s, word + x)
        states = new
    return max((s + model.score(k, "$"), w) for k, (s, w) in states.items())[1]


def tokens_of(text: str) -> Counter:
    """Lower-cased tokens of a text and its rows of single letters, with their numbers."""
    text = text.lower()
    out = Counter(text.split())
    for m in _SPACED.findall(text):
        out[m] += 1
    return out


def plain_word(token: str) -> str | None:
    """The word of a token that is one word without anything to restore, as most are."""
    word = token.strip(_MARKS)
    return word if word.isalpha() and _LIKE_LETTERS.isdisjoint(word) and not _RUN.search(word) else None


class Reader:
    """Words of tokens: as they stand, and restored where a token is suspicious."""

    def __init__(self, counts: tuple[np.ndarray, np.ndarray]):
        self.model = LanguageModel(counts)

    def __call__(self, token: str) -> tuple[list[str], list[str]]:
        """(words as they stand, restored words)."""
        word = plain_word(token)
        if word:
            return [word], []
        plain = _WORD.findall(token)
        core = _EDGE.sub("", token.replace(" ", ""))
        if not suspicious(core):
            return plain, [core] if " " in token else []
        tried = {core, core.rstrip("$€£*@0123456789")}
        restored = {restore_token(t, self.model) for t in tried if suspicious(t)}
        return plain, [w for w in restored if len(w) > 1 and w not in plain]


def entries_of(word: str) -> list[str]:
    return [word[:k] for k in PREFIXES if len(word) > k] + [word + "$"]


@dataclass
class Model:
    counts: tuple[np.ndarray, np.ndarray]
    lexicon: dict[str, float] = field(default_factory=dict)
    other: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    scorer: Scorer | None = None  # one for all tasks of a Python worker, which holds one copy of a broadcast model


class Scorer:
    """Features and scores of texts under a model; what it knows of tokens is kept in two generations."""

    def __init__(self, model: Model):
        self.model, self.read, self.known, self.older = model, Reader(model.counts), {}, {}
        self.alike: dict[tuple, tuple] = {}  # one object for the many tokens of equal value
        self.heads = {e[:PREFIXES[0]] for e in model.lexicon}

    @staticmethod
    def of(model: Model) -> Scorer:
        if model.scorer is None:
            model.scorer = Scorer(model)
        return model.scorer

    def weight(self, word: str) -> float:
        """The largest weight of a word's entries; all of them begin like the word."""
        if (word + "$")[:PREFIXES[0]] not in self.heads:
            return 0.0
        return max(self.model.lexicon.get(e, 0.0) for e in entries_of(word))

    def token(self, token: str) -> tuple[int, float, int]:
        found = self.known.get(token)
        if found is None and token in self.older:
            found = self.known[token] = self.older[token]
        if found is None:
            plain, restored = self.read(token)
            total, hits = 0.0, 0
            for words in [*([w] for w in plain), restored]:  # of several readings the worst counts
                best = max(map(self.weight, words), default=0.0)
                total, hits = total + best, hits + (best > 0)
            if len(self.known) > TOKENS_KEPT:
                self.older, self.known = self.known, {}
            found = (len(plain), total, hits)
            found = self.alike.setdefault(found, found)
            if len(token) <= LONGEST_KEPT:
                self.known[token] = found
        return found

    def features(self, text: str) -> list[float]:
        words = hits = 0
        total = 0.0
        for token, n in tokens_of(text).items():
            word = plain_word(token)  # as fast as a look into a large cache, which is left to the other tokens
            if word:
                w, t = 1, self.weight(word)
                h = t > 0
            else:
                w, t, h = self.known.get(token) or self.token(token)
            words += w * n
            if h:
                n = min(n, REPEATS)
                total, hits = total + t * n, hits + h * n
        ratio = total + self.model.other * max(0, words - hits)
        return [max(-20.0, min(20.0, ratio)) / 5, min(total, 20.0) / 5, min(1.0, 20 * hits / max(words, 20)), 1.0]

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(self.features(text), self.model.weights))))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _texts(b: pa.RecordBatch, column: int) -> Iterator[str]:
    for k in range(0, b.num_rows, ROWS_AT_ONCE):
        yield from b.column(column).slice(k, ROWS_AT_ONCE).to_pylist()


def count_characters(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the n-grams of the words of all documents; 16 bytes per n-gram reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        total = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def added(words: Counter) -> tuple[np.ndarray, np.ndarray]:
            plain: Counter = Counter()
            for token, n in words.items():
                word = token.strip(".,;:!?\"'()")
                if word.isalpha():
                    plain[word] += n
            return _summed(*map(np.concatenate, zip(total, _grams(plain)))) if plain else total
        words: Counter = Counter()
        for b in batches:
            for x in _texts(b, 0):
                if x:
                    words.update(x.lower().split())
                    if len(words) > TOKENS_KEPT:
                        total = added(words)
                        words.clear()
        seen, n = added(words)
        yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(n)], ["gram", "n"])

    found = docs.select(text).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    return found["gram"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)


def _train_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, limit: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of about ``limit`` labelled documents outside the held-out fold, and the label counts."""
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
             .groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(label)).cast("int").alias("toxic")))
    n = known.count()
    share = min(1.0, limit / max(n, 1))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # About ``limit`` rows of an id and a label.
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    return rows.select("text", "toxic"), {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        limit: int = TRAIN_ROWS) -> Model:
    model = Model(count_characters(docs, text))
    rows, sizes = _train_rows(docs, labels, doc_id, text, label, limit)
    rows = stored(rows, "toxicity-train")
    if len(sizes) < 2:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        model.weights = np.array([0, 0, 0, 30.0 if share else -30.0])
        return model
    sc = docs.sparkSession.sparkContext
    counts = sc.broadcast(model.counts)

    def tallies(wanted):
        """Per entry: toxic and other documents with it, its capped numbers there, as rows of one task each."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            read, known = Reader(counts.value), {}
            found = defaultdict(lambda: [0, 0, 0, 0])
            for b in batches:
                for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                    if not toxic and wanted is None:
                        continue
                    own: Counter = Counter()
                    words = 0
                    for token, n in tokens_of(text).items():
                        if token not in known:
                            if len(known) > TOKENS_KEPT:
                                known.clear()  # a token is read again when it comes again
                            plain, restored = read(token)
                            known[token] = len(plain), [e for w in plain + restored for e in entries_of(w)
                                                        if wanted is None or e in wanted.value]
                        size, entries = known[token]
                        words += size * n
                        for e in entries:
                            own[e] += min(n, REPEATS)
                    own[""] = words
                    k = 0 if toxic else 1
                    for e, n in own.items():
                        x = found[e]
                        x[k] += 1
                        x[k + 2] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())] + [
                pa.array([x[k] for x in found.values()], pa.int64()) for k in range(4)], ["entry", "d1", "d0", "n1", "n0"])
        return (rows.mapInArrow(run, "entry string, d1 long, d0 long, n1 long, n0 long").groupBy("entry")
                .agg(*[F.sum(c).alias(c) for c in ("d1", "d0", "n1", "n0")]))

    # Entries of enough toxic documents; their number is bounded by the words of the training rows.
    frequent = {r["entry"] for r in tallies(None).where(F.col("d1") >= LEAST_DOCS).select("entry").collect()}
    wanted = sc.broadcast(frequent)
    t = tallies(wanted).toPandas().set_index("entry")
    wanted.destroy()
    counts.destroy()
    if "" not in t.index:
        model.weights = np.array([0, 0, 0, -30.0])
        return model
    whole, t = t.loc[""], t.drop("")
    ratio = np.log((t.d1 + 0.5) / (whole.d1 + 1)) - np.log((t.d0 + 0.5) / (whole.d0 + 1))
    n, share = t.d1 + t.d0, whole.d1 / max(1, whole.d1 + whole.d0)
    with np.errstate(divide="ignore", invalid="ignore"):  # n * KL(rate among its documents || share of toxic documents)
        sure = t.d1 * np.log(t.d1 / n / share) + np.where(t.d0 > 0, t.d0 * np.log(t.d0 / n / (1 - share)), 0) >= EVIDENCE
    weight = np.log((t.n1 + 0.5) / (whole.n1 + 1)) - np.log((t.n0 + 0.5) / (whole.n0 + 1))
    good = sure & (ratio >= LEAST_RATIO) & (weight >= LEAST_RATIO)
    model.lexicon = weight[good].to_dict()
    hit = rows_hit = 0
    for e in model.lexicon:  # words are counted once, by their whole entry or shortest prefix
        if not any(e[:k] in model.lexicon for k in PREFIXES if k < len(e.rstrip("$"))):
            hit, rows_hit = hit + t.n1[e] / max(whole.n1, 1), rows_hit + t.n0[e] / max(whole.n0, 1)
    model.other = math.log(max(0.5, 1 - hit)) - math.log(max(0.5, 1 - rows_hit))
    shared = sc.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        scorer = Scorer.of(shared.value)
        for b in batches:
            f = np.array([scorer.features(x) for x in _texts(b, 0)]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*(pa.array(f[:, k]) for k in range(4)), b.column("toxic")], ["a", "b", "c", "d", "toxic"])

    # About ``limit`` rows of five numbers.
    data = rows.mapInArrow(features, "a double, b double, c double, d double, toxic int").toPandas()
    shared.destroy()
    model.weights = _logistic(data[["a", "b", "c", "d"]].to_numpy(), data["toxic"].to_numpy())
    return model


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    w, ridge = np.zeros(x.shape[1]), penalty * np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def _mapped(docs: DataFrame, text: str, name: str, kind: T.DataType, arrow: pa.DataType, make) -> DataFrame:
    kept = docs.drop(name)
    given = free_name(kept, "_given")
    source = kept.withColumn(given, docs[text]) if text == name else kept.withColumn(given, F.col(text))
    place = len(source.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        work = make()
        for b in batches:
            done = [work(x or "") for x in _texts(b, place)]
            yield pa.RecordBatch.from_arrays([*b.columns[:place], pa.array(done, arrow)], [*b.schema.names[:place], name])

    return source.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(name, kind)]))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the toxicity of each whole text, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return _mapped(docs, text, name, T.DoubleType(), pa.float64(), lambda: Scorer.of(shared.value).score)


def restore(docs: DataFrame, model: Model, text: str = "text", name: str = "restored") -> DataFrame:
    """``docs`` with each text's suspicious tokens replaced by their likeliest readings."""
    counts = docs.sparkSession.sparkContext.broadcast(model.counts)

    def make():
        read = Reader(counts.value)
        token = re.compile(_SPACED.pattern + r"|\S+")

        def one(m: re.Match) -> str:
            found = read(m[0].lower())[1]
            return found[0] if found else m[0]
        return lambda x: token.sub(one, x)
    return _mapped(docs, text, name, T.StringType(), pa.string(), make)


def remove_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
                 threshold: float = 0.5) -> DataFrame:
    """``docs`` without those whose score reaches ``threshold``."""
    name = free_name(docs, "_score")
    return score(docs, fit(docs, labels, doc_id, text, label), text, name).where(F.col(name) < threshold).drop(name)


def op6_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = score(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
