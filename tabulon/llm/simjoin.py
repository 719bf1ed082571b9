"""Jaccard self-join on word shingles with Bayesian pruning of candidate pairs.

A document is the set of its ``WIDTH``-word shingles (lower-cased words between white space; a text of fewer words is one
shingle). Documents with equal sets collapse to one node with a number of copies. Each node has ``BANDS`` keys of
``ROWS`` MinHash values each; nodes with a common key are candidates (at similarity 0.8 a pair has none with probability
3e-8). Candidates are compared by ``BITS`` further MinHash values of 8 bits, 16 at a time: with a uniform prior of
the similarity, a pair is dropped as soon as the posterior probability of reaching the threshold is below ``TOLERANCE``.
What is left is verified by the whole shingle sets.

A bucket of more than ``BLOCK`` nodes is cut into blocks, and tasks compare two blocks at a time. A pair is compared in
its first common band only and never becomes a row: blocks hand on partner lists, verified blocks hand on link counts
and a spanning forest. Classes are the connected components.

Defined cases: null, empty and blank texts have no shingles, no links and a class of their own; rows of equal id and text
count as copies of each other; texts of any length are compared whole; class ids are the smallest document id of
the class (null only if all are); an empty table gives no rows. Other columns are not read; ``keep_one`` passes them through.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tabulon.llm.common import free_name, let_go, spread, stored, table
from tabulon.operators.graph import components

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS, BITS = 24, 3, 64
TOLERANCE, STEP = 1e-6, 16
BLOCK = 512
#: Distinct words whose hashes a task keeps, candidate pairs compared at once, columns of a verification matrix.
WORDS_KEPT, PAIRS_AT_ONCE, COLUMNS = 500_000, 100_000, 4096

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 32, BANDS * ROWS + BITS, dtype=np.uint64) | 1).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS + BITS, dtype=np.uint64).astype(np.uint32)
_M1, _M2, _32 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _32)) * _M2
    x = (x ^ (x >> _32)) * _M2
    return x ^ (x >> _32)


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in {w for w in words if w not in known}:
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.array([known[w] for w in words], np.uint64)
        n = min(self.width, len(h))
        s = h[:len(h) - n + 1]
        for j in range(1, n):
            s = _mixed(s * _M1 + h[j:len(h) - n + 1 + j])
        return np.unique(_mixed(s + np.uint64(n)))


def signature(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(band keys, MinHash bytes)."""
    z = (shingles >> _32).astype(np.uint32)
    low = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(z), 4096):
        low = np.minimum(low, (z[k:k + 4096, None] * _A + _B).min(axis=0))
    rows = low[:BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    key = np.zeros(BANDS, np.uint64)
    for j in range(ROWS):
        key = _mixed(key * _M1 + rows[:, j] + np.uint64(1))
    return key, (low[BANDS * ROWS:] & 0xFF).astype(np.uint8).tobytes()


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For 16, 32, ... compared values, the fewest matches at which the posterior of the threshold is not below ``tolerance``."""
    p = np.linspace(1 / 256, 1, 200_001)[:-1] + 0.5 * (255 / 256) / 200_000
    high = p >= threshold + (1 - threshold) / 256
    out = {}
    for n in range(STEP, BITS + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            w = np.exp(log - log.max())
            if w[high].sum() >= tolerance * w.sum():
                out[n] = m
                break
    return out


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key)
        last = k[b.num_rows - 1].as_py()
        if held and held[0].column(key)[0].as_py() == last:  # all of it belongs to the group that is held
            held.append(b)
            continue
        other = np.flatnonzero(k.to_numpy(zero_copy_only=False) != last)
        cut = int(other[-1]) + 1 if len(other) else 0
        if held or cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
        held = [b.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _binary(column: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _pairs(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs within groups, ``PAIRS_AT_ONCE`` or one row's partners at a time."""
    rest = np.repeat(starts + sizes, sizes) - np.arange(sizes.sum()) - 1  # partners that follow in the group
    begin = 0
    ends = np.cumsum(rest)
    while begin < len(rest):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
        r = rest[begin:end]
        a = np.repeat(np.arange(begin, end), r)
        b = a + 1 + np.arange(r.sum()) - np.repeat(np.cumsum(r) - r, r)
        yield a, b
        begin = end


def _prune(threshold: float, tolerance: float):
    """Rows of candidate blocks to (unit, place, node, n, copies, partners) rows of nodes that still have partners."""
    need = least_matches(threshold, tolerance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for t in _runs(batches, "unit"):
            unit = t.column("unit").to_numpy()
            starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            sizes = np.diff(np.r_[starts, len(unit)])
            keys, bits = _binary(t.column("keys"), np.dtype("<u8"), BANDS), _binary(t.column("bits"), np.uint8, BITS)
            band, side, n = (t.column(c).to_numpy() for c in ("band", "side", "n"))
            one_block = t.column("one_block").to_numpy(zero_copy_only=False)
            kept_a, kept_b = [], []
            for a, b in _pairs(sizes, starts):
                ok = (one_block[a] | (side[a] != side[b])) & (np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1e-9)
                a, b = a[ok], b[ok]
                ok = (keys[a] == keys[b]).argmax(axis=1) == band[a]
                a, b = a[ok], b[ok]
                matches = np.zeros(len(a), np.int64)
                for k in range(0, BITS, STEP):
                    matches += (bits[a, k:k + STEP] == bits[b, k:k + STEP]).sum(axis=1)
                    ok = matches >= need[k + STEP]
                    a, b, matches = a[ok], b[ok], matches[ok]
                kept_a.append(a)
                kept_b.append(b)
            a, b = np.concatenate(kept_a), np.concatenate(kept_b)
            if not len(a):
                continue
            rows = np.union1d(a, b)
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            counts = np.searchsorted(a, rows, side="right") - np.searchsorted(a, rows, side="left")
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            picked = t.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([
                pa.array(unit[rows]), pa.array(rows, pa.int64()), picked.column("node").combine_chunks(), pa.array(n[rows], pa.int32()),
                picked.column("copies").combine_chunks(), pa.ListArray.from_arrays(pa.array(offsets), pa.array(b, pa.int64()))],
                ["unit", "place", "node", "n", "copies", "partners"])

    return run


def _verify(threshold: float):
    """Rows of pruned blocks with their shingles to (node, links, root): verified links and a spanning forest per block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for whole in _runs(batches, "unit"):
            units = whole.column("unit").to_numpy()
            starts = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
            nodes, links, roots = [], [], []
            for lo, hi in zip(starts, np.r_[starts[1:], len(units)]):
                t = whole.slice(lo, hi - lo)
                place, n, copies = (t.column(c).to_numpy() for c in ("place", "n", "copies"))
                local = {p: i for i, p in enumerate(place.tolist())}
                partners = t.column("partners").to_pylist()
                a = np.repeat(np.arange(len(place)), [len(p) for p in partners])
                b = np.array([local[p] for ps in partners for p in ps], np.int64)
                sets = [np.frombuffer(x, "<u8") for x in t.column("shingles").to_pylist()]
                _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
                row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                shared = count[column] > 1
                number = np.cumsum(count > 1) - 1
                row, column = row[shared], number[column[shared]]
                order = np.argsort(column, kind="stable")
                row, column = row[order], column[order]
                left, right = np.unique(a), np.unique(b)
                common = np.zeros((len(left), len(right)), np.float32)
                for k in range(0, int((count > 1).sum()), COLUMNS):
                    i, j = np.searchsorted(column, [k, k + COLUMNS])
                    x = np.zeros((len(sets), COLUMNS), np.float32)
                    x[row[i:j], column[i:j] - k] = 1
                    common += x[left] @ x[right].T
                both = common[np.searchsorted(left, a), np.searchsorted(right, b)]
                ok = both >= threshold * (n[a] + n[b] - both) - 1e-6
                a, b = a[ok], b[ok]
                if not len(a):
                    continue
                weight = np.bincount(a, copies[b], len(place)) + np.bincount(b, copies[a], len(place))
                root = np.arange(len(place))
                while True:  # smallest reachable place within the block
                    low = root.copy()
                    np.minimum.at(low, a, root[b])
                    np.minimum.at(low, b, root[a])
                    low = low[low]
                    if (low == root).all():
                        break
                    root = low
                name = t.column("node").to_pylist()
                for i in np.flatnonzero(weight):
                    nodes.append(name[i])
                    links.append(int(weight[i]))
                    roots.append(name[root[i]])
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(roots, pa.binary())],
                                             ["node", "links", "root"])
    return run


def _described(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(doc_id, tie, node, n, bands, keys, bits) of each row."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        make = Shingles(width)
        for b in batches:
            node, n, bands, keys, bits = [], [], [], [], []
            for name, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                s = make(text)
                key, low = signature(s)
                node.append(hashlib.md5(s.tobytes() if len(s) else f"without words {name}".encode()).digest())
                n.append(len(s))
                bands.append(key.view(np.int64))
                keys.append(key.astype("<u8").tobytes())
                bits.append(low)
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("tie"), pa.array(node, pa.binary()), pa.array(n, pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), pa.array(flat)),
                pa.array(keys, pa.binary()), pa.array(bits, pa.binary())], ["doc_id", "tie", "node", "n", "bands", "keys", "bits"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, tie long, node binary, n int, bands array<long>, keys binary, bits binary")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, width: int = WIDTH,
         tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """(doc_id, tie, class_id, n_links, n_copies, first): one row per row of ``docs``.

    ``n_links`` counts the other rows at ``threshold`` or more, ``n_copies`` the rows with the same shingles, ``first``
    marks the rows that are the class's smallest id (and among those the smallest hash of the text, ``tie``).
    """
    n_parts = spread(docs.sparkSession)
    rows = stored(_described(docs, doc_id, text, width), "shingle-signatures")
    nodes = stored(rows.groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "tie")).alias("rep"),
                                            F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("keys").alias("keys"),
                                            F.first("bits").alias("bits")), "shingle-nodes")
    some = nodes.where("n > 0")
    keyed = some.select("node", F.posexplode("bands").alias("band", "key"))
    crowded = keyed.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    found = keyed.join(crowded, ["band", "key"])
    # Blocks of a bucket meet two at a time; a block meets itself in the unit (i, i).
    found = (found.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
             .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .join(some.select("node", "n", "copies", "keys", "bits"), "node")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
             .select(F.xxhash64("band", "key", "i", "j").alias("unit"), "band", (F.col("mine") == F.col("i")).alias("side"),
                     (F.col("i") == F.col("j")).alias("one_block"), "node", "n", "copies", "keys", "bits"))
    pruned = stored(found.repartition(n_parts, "unit").sortWithinPartitions("unit").mapInArrow(
        _prune(threshold, tolerance), "unit long, place long, node binary, n int, copies long, partners array<long>"), "pruned-blocks")
    # The whole shingle sets of the nodes that are left, from one text of each.
    wanted = nodes.join(pruned.select("node").distinct(), "node", "left_semi").select("node", "rep.doc_id", "rep.tie")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    texts = (texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["tie"] == wanted["tie"]))
             .select("node", "text").dropDuplicates(["node"]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        make = Shingles(width)
        for b in batches:
            sets = [make(x).astype("<u8").tobytes() for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])

    sets = texts.mapInArrow(cut, "node binary, shingles binary")
    verified = stored(pruned.join(sets, "node").repartition(n_parts, "unit").sortWithinPartitions("unit").select(
        "unit", "place", "node", "n", "copies", "partners", "shingles").mapInArrow(
        _verify(threshold), "node binary, links long, root binary"), "verified-links")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.select(F.col("node").alias("u"), F.col("root").alias("v")))
    linked = nodes.select("node", "rep", "copies", "n").join(classes, "node", "left").join(links, "node", "left")
    linked = stored(linked.select("node", "rep", F.coalesce("root", "node").alias("root"),
                                  (F.when(F.col("n") > 0, F.col("copies") - 1).otherwise(0) + F.coalesce("links", F.lit(0))).alias("n_links"),
                                  F.when(F.col("n") > 0, F.col("copies")).otherwise(1).cast("long").alias("n_copies")), "shingle-classes")
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    linked = linked.join(least, "root").select("node", "n_links", "n_copies", "least")
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("tie") == F.col("least.tie"))
    return rows.select("doc_id", "tie", "node").join(linked, "node").select(
        "doc_id", "tie", F.col("least.doc_id").alias("class_id"), "n_links", "n_copies", first.alias("first"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id (then the smallest hash of the text)."""
    i, t = free_name(docs, "_kept_id"), free_name(docs, "_tie")
    kept = join(docs, doc_id, text, **options).where("first").select(F.col("doc_id").alias(i), F.col("tie").alias(t)).distinct()
    k = free_name(docs, "_key")
    # One key that null ids share.
    key = lambda a, b: F.concat_ws(":", F.coalesce(a.cast("string"), F.lit("null")), b.cast("string"))
    keyed = docs.withColumn(k, key(F.col(doc_id), F.xxhash64(text)))
    return keyed.join(kept.select(key(F.col(i), F.col(t)).alias(k)), k, "left_semi").dropDuplicates([k]).drop(k)


def op10_jaccard_join(spark, folder):
    return join(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT k, doc_id, list_distinct([array_to_string(w[i + 1 : i + {WIDTH}], ' ') FOR i IN range(greatest(1, len(w) - {WIDTH - 1}))]) AS s FROM d WHERE len(w) > 0),
x AS (SELECT k, doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.k AS u, b.k AS v FROM x a JOIN x b ON a.g = b.g AND a.k < b.k GROUP BY a.k, b.k, a.n, b.n
      HAVING count(*) >= {THRESHOLD} * (a.n + b.n - count(*)) - 1e-6),
e AS (SELECT u, v FROM p UNION ALL SELECT v, u FROM p),
r AS (SELECT k AS node, k AS seen FROM d UNION SELECT r.node, e.v FROM r JOIN e ON r.seen = e.u),
c AS (SELECT node, min(doc_id) AS class_id FROM r JOIN d ON r.seen = d.k GROUP BY node),
l AS (SELECT u, count(*) AS n_links FROM e GROUP BY u),
m AS (SELECT k, count(*) OVER (PARTITION BY list_sort(s)) AS n_copies FROM s)
SELECT d.doc_id, c.class_id, coalesce(l.n_links, 0) AS n_links, coalesce(m.n_copies, 1) AS n_copies
FROM d JOIN c ON d.k = c.node LEFT JOIN l ON d.k = l.u LEFT JOIN m ON d.k = m.k"""
