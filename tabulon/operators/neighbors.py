"""Exact nearest neighbours as a partitioned, pruned block join.

Reference rows fall into at most ``COARSE`` regions by a k-d split that the driver fits on a
bounded sample. A task per region fits the fine split of that region into boxes, again on a
bounded sample; splits and bounding boxes of the boxes stay in DataFrames, which grow with the
table. A box with many rows (also one full of copies) is cut further into blocks. Where a query needs
most boxes anyhow (many dimensions, few rows), blocks of queries meet all rows instead. Otherwise a query first
meets its own box, which bounds its k-th distance. Queries of neighbouring boxes then go to a task
together with the boxes closer than the bound of any of them, which the task meets one after the
other while the bounds shrink. Blocks are compared with NumPy and give back k rows per query, never
pairs.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabulon.session import cut

BLOCK_ROWS = 2048
# Regions of the coarse split, and rows (about so many, drawn from every partition) on which the split of the table or of
# a region is fitted. Results do not depend on them: a box that holds more rows than a block is cut into blocks.
COARSE, SAMPLE_ROWS = 64, 20_000
# Rows of a region that one task takes to its fine split or to its boxes.
REGION_ROWS = 100_000
GROUPS_PER_TASK = 64
# Queries of a block at most, fewer if that leaves cores idle; queries of one matrix product, and pairs whose distances are
# added up at once.
ASKED_ROWS, ASKS, PAIRS = 8192, 256, 1 << 12
# Least columns for which absolute differences go through a matrix product, numbers of it that stand for a column, and cells
# of a column's values on which they are fitted.
MANY, STEPS, CELLS = 16, 8, 64
# Sampled rows that tell whether boxes are worth their while, and the share of the boxes that such a row may need.
PROBES, FEW_BOXES = 128, 0.5


# ---- k-d boxes ------------------------------------------------------------------------------

class _Boxes:
    """A k-d split: node arrays for assignment."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.dim, self.cut, self.left, self.right, self.leaf = [], [], [], [], []
        self.n_leaves = 0
        waiting = [(sample, leaves, None, None)]
        while waiting:
            rows, leaves, side, parent = waiting.pop()
            node, more = self._grow(rows, leaves)
            if side is not None:
                side[parent] = node
            waiting += more
        for name in ("dim", "cut", "left", "right", "leaf"):
            setattr(self, name, np.asarray(getattr(self, name)))

    def _node(self, dim, cut_, leaf):
        self.dim.append(dim)
        self.cut.append(cut_)
        self.left.append(-1)
        self.right.append(-1)
        self.leaf.append(leaf)
        return len(self.dim) - 1

    def _grow(self, rows, leaves):
        spread = rows.max(0) - rows.min(0) if len(rows) else np.zeros(1)
        if leaves <= 1 or len(rows) < 2 or spread.max() <= 0:
            node = self._node(0, 0.0, self.n_leaves)
            self.n_leaves += 1
            return node, []
        d = int(spread.argmax())
        at = float(np.median(rows[:, d]))
        if at >= rows[:, d].max():
            at = float(rows[rows[:, d] < at, d].max())
        node = self._node(d, at, -1)
        below = rows[:, d] <= at
        # Boxes in proportion to the rows: a rare value of a 0/1 column gets few, the others keep theirs.
        first = min(leaves - 1, max(1, round(leaves * below.mean())))
        return node, [(rows[~below], leaves - first, self.right, node), (rows[below], first, self.left, node)]

    def assign(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = self.leaf[node] < 0
            if not inner.any():
                return self.leaf[node]
            at = node[inner]
            below = x[inner, self.dim[at]] <= self.cut[at]
            node[inner] = np.where(below, self.left[at], self.right[at])


def boxes_within(lo: np.ndarray, hi: np.ndarray, x: np.ndarray, bound: np.ndarray, power: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, box) index pairs of the boxes whose distance**power is within the row's bound."""
    rows, boxes = [np.zeros(0, int)], [np.zeros(0, int)]
    step = max(1, 4_000_000 // max(1, len(lo)))
    for s in range(0, len(x), step):
        part = x[s:s + step]
        acc = np.zeros((len(part), len(lo)))
        for j in range(x.shape[1]):
            v = part[:, j:j + 1]
            gap = np.maximum(np.maximum(lo[None, :, j] - v, v - hi[None, :, j]), 0.0)
            acc += gap ** power
        r, b = np.nonzero(acc <= bound[s:s + step, None] * (1 + 1e-9) + 1e-300)
        rows.append(r + s)
        boxes.append(b)
    return np.concatenate(rows), np.concatenate(boxes)


def _power(metric: str, p: float) -> float:
    if metric == "euclidean":
        return 2.0
    if metric == "manhattan":
        return 1.0
    if metric == "minkowski":
        return float(p)
    raise ValueError(f"unknown metric {metric}")


def power_sums(a: np.ndarray, b: np.ndarray, power: float) -> np.ndarray:
    """Sum over features of |a_i - b_j|**power, added in feature order."""
    acc, columns = np.zeros((len(a), len(b))), np.ascontiguousarray(b.T)
    step = max(1, (1 << 14) // max(1, len(b)))  # what stays in a core's cache
    for s in range(0, len(a), step):
        part = acc[s:s + step]
        diff = np.empty_like(part)
        for j in range(a.shape[1]):
            np.subtract(a[s:s + step, j:j + 1], columns[j], out=diff)
            if power == 2.0:
                np.multiply(diff, diff, out=diff)
            else:
                np.abs(diff, out=diff)
                if power != 1.0:
                    np.power(diff, power, out=diff)
            part += diff
    return acc


def k_smallest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest entries of every row; earlier columns win ties."""
    if d.shape[1] <= k:
        return tuple(g.ravel() for g in np.indices(d.shape))
    kth = np.partition(d, k - 1, axis=1)[:, k - 1:k]
    less = d < kth
    tie = d == kth
    room = k - less.sum(axis=1, keepdims=True)
    return np.nonzero(less | (tie & (np.cumsum(tie, axis=1) <= room)))


def _steps(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edges, u) of functions u, linear between the edges, whose summed squared differences never exceed |a - b|.

    |a - b| is the squared norm of the indicator of the values between a and b. ``u`` holds its products with orthonormal
    functions, constant in each cell, that keep most of it for values distributed like the given ones.
    """
    values = np.sort(values[np.isfinite(values)])
    edges = np.unique(values[np.linspace(0, len(values) - 1, CELLS + 1).astype(int)]) if len(values) else values
    if len(edges) < 2:
        return edges[:1], np.zeros((0, 1))
    root = np.sqrt(np.diff(edges))
    below = np.searchsorted(values, (edges[1:] + edges[:-1]) / 2) / len(values)
    basis = np.linalg.eigh(root[:, None] * (np.minimum.outer(below, below) - np.outer(below, below)) * root)[1][:, -STEPS:]
    u = np.concatenate([np.zeros((1, basis.shape[1])), np.cumsum(basis * root[:, None], axis=0)])
    return edges, np.ascontiguousarray((u - u[len(u) // 2]).T)


class _Sieve:
    """Estimates of distance**power, power 1 or 2, in single precision, by one matrix product: at most ``slack`` above it; for
    power 2 not more below it either."""

    def __init__(self, x: np.ndarray, refs: np.ndarray, power: float):
        self.point, self.both = np.nan_to_num(refs[0]), power == 2.0
        self.steps = None if self.both else [_steps(c) for c in refs.T]
        left = self._numbers(x)
        self.wide = self._wide(x)
        self.squares = np.nansum(left * left, axis=1)
        self.far = np.nansum(np.abs(x), axis=1)
        with np.errstate(over="ignore", invalid="ignore"):
            self.near = None if self.both else (x - self.point).astype(np.float32)
            self.left = np.hstack([-2 * left, (left * left).sum(1)[:, None], np.ones((len(x), 1))]).astype(np.float32)
        self.out, self.marks = np.empty((ASKS, BLOCK_ROWS), np.float32), np.empty((ASKS, BLOCK_ROWS), bool)

    def sums(self, asks: np.ndarray, refs: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Absolute differences of pairs of queries and rows, summed in single precision."""
        q, b = self.near[asks], (refs - self.point).astype(np.float32)
        out = np.empty(len(i), np.float32)
        for s in range(0, len(i), PAIRS):
            gaps = q[i[s:s + PAIRS]]
            gaps -= b[j[s:s + PAIRS]]
            np.abs(gaps, out=gaps).sum(axis=1, out=out[s:s + PAIRS])
        return out

    def _wide(self, x: np.ndarray) -> float:
        return float(np.fmax.reduce(np.abs(x - self.point), axis=None, initial=0))

    def _numbers(self, x: np.ndarray) -> np.ndarray:
        if self.both:
            return x - self.point
        out = []
        for c, (edges, u) in zip(x.T, self.steps):
            if len(u):
                place = np.interp(c, edges, np.arange(len(edges)))
                cell = np.minimum(np.nan_to_num(place).astype(int), len(edges) - 2)
                out.append(u[:, cell] + (place - cell) * (u[:, cell + 1] - u[:, cell]))
        return np.concatenate(out).T if out else np.zeros((len(x), 0))

    def right(self, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The right factor and per query the slack; none where single precision does not hold the squares."""
        wide = max(self.wide, self._wide(refs))
        if not 1e-12 < wide < 1e15:
            return None
        right = self._numbers(refs)
        squares = (right * right).sum(1)
        around = self.squares + np.fmax.reduce(squares, initial=0)
        eps = float(np.finfo(np.float32).eps)
        slack = 4 * (right.shape[1] + 8) * eps * around
        if self.both:
            given = 2 * around + 4 * (self.point ** 2).sum()
            slack += 1e-13 * np.sqrt(around * given) + 1e-30 * given + 1e-38
        else:
            around = np.nansum(np.abs(self.near), axis=1) + np.nansum(np.abs(refs - self.point), axis=1).max()
            slack += 4 * (refs.shape[1] + 8) * eps * around + 1e-12 * (self.far + np.nansum(np.abs(refs), axis=1).max()) + 1e-38
        return np.vstack([right.T, np.ones(len(refs)), squares]).astype(np.float32), slack


class _Nearer:
    """Queries that meet boxes one after the other; the k-th smallest distance so far, or the bound given, is the bound of each."""

    def __init__(self, x: np.ndarray, home: np.ndarray, bound: np.ndarray, k: int, power: float):
        self.x, self.home, self.k, self.power = x, home, k, power
        self.bound = np.where(np.isnan(bound), np.inf, bound)
        self.near = np.full((len(x), k), np.inf)
        self.sieve = None

    def meet(self, leaf: int, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, distance**power) within the bound, at most k per query; rows of equal distance in their order."""
        low, high = np.fmin.reduce(refs)[None], np.fmax.reduce(refs)[None]
        asks = boxes_within(low, high, self.x, self.bound, self.power)[0]
        asks = asks[self.home[asks] != leaf]
        right = None
        if len(asks) and (self.power == 2.0 or self.power == 1.0 and refs.shape[1] >= MANY):
            self.sieve = self.sieve or _Sieve(self.x, refs, self.power)
            right = self.sieve.right(refs)
        found = [self._some(asks[s:s + ASKS], refs, right) for s in range(0, len(asks), ASKS)]
        return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))

    def _some(self, asks: np.ndarray, refs: np.ndarray, right: tuple[np.ndarray, np.ndarray] | None):
        q, k, bound = self.x[asks], self.k, self.bound[asks]
        i, j, d = self._full(q, refs, bound) if right is None else self._sieved(asks, refs, *right)
        keep = d <= bound[i]
        i, j, d = i[keep], j[keep], d[keep]
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        i, j, d, rank = i[rank < k], j[rank < k], d[rank < k], rank[rank < k]
        new = np.full((len(asks), k), np.inf)
        new[i, rank] = d
        self.near[asks] = np.partition(np.hstack([self.near[asks], new]), k - 1, axis=1)[:, :k]
        self.bound[asks] = np.minimum(bound, self.near[asks].max(1))
        return asks[i], j, d

    def _full(self, q: np.ndarray, refs: np.ndarray, bound: np.ndarray):
        """(query, row, distance**power) of all pairs within the bound, but for rows beyond the k nearest of these."""
        sums, reach = power_sums(q, refs, self.power), bound.copy()
        within = sums <= reach[:, None]
        many = np.flatnonzero(np.count_nonzero(within, axis=1) > self.k)
        if len(many):
            reach[many] = np.fmin(reach[many], np.partition(sums[many], self.k - 1, axis=1)[:, self.k - 1])
            within[many] = sums[many] <= reach[many, None]
        i, j = np.divmod(np.flatnonzero(within), len(refs))
        return i, j, sums[i, j]

    def _sieved(self, asks: np.ndarray, refs: np.ndarray, right: np.ndarray, slack: np.ndarray):
        """As ``_full``, of the pairs that the sieve lets through."""
        k, n, slack, sieve = self.k, len(refs), slack[asks], self.sieve
        kept = len(asks) <= len(sieve.out) and n <= sieve.out.shape[1]
        out, marks = (a[:len(asks)].reshape(-1)[:len(asks) * n].reshape(-1, n) if kept else None for a in (sieve.out, sieve.marks))
        sums = np.matmul(sieve.left[asks], right, out=out)
        reach = self.bound[asks] * (1 + 1e-6) + slack
        flat = np.flatnonzero(np.less_equal(sums, reach[:, None].astype(np.float32), out=marks))
        i, j = np.divmod(flat, n)
        many = np.flatnonzero(np.bincount(i, minlength=len(asks)) > (1 if sieve.both else 4) * k)
        if len(many):
            some = sums[many]
            if sieve.both:
                kth = np.maximum(np.partition(some, k - 1, axis=1)[:, k - 1].astype(float), 0) * (1 + 1e-6) + slack[many]
            else:
                # The distances of the rows that look nearest bound the k-th one.
                at = np.argpartition(some, 2 * k, axis=1)[:, :2 * k]
                seeds = self._distances(self.x[asks[many]], refs, np.repeat(np.arange(len(many)), 2 * k), at.ravel())
                kth = np.partition(seeds.reshape(-1, 2 * k), k - 1, axis=1)[:, k - 1]
            reach[many] = np.fmin(reach[many], kth * (1 + 1e-6) + slack[many])
            inside = sums.reshape(-1)[flat] <= reach.astype(np.float32)[i]
            i, j = i[inside], j[inside]
        if not sieve.both:
            inside = sieve.sums(asks, refs, i, j) <= reach[i]
            i, j = i[inside], j[inside]
        return i, j, self._distances(self.x[asks], refs, i, j)

    def _distances(self, q: np.ndarray, refs: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """distance**power of pairs, one by one in feature order, as in ``power_sums``."""
        out = [np.zeros(0)]
        for s in range(0, len(i), PAIRS):
            gaps = q[i[s:s + PAIRS]]
            gaps -= refs[j[s:s + PAIRS]]
            gaps = np.multiply(gaps, gaps, out=gaps) if self.power == 2.0 else np.abs(gaps, out=gaps)
            out.append(np.cumsum(gaps, axis=1, out=gaps)[:, -1].copy())
        return np.concatenate(out)


# ---- join ------------------------------------------------------------------------------------

def _vector(features: Sequence[str]):
    return F.array(*[F.col(c).cast("double") for c in features])


def _matrix(col: pd.Series, width: int) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(float) if len(col) else np.zeros((0, width))


def partitions_for(spark, groups: int) -> int:
    """Shuffle partitions for so many compute-heavy groups."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, min(2 * groups, max(least, -(-groups // GROUPS_PER_TASK))))


def _compare(asks: DataFrame, refs: DataFrame, ref_sizes: DataFrame, k: int, power: float, width: int, payload: list[str],
             types: dict) -> DataFrame:
    """Top-k of every (query block, reference block) of the same box, merged per query; ``ref_sizes`` is (leaf, rows)."""
    blocks = cut(asks.groupBy("leaf").agg(F.count("*").alias("c")).join(ref_sizes, "leaf").select(
        "leaf", F.ceil(F.col("c") / BLOCK_ROWS).alias("n_ab"), F.ceil(F.col("rows") / BLOCK_ROWS).alias("n_rb")))

    def one(id_name, n):
        return F.pmod(F.xxhash64(id_name), F.col(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    a = asks.join(blocks, "leaf").withColumn("ab", one("query_id", "n_ab")).withColumn("rb", every("n_rb"))
    r = refs.join(blocks, "leaf").withColumn("rb", one("neighbor_id", "n_rb")).withColumn("ab", every("n_ab"))
    a = a.select("leaf", "ab", "rb", "query_id", "x")
    r = r.select("leaf", "ab", "rb", "neighbor_id", "x", *payload)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = {"query_id": [], "neighbor_id": [], "psum": [], **{c: [] for c in payload}}
        if not len(left) or not len(right):
            return pd.DataFrame(empty, dtype=object)
        right = right.sort_values("neighbor_id", kind="stable")
        q, b = _matrix(left["x"], width), _matrix(right["x"], width)
        out = []
        for s in range(0, len(q), 512):
            d = power_sums(q[s:s + 512], b, power)
            i, j = k_smallest(d, k)
            got = {"query_id": left["query_id"].to_numpy()[s:s + 512][i],
                   "neighbor_id": right["neighbor_id"].to_numpy()[j], "psum": d[i, j]}
            for c in payload:
                got[c] = right[c].to_numpy()[j]
            out.append(pd.DataFrame(got))
        return pd.concat(out, ignore_index=True)

    schema = T.StructType([
        T.StructField("query_id", types["query_id"]), T.StructField("neighbor_id", types["neighbor_id"]),
        T.StructField("psum", T.DoubleType()), *[T.StructField(c, types[c]) for c in payload]])
    keys = ["leaf", "ab", "rb"]
    # A fixed partition number: the work is in the comparison, which small input bytes would hide from AQE.
    n = partitions_for(a.sparkSession, int(blocks.agg(F.sum(F.col("n_ab") * F.col("n_rb"))).first()[0] or 0))
    a, r = a.repartition(n, *keys), r.repartition(n, *keys)
    return a.groupBy(*keys).cogroup(r.groupBy(*keys)).applyInPandas(best, schema)


def _keep_best(near: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("psum", "neighbor_id")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(queries: DataFrame, refs: DataFrame, features: Sequence[str], k: int, id_col: str,
            payload: Iterable[str] = (), metric: str = "euclidean", p: float = 2.0) -> DataFrame:
    """The k nearest reference rows of every query.

    Result: (query_id, neighbor_id, rank, distance, payload...). Ties go to the smaller
    id. A query that is itself a reference row finds itself at distance 0.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    features, payload = list(features), list(payload)
    power, width = _power(metric, p), len(features)
    # Copies: only the k smallest ids of equal rows can be among anybody's k nearest, and equal
    # queries have equal answers, so a value held by a third of all rows is compared once.
    copies = Window.partitionBy("x").orderBy("neighbor_id")
    r = cut(refs.select(F.col(id_col).alias("neighbor_id"), _vector(features).alias("x"), *payload)
            .withColumn("_c", F.row_number().over(copies)).where(F.col("_c") <= k).drop("_c"))
    asked_all = queries.select(F.col(id_col).alias("query_id"), _vector(features).alias("x"))
    q = cut(asked_all.groupBy("x").agg(F.min("query_id").alias("query_id")))
    # Ids of equal queries, so that no vector goes along with the neighbours.
    alike = asked_all.join(q.withColumnRenamed("query_id", "_first"), "x").drop("x")
    near = (_nearest_distinct(q, r, k, power, width, payload).withColumnRenamed("query_id", "_first")
            .join(alike, "_first").drop("_first"))
    dist = F.sqrt("psum") if power == 2.0 else F.col("psum") if power == 1.0 else F.pow("psum", F.lit(1 / power))
    return near.select("query_id", "neighbor_id", "rank", dist.alias("distance"), *payload)


def _tasks(counts: dict[int, int]):
    """Number of tasks for the rows of the row's region; ``counts`` has at most ``COARSE`` entries."""
    several = {c: -(-n // REGION_ROWS) for c, n in counts.items() if n > REGION_ROWS}
    if not several:
        return F.lit(1)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in several.items() for v in kv]), F.col("region")), F.lit(1))


def _with_region(rows: DataFrame, per_region: DataFrame, id_name: str, tasks, work, schema: T.StructType) -> DataFrame:
    """``work(rows, per_region)`` of each region; the rows of a region are dealt to ``tasks`` tasks, each of which gets what
    ``per_region`` has of it."""
    dealt = rows.withColumn("_t", F.pmod(F.xxhash64(id_name), tasks).cast("int"))
    given = per_region.withColumn("_t", F.explode(F.sequence(F.lit(0), tasks - 1)))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({f.name: [] for f in schema}, dtype=object)
        return work(left, right)
    return dealt.groupBy("region", "_t").cogroup(given.groupBy("region", "_t")).applyInPandas(run, schema)


def _region(split: _Boxes, node: int = 0):
    """The region of column ``x``, as nested conditions over at most ``COARSE`` leaves."""
    if split.leaf[node] >= 0:
        return F.lit(int(split.leaf[node]))
    below = F.col("x")[int(split.dim[node])] <= float(split.cut[node])
    return F.when(below, _region(split, int(split.left[node]))).otherwise(_region(split, int(split.right[node])))


def _fine_splits(rows: DataFrame, counts: dict[int, int], width: int) -> DataFrame:
    """(region, split): the pickled split of each region into boxes of about ``BLOCK_ROWS`` rows."""
    rates = F.create_map(*[F.lit(v) for c, n in counts.items() for v in (c, min(1.0, SAMPLE_ROWS / n))])
    sample = rows.where(F.pmod(F.xxhash64(F.lit(7), "x"), F.lit(1 << 20)) < rates[F.col("region")] * (1 << 20)).select("region", "x")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        c = int(pdf["region"].iloc[0])
        split = _Boxes(_matrix(pdf["x"], width), max(1, counts[c] // BLOCK_ROWS))
        return pd.DataFrame({"region": [c], "split": [pickle.dumps(split)]})
    fitted = sample.groupBy("region").applyInPandas(fit, "region int, split binary")
    # A region whose sample is empty is one box.
    every = rows.sparkSession.createDataFrame([(c,) for c in counts], "region int")
    return cut(every.join(fitted, "region", "left"))


def _boxed(rows: DataFrame, splits: DataFrame, id_name: str, tasks, width: int) -> DataFrame:
    """``rows`` with ``leaf``, the number of their box: the region's in the upper half, the box's within it in the lower."""
    schema = T.StructType([*rows.schema, T.StructField("leaf", T.LongType())])
    names = rows.columns

    def place(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        split = right["split"].iloc[0]
        inside = pickle.loads(split).assign(_matrix(left["x"], width)) if split is not None else np.zeros(len(left), int)
        return left[names].assign(leaf=(int(left["region"].iloc[0]) << 32) + inside.astype("int64"))
    return cut(_with_region(rows, splits, id_name, tasks, place, schema))


def _nearest_distinct(q: DataFrame, r: DataFrame, k: int, power: float, width: int, payload: list[str]) -> DataFrame:
    types = {f.name: f.dataType for f in [*r.schema, *q.schema]}
    n = r.count()
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    sample = r.select("x") if share >= 1.0 else r.sample(share, seed=7).select("x")
    rows = _matrix(sample.toPandas()["x"], width)
    if n > k and _needs_most_boxes(rows, n, k, power):
        return _keep_best(_streamed(q, r, k, power, width, payload, types), k)
    split = _Boxes(rows, min(COARSE, max(1, n // BLOCK_ROWS)))
    region = _region(split)
    r = r.withColumn("region", region)
    counts = {c: m for c, m in r.groupBy("region").count().collect()}
    if not counts:
        return _keep_best(r.select(F.lit(None).cast(types["query_id"]).alias("query_id"), "neighbor_id", F.lit(0.0).alias("psum"), *payload), k)
    # Queries may lie in regions without references: those have no box of their own and no bound.
    splits = _fine_splits(r, counts, width)
    # A region has at most all queries, each once.
    all_asked = F.lit(max(1, -(-q.count() // REGION_ROWS)))
    r = _boxed(r, splits, "neighbor_id", _tasks(counts), width)
    homes = _boxed(q.withColumn("region", region), splits, "query_id", all_asked, width)

    def corner(f):
        return F.array(*[f(F.col("x")[j]) for j in range(width)])
    boxes = cut(r.groupBy("region", "leaf").agg(F.count("*").alias("rows"), corner(F.min).alias("lo"), corner(F.max).alias("hi")))
    sizes = boxes.select("leaf", "rows")
    own = cut(_keep_best(_compare(homes, r, sizes, k, power, width, payload, types), k))
    bound = own.groupBy("query_id").agg(F.max("psum").alias("m"), F.count("*").alias("c")).select(
        "query_id", F.when(F.col("c") >= k, F.col("m")).alias("bound"))
    asked = (q.join(homes.select("query_id", F.col("leaf").alias("home")), "query_id", "left")
             .join(bound, "query_id", "left").select("query_id", "x", F.coalesce("home", F.lit(-1).cast("long")).alias("home"), "bound"))
    asked, n_blocks = _in_blocks(asked, q.count())
    # At most ``COARSE`` rows.
    outer = boxes.groupBy("region").agg(*[f(F.col(c)[j]).alias(f"{c}{j}") for c, f in (("lo", F.min), ("hi", F.max)) for j in range(width)]).toPandas()
    names = outer["region"].to_numpy()
    corners = [outer[[f"{c}{j}" for j in range(width)]].to_numpy(float).reshape(-1, width) for c in ("lo", "hi")]

    def visit(batches):
        for pdf in batches:
            for block, part in pdf.groupby("block"):
                near = _needed(*corners, _matrix(part["x"], width), _bounds(part["bound"]), power)
                yield pd.DataFrame({"block": block, "region": names[near]})
    visits = asked.select("block", "x", "bound").mapInPandas(visit, "block long, region int").distinct()

    def narrow(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"block": [], "leaf": []}, dtype="int64")
        near = _needed(_matrix(right["lo"], width), _matrix(right["hi"], width), _matrix(left["x"], width), _bounds(left["bound"]), power)
        leaves = right["leaf"].to_numpy()[near]
        home = left["home"].to_numpy()
        return pd.DataFrame({"block": left["block"].iloc[0], "leaf": leaves[leaves != home[0]] if (home == home[0]).all() else leaves})
    wanted = cut(asked.groupBy("block").cogroup(visits.join(boxes.drop("rows"), "region").groupBy("block"))
                 .applyInPandas(narrow, "block long, leaf long"))
    merged = own.select("query_id", "neighbor_id", "psum", *payload).unionByName(
        _nearer(asked, r.join(wanted, "leaf"), n_blocks, k, power, width, payload, types))
    return _keep_best(merged, k)


def _needs_most_boxes(rows: np.ndarray, n: int, k: int, power: float) -> bool:
    """Whether a query needs most boxes of ``n`` rows, of which ``rows`` is a sample: many dimensions, or few rows."""
    rows = rows[np.isfinite(rows).all(1)]
    if n <= 2 * BLOCK_ROWS or not len(rows):
        return n <= BLOCK_ROWS
    box = (split := _Boxes(rows, min(n // BLOCK_ROWS, max(2, len(rows) // 16)))).assign(rows)
    order = np.argsort(box, kind="stable")
    starts = np.searchsorted(box[order], np.arange(split.n_leaves))
    lo, hi = np.minimum.reduceat(rows[order], starts), np.maximum.reduceat(rows[order], starts)
    probes = rows[::max(1, len(rows) // PROBES)]
    # A probe is a row itself; the k-th distance within a sample stands for that of all rows.
    bound = np.sort(np.vstack([power_sums(probes[s:s + 16], rows, power) for s in range(0, len(probes), 16)]), axis=1)[:, min(k, len(rows) - 1)]
    return len(boxes_within(lo, hi, probes, bound, power)[0]) > FEW_BOXES * len(probes) * len(lo)


def _streamed(q: DataFrame, r: DataFrame, k: int, power: float, width: int, payload: list[str], types: dict) -> DataFrame:
    """The k nearest rows of every query where boxes would exclude few: every block of queries meets all rows, in order of their ids."""
    cores, asked = q.sparkSession.sparkContext.defaultParallelism, q.count()
    n = max(1, -(-asked // ASKED_ROWS), min(cores, -(-asked // ASKS)))
    n = n if n <= cores else -(-n // cores) * cores
    block = F.pmod(F.xxhash64("x"), F.lit(n)).cast("long")
    asks = q.select("query_id", "x", F.lit(-1).cast("long").alias("home"), F.lit(None).cast("double").alias("bound"), block.alias("block"))
    refs = r.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("block"), F.lit(0).cast("long").alias("leaf"),
                    "neighbor_id", "x", *payload)
    return _nearer(asks, refs, n, k, power, width, payload, types)


def _bounds(col: pd.Series) -> np.ndarray:
    return col.fillna(np.inf).to_numpy(dtype=float)


def _needed(lo: np.ndarray, hi: np.ndarray, x: np.ndarray, bound: np.ndarray, power: float) -> np.ndarray:
    """Which boxes are within the bound of any row."""
    needed = np.zeros(len(lo), bool)
    for s in range(0, len(x), ASKS):
        rest = np.flatnonzero(~needed)
        if len(rest):
            needed[rest[boxes_within(lo[rest], hi[rest], x[s:s + ASKS], bound[s:s + ASKS], power)[1]]] = True
    return needed


def _in_blocks(asked: DataFrame, n: int) -> tuple[DataFrame, int]:
    """``asked`` with ``block``, stretches of about equal size in the order of ``home``, and the number of blocks."""
    cores = asked.sparkSession.sparkContext.defaultParallelism
    size = max(ASKS, min(ASKED_ROWS, -(-n // (2 * cores))))
    # One row per box. Rows of a box are dealt to its places by hash.
    before = F.sum("c").over(Window.orderBy("home").rowsBetween(Window.unboundedPreceding, -1))
    places = asked.groupBy("home").agg(F.count("*").alias("c")).select("home", "c", F.coalesce(before, F.lit(0)).alias("before"))
    block = F.floor((F.col("before") + F.pmod(F.xxhash64("x"), F.col("c"))) / size).cast("long")
    return cut(asked.join(places, "home").withColumn("block", block).drop("c", "before")), max(1, -(-n // size))


def _nearer(asked: DataFrame, refs: DataFrame, n_blocks: int, k: int, power: float, width: int, payload: list[str],
            types: dict) -> DataFrame:
    """The k nearest rows of ``refs``, at most, of every query of the same block that are within its bound and not of its home."""
    def nothing(name):
        return F.lit(None).cast(types[name]).alias(name)
    rows = (asked.select("block", F.lit(0).alias("side"), F.col("home").alias("leaf"), "query_id", nothing("neighbor_id"), "x",
                         "bound", *map(nothing, payload))
            .unionByName(refs.select("block", F.lit(1).alias("side"), "leaf", nothing("query_id"), "neighbor_id", "x",
                                     F.lit(None).cast("double").alias("bound"), *payload)))
    n = partitions_for(asked.sparkSession, n_blocks)
    rows = (rows.repartitionById(n, F.pmod("block", F.lit(n)).cast("int"))
            .sortWithinPartitions("block", "side", "leaf", "neighbor_id"))
    given = ["neighbor_id", *payload]

    def best(found: list[pd.DataFrame]) -> pd.DataFrame:
        """The k smallest of each query among all found so far; ties go to the smaller id."""
        return (pd.concat(found, ignore_index=True).sort_values(["_q", "psum", "neighbor_id"], na_position="first", kind="stable")
                .groupby("_q", sort=False).head(k))

    def finish(ids, found) -> Iterator[pa.RecordBatch]:
        if found:
            done = best(found)
            out = done.assign(query_id=ids.to_numpy()[done["_q"].to_numpy()])
            yield from pa.Table.from_pandas(out[["query_id", "neighbor_id", "psum", *payload]], form, preserve_index=False).to_batches(10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asks, near, ids, found, held = None, [], None, None, [], 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("block", "side", "leaf")])
            keys[2, keys[1] == 0] = 0
            cuts = [0, *(np.flatnonzero((np.diff(keys) != 0).any(0)) + 1).tolist(), b.num_rows]
            starts = [(t, min(t + BLOCK_ROWS, e)) for s, e in zip(cuts, cuts[1:]) for t in range(s, e, BLOCK_ROWS)]
            for s, e in starts:
                part, (block, side, leaf) = b.slice(s, e - s), keys[:, s].tolist()
                if block != now:
                    yield from finish(ids, found)
                    now, asks, near, found, held = block, [], None, [], 0
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(e - s, width)
                if not side:
                    asks.append((part.column("query_id").to_pandas(), x, part.column("leaf").to_numpy(),
                                 part.column("bound").to_numpy(zero_copy_only=False).astype(float)))
                    continue
                if near is None:
                    ids, *rest = zip(*asks)
                    ids, near = pd.concat(ids, ignore_index=True), _Nearer(*map(np.concatenate, rest), k, power)
                i, j, d = near.meet(leaf, x)
                if len(i):
                    got = part.select(given).to_pandas().iloc[j].reset_index(drop=True)
                    found.append(got.assign(_q=i, psum=d))
                    held += len(i)
                    if held > 4 * k * len(ids) + 100_000:
                        found = [best(found)]
                        held = len(found[0])
        yield from finish(ids, found)

    schema = T.StructType([T.StructField("query_id", types["query_id"]), T.StructField("neighbor_id", types["neighbor_id"]),
                           T.StructField("psum", T.DoubleType()), *[T.StructField(c, types[c]) for c in payload]])
    form = to_arrow_schema(schema)
    return rows.mapInArrow(run, schema)


# ---- voting ------------------------------------------------------------------------------------

def _weights(weights: str):
    """Vote weight of a neighbour row; at distance zero only exact matches count."""
    if weights == "uniform":
        return F.lit(1.0)
    if weights == "distance":
        exact = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("query_id"))
        return F.when(exact == 1, (F.col("distance") == 0).cast("double")).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance")))
    raise ValueError(f"unknown weights {weights}")


def weighted_mean(near: DataFrame, value: str, weights: str = "distance") -> DataFrame:
    """(query_id, estimate): weighted mean of a payload column over the neighbours."""
    w = near.withColumn("w", _weights(weights))
    return w.groupBy("query_id").agg(
        F.try_divide(F.sum(F.col("w") * F.col(value).cast("double")), F.sum("w")).alias("estimate"))


def class_shares(near: DataFrame, label: str, weights: str = "distance") -> DataFrame:
    """(query_id, label, proba): normalised vote per class found among the neighbours.

    Shares keep twelve digits, so that equal votes tie whatever the order of addition.
    """
    votes = near.withColumn("w", _weights(weights)).groupBy("query_id", label).agg(F.sum("w").alias("votes"))
    total = F.sum("votes").over(Window.partitionBy("query_id"))
    return votes.select("query_id", label, F.round(F.col("votes") / total, 12).alias("proba"))


def vote(near: DataFrame, label: str, weights: str = "distance") -> DataFrame:
    """(query_id, prediction): class with the largest vote, the smaller class on ties."""
    first = F.min(F.struct((-F.col("proba")).alias("s"), F.col(label).alias("cls")))
    return class_shares(near, label, weights).groupBy("query_id").agg(first.getField("cls").alias("prediction"))


def classify(train: DataFrame, rows: DataFrame, features: Sequence[str], label: str, id_col: str, k: int = 5,
             weights: str = "distance", metric: str = "euclidean", p: float = 2.0) -> DataFrame:
    """k-nearest-neighbour class of every row: (id, prediction)."""
    k = max(1, min(int(k), train.count()))
    near = nearest(rows, train, features, k, id_col, [label], metric, p)
    return vote(near, label, weights).withColumnRenamed("query_id", id_col)
