"""k-nearest-neighbour votes of many feature subsets at once, in the tasks of one job.

A task meets the train rows in stretches and keeps, for every subset and query, the k nearest so far; ties go to the row
met first. The k-th distance so far bounds what can still enter; at first it is taken from a first stretch that is compared in
full, or, where the subsets share most columns, from the rows nearest over these. Matrices of few digits, with room for their
rounding errors, leave few pairs, whose distances are added up exactly.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

from tabulon.operators.neighbors import k_smallest

#: Rows compared in full, rows of a later stretch at most (for sets in groups and for any sets), queries compared with them at
#: once (later four times as many), pairs whose distances are added up at once.
FIRST, LONG, STRETCH, ASKS, PAIRS = 256, 16384, 4096, 256, 1 << 15
#: Rows of the first stretch that bound the distances of a query under the sets of a group.
SEEDS = 64
#: Queries and rows of a tile, whose matrices stay in a core's cache, and pairs of it that meet all sets of a group at once.
TILE, MEET = (128, 2048), 4096
#: Stands for a null class of train rows, which loses ties, and of queries, which nothing equals.
_NO_CLASS, _NO_TRUTH = 1 << 40, -(1 << 40)


def subset_sums(gaps: list[np.ndarray], sets: list[list[int]]):
    """Sum of the gap matrices of every subset.

    The subsets of a search step share all columns but one, so the shared part is added
    once: a common base when growing, running sums from both ends when shrinking.
    """
    zero = np.zeros_like(gaps[0])
    common = sorted(set.intersection(*map(set, sets)))
    union = sorted(set.union(*map(set, sets)))
    if all(len(s) <= len(common) + 1 for s in sets):
        base = sum((gaps[j] for j in common), zero)
        for s in sets:
            extra = [j for j in s if j not in common]
            yield base + gaps[extra[0]] if extra else base
    elif all(len(s) == len(union) - 1 for s in sets):
        after = [zero]
        for j in reversed(union):
            after.append(gaps[j] + after[-1])
        after.reverse()
        before, sums = zero, {}
        for at, j in enumerate(union):
            sums[j] = before + after[at + 1]
            before = before + gaps[j]
        for s in sets:
            yield sums[(set(union) - set(s)).pop()]
    else:
        for s in sets:
            yield sum((gaps[j] for j in s), zero)


class _Asks:
    """Queries around a point; what a screen needs of them is kept from one stretch of rows to the next."""

    def __init__(self, q: np.ndarray, point: np.ndarray):
        self.q, self.point = q, point
        self.around = q - point
        self.wide = np.fmax.reduce(np.abs(self.around), axis=None, initial=0)
        self.kept = {}

    def _once(self, key, make):
        if key not in self.kept:
            self.kept[key] = make()
        return self.kept[key]

    def left(self, kind) -> np.ndarray:
        return self._once(kind, lambda: np.ascontiguousarray(self.around.T.astype(kind)))

    def side(self, columns: tuple[int, ...], kind) -> np.ndarray:
        """The left factor of ``_Screen.product``."""
        def make():
            q = self.left(kind)[list(columns)]
            return np.ascontiguousarray(np.vstack([-2 * q, (q * q).sum(0)[None], np.ones((1, q.shape[1]), kind)]).T)
        return self._once((columns, kind), make)

    def squares(self, columns: tuple[int, ...]) -> np.ndarray:
        return self._once(columns, lambda: np.nansum(self.around[:, list(columns)] ** 2, axis=1))


class _Screen:
    """Pairs of queries and train rows in tiles, with distances of a few digits around a common point and exact ones."""

    def __init__(self, asks: _Asks, b: np.ndarray, columns: Sequence[int], extras: Sequence[int] = ()):
        """``columns`` are those of every distance, of ``extras`` a distance has one at most."""
        self.asks, self.q, self.b, self.n = asks, asks.q, b, len(b)
        right = b - asks.point
        #: Squares and their sums must not overflow.
        self.kind = np.float32 if max(asks.wide, np.fmax.reduce(np.abs(right), axis=None, initial=0)) < 1e15 else np.float64
        self.left, self.right = asks.left(self.kind), np.ascontiguousarray(right.T.astype(self.kind))
        self.sides = {}
        self.out, self.marks = np.empty(TILE, self.kind), np.empty(TILE, bool)
        # Per query, at least half of its squared distance to any row.
        around = asks.squares(tuple(columns)) + np.nansum(right[:, columns] ** 2, axis=1).max()
        if len(extras):
            around = around + np.nan_to_num(asks.around[:, extras] ** 2 + np.fmax.reduce(right[:, extras] ** 2)).max(1)
        given = 2 * around + 4 * (asks.point[[*columns, *extras]] ** 2).sum()
        # Above the rounding errors of squares, products and sums, and of the rows around the point.
        eps = float(np.finfo(self.kind).eps)
        width = len(columns) + (len(extras) > 0)
        self.slack = 4 * (width + 8) * eps * around + 1e-13 * np.sqrt(around) * np.sqrt(given) + 1e-30 * given + 1e-38

    def tiles(self) -> Iterator[tuple[slice, slice]]:
        for s in range(0, len(self.q), TILE[0]):
            for r in range(0, self.n, TILE[1]):
                yield slice(s, min(s + TILE[0], len(self.q))), slice(r, min(r + TILE[1], self.n))

    def limit(self, bound: np.ndarray) -> np.ndarray:
        """A column to compare with ``product``: nothing within ``bound`` (-inf: nothing at all) is above it."""
        with np.errstate(over="ignore"):
            return (bound * (1 + 1e-6) + self.slack).astype(self.kind)[:, None]

    def product(self, s: slice, r: slice, columns: Sequence[int]) -> np.ndarray:
        """Squared distances over ``columns`` by one matrix product; the next of a tile may take their place."""
        columns = tuple(columns)
        if columns not in self.sides:
            b = self.right[list(columns)]
            self.sides[columns] = np.vstack([b, np.ones((1, self.n), self.kind), (b * b).sum(0)[None]])
        q, b = self.asks.side(columns, self.kind), self.sides[columns]
        return np.matmul(q[s], b[:, r], out=self._buffer(self.out, s.stop - s.start, r.stop - r.start))

    @staticmethod
    def _buffer(kept: np.ndarray, rows: int, columns: int) -> np.ndarray | None:
        """The beginning of a kept tile, so that it is contiguous; none if it is too small."""
        return kept.reshape(-1)[:rows * columns].reshape(rows, columns) if rows * columns <= kept.size else None

    def near(self, d: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Which distances of a tile are within the limits; the next one may take their place."""
        return np.less_equal(d, limit, out=self._buffer(self.marks, *d.shape))

    def flat(self, s: slice, r: slice, within: np.ndarray) -> np.ndarray:
        """Numbers (query * rows + row) of the marked pairs of a tile."""
        i, j = np.divmod(np.flatnonzero(within), within.shape[1])
        return (i + s.start) * self.n + j + r.start

    def gap(self, i: np.ndarray, j: np.ndarray, column: int | np.ndarray) -> np.ndarray:
        return (self.q[i, column] - self.b[j, column]) ** 2

    def distance(self, i: np.ndarray, j: np.ndarray, columns: Sequence[int]) -> np.ndarray:
        """Exact squared distances of pairs, added from left to right."""
        d = np.zeros(len(i))
        for c in columns:
            d += self.gap(i, j, c)
        return d


@dataclass(frozen=True)
class _Group:
    """Sets that hold the same ``base`` columns and, by ``takes`` (extras x sets), some of the ``extras``."""
    base: list[int]
    extras: list[int]
    sets: np.ndarray
    takes: np.ndarray


def _groups(sets: list[list[int]], common: list[int], union: list[int], growing: bool) -> list[_Group]:
    """One group around the common columns, or, where each set leaves out one column, groups by stretches of these columns."""
    parts = [[c for c in union if c not in common]]
    if not growing:
        parts = [p.tolist() for p in np.array_split(union, max(2, round(len(union) ** 0.5)))]
    out = []
    for part in parts:
        which = np.array([n for n, s in enumerate(sets) if growing or not set(part) <= set(s)], int)
        if len(which):
            takes = np.array([[c in sets[n] for n in which] for c in part], float).reshape(len(part), len(which))
            out.append(_Group([c for c in union if c not in part], part, which, takes))
    return out


class Nearest:
    """The k nearest train rows of each query (rows of ``x``) under each set of columns, of the rows met so far."""

    def __init__(self, x: np.ndarray, sets: Sequence[Sequence[int]], k: int):
        self.x, self.sets, self.k, self.met = x, [list(s) for s in sets], k, 0
        shape = (len(sets), len(x), k)
        self.d, self.row, self.classes = np.full(shape, np.inf), np.full(shape, -1), []
        #: Bounds of the k-th distances, beside those in ``d``.
        self.asks, self.reach = None, np.full(shape[:2], np.inf)
        self.common = sorted(set.intersection(*map(set, sets)))
        self.union = sorted(set.union(*map(set, sets)))
        self.single = all(len(s) == 1 for s in sets)
        self.growing = bool(self.common) and all(len(s) <= len(self.common) + 1 for s in sets)
        self.shrinking = len(self.union) > 1 and all(len(s) == len(self.union) - 1 for s in sets)
        #: The column that a set has beside the common ones (-1: none), or that it leaves out.
        self.odd = np.array([max({*s} - {*self.common}, default=-1) if self.growing else max({*self.union} - {*s}, default=-1)
                             for s in self.sets])
        self.groups = _groups(self.sets, self.common, self.union, self.growing) if self.growing or self.shrinking else []

    def meet(self, x: np.ndarray, y: np.ndarray) -> None:
        """The next train rows, in the order in which ties are decided."""
        self.classes.append(y)
        at, most = 0, LONG if self.single or self.groups else STRETCH
        while at < len(x):
            first = not self.groups and self.met < FIRST
            size = min(FIRST - self.met if first else min(self.met or most, most), len(x) - at)
            self._stretch(x[at:at + size], first)
            at += size
            self.met += size

    def _stretch(self, b: np.ndarray, whole: bool) -> None:
        if self.groups:
            return self._grouped(b)
        compare = self._in_full if whole else self._windows if self.single else self._chained
        step = ASKS if whole else 4 * ASKS if compare == self._chained else len(self.x)
        for s in range(0, len(self.x), step):
            compare(s, min(s + step, len(self.x)), b)

    def _add(self, n: np.ndarray, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> None:
        """Rows ``j`` of a stretch at distances ``d`` from queries ``i`` under sets ``n``; those of one query in the order of ``j``."""
        if not len(n):
            return
        key = n * len(self.x) + i
        order = np.lexsort((d, key))  # stable, as the sort below: rows met before stand before those of equal distance
        key = key[order]
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        at = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(key)))
        rank = np.arange(len(key)) - begins[at]
        keep = rank < self.k
        keys, at, rank, order = key[begins], at[keep], rank[keep], order[keep]
        parts = [a.reshape(-1, self.k) for a in (self.d, self.row)]  # views
        first = None
        for p, new, nothing in zip(parts, (d, j + self.met), (np.inf, -1)):
            both = np.full((len(keys), 2 * self.k), nothing, p.dtype)
            both[:, :self.k] = p[keys]
            both[at, self.k + rank] = new[order]
            if first is None:
                first = np.argsort(both, axis=1, kind="stable")[:, :self.k]
            p[keys] = np.take_along_axis(both, first, 1)

    def _in_full(self, lo: int, hi: int, b: np.ndarray) -> None:
        q, found = self.x[lo:hi], []
        gaps = [(q[:, c:c + 1] - b[None, :, c]) ** 2 for c in range(q.shape[1])]
        for n, d in enumerate(subset_sums(gaps, self.sets)):
            d = np.where(np.isnan(d), np.inf, d)
            i, j = k_smallest(d, self.k)
            near = d[i, j] < np.inf
            found.append((np.full(near.sum(), n), i[near] + lo, j[near], d[i, j][near]))
        self._add(*map(np.concatenate, zip(*found)))

    def _windows(self, lo: int, hi: int, b: np.ndarray) -> None:
        """Sets of one column: the sorted values within the bound of each query."""
        for n, (c,) in enumerate(self.sets):
            order = np.argsort(b[:, c], kind="stable")
            values, q, bound = b[order, c], self.x[lo:hi, c], self.d[n, lo:hi, -1]
            reach = np.sqrt(bound) * (1 + 1e-9) + 1e-9 * np.abs(q)
            start, end = np.searchsorted(values, q - reach, "left"), np.searchsorted(values, q + reach, "right")
            size = np.where(bound > 0, np.maximum(end - start, 0), 0)
            for part in self._pieces(size):
                i = np.repeat(np.arange(len(q))[part], size[part])
                j = order[np.arange(len(i)) - np.repeat(np.cumsum(size[part]) - size[part], size[part]) + start[i]]
                d = (q[i] - b[j, c]) ** 2
                near = d < self.d[n, lo + i, -1]
                i, j, d = i[near], j[near], d[near]
                by_row = np.lexsort((j, i))
                self._add(np.full(len(i), n), lo + i[by_row], j[by_row], d[by_row])

    @staticmethod
    def _pieces(size: np.ndarray) -> Iterator[slice]:
        """Runs of queries with about ``PAIRS`` pairs."""
        cuts = np.flatnonzero(np.diff((np.cumsum(size) - size) // PAIRS)) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(size)]):
            if size[s:e].any():
                yield slice(s, e)

    def _seeds(self, b: np.ndarray) -> None:
        """Bounds from the rows of the first stretch that are nearest over the common columns, or over all."""
        base = self.common if self.growing else self.union
        screen = _Screen(self.asks, b, base, sorted({*self.union} - {*base}))
        odd, sign = self._odd_columns(screen), 1 if self.growing else -1
        # Near over few columns says little of the one that is new.
        seeds = SEEDS * max(1, 16 >> len(base))
        for s in range(0, len(self.x), TILE[0]):
            s = slice(s, min(s + TILE[0], len(self.x)))
            d = screen.product(s, slice(0, screen.n), base)
            j = np.argpartition(d, seeds, axis=1)[:, :seeds] if screen.n > seeds else np.tile(np.arange(screen.n), (len(d), 1))
            total = (odd[0][s, None] - odd[1][j]) ** 2 * sign + np.take_along_axis(d, j, 1)[:, :, None]
            kth = np.partition(total, self.k - 1, axis=1)[:, self.k - 1].astype(float)
            kth = np.maximum(kth, 0) * (1 + 1e-6) + screen.slack[s, None]
            self.reach[:, s] = np.where(np.isnan(kth), np.inf, kth).T

    def _odd_columns(self, screen: _Screen) -> tuple[np.ndarray, np.ndarray]:
        """Of queries and rows, per set the column that it has beside the common ones (zeros: none) or that it leaves out."""
        return tuple(np.ascontiguousarray(np.where(self.odd[:, None] >= 0, x[self.odd], 0).T) for x in (screen.left, screen.right))

    def _grouped(self, b: np.ndarray) -> None:
        """Rows whose distance over the base of a group is within the widest bound of its sets, then within that of a set."""
        if self.asks is None:
            self.asks = _Asks(self.x, np.nan_to_num(b[0]))
            if len(b) >= self.k:
                self._seeds(b)
        for g in self.groups:
            screen = _Screen(self.asks, b, g.base, g.extras) if self.growing else _Screen(self.asks, b, self.union)
            bound = np.minimum(self.d[g.sets, :, -1], self.reach[g.sets])
            bound = np.where(bound > 0, bound, -np.inf)
            limit, limits = screen.limit(bound.max(0)), np.hstack([screen.limit(x) for x in bound])
            left, right = (self._odd_columns(screen) if self.growing
                           else (np.ascontiguousarray(x[g.extras].T) for x in (screen.left, screen.right)))
            takes, found, same = g.takes.astype(screen.kind), [], None
            # A null counts only in the sets that hold its column.
            nulls = not self.growing and (np.isnan(left).any() or np.isnan(right).any())
            for s, r in screen.tiles():
                if s.start != same and found:
                    self._add(*map(np.concatenate, zip(*found)))
                    found = []
                same = s.start
                d = screen.product(s, r, g.base)
                flat = np.flatnonzero(screen.near(d, limit[s]))
                base = d.reshape(-1)[flat]
                for p in range(0, len(flat), MEET):
                    i, j = np.divmod(flat[p:p + MEET], r.stop - r.start)
                    i, j = i + s.start, j + r.start
                    gaps = left[i]
                    gaps -= right[j]
                    np.multiply(gaps, gaps, out=gaps)
                    if nulls:
                        gaps[np.isnan(gaps)] = 1e36
                    total = gaps if self.growing else gaps @ takes
                    total += base[p:p + MEET, None]
                    pair, n = np.divmod(np.flatnonzero(total <= limits[i]), len(g.sets))
                    if len(pair):
                        some, at = np.unique(pair, return_inverse=True)
                        i, j, n = i[some], j[some], g.sets[n]
                        exact = self._exact(i, (screen, j), (at, n))
                        near = exact < self.d[n, i[at], -1]
                        at = at[near]
                        found.append((n[near], i[at], j[at], exact[near]))
            if found:
                self._add(*map(np.concatenate, zip(*found)))

    def _chained(self, lo: int, hi: int, b: np.ndarray) -> None:
        """Any sets, the smaller first: the distance over a set that holds the one before goes on from that one's."""
        bound = self.d[:, lo:hi, -1]
        screen = _Screen(_Asks(self.x[lo:hi], np.nan_to_num(b[0])), b, self.union)
        limit = [screen.limit(np.where(x > 0, x, -np.inf)) for x in bound]
        order = sorted(range(len(self.sets)), key=lambda n: len(self.sets[n]))
        pairs = [[] for _ in self.sets]
        for s, r in screen.tiles():
            last, d = None, None
            for n in order:
                now = set(self.sets[n])
                new = now - last if last is not None and last <= now else None
                if new is None or 4 * len(new) > len(now) + 4:
                    d = screen.product(s, r, sorted(now))
                else:
                    gap = np.empty_like(d)
                    for c in new:
                        np.subtract(screen.left[c, s, None], screen.right[c, None, r], out=gap)
                        d += np.multiply(gap, gap, out=gap)
                last = now
                pairs[n].append(screen.flat(s, r, screen.near(d, limit[n][s])))
        for n, found in enumerate(pairs):
            flat = np.sort(np.concatenate(found))
            for p in range(0, len(flat), PAIRS):
                i, j = np.divmod(flat[p:p + PAIRS], screen.n)
                every = np.arange(len(i))
                d = self._exact(i, (screen, j), (every, np.full(len(i), n)))
                keep = np.flatnonzero(d < self.d[n, lo:, -1][i])
                self._add(np.full(len(keep), n), lo + i[keep], j[keep], d[keep])

    def _exact(self, i: np.ndarray, rows: tuple[_Screen, np.ndarray], which: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Distances of pairs of a screen under the sets ``which``, (number of the pair, set), added as in ``subset_sums``."""
        screen, j = rows
        pair, n = which
        if self.growing:
            base, column = screen.distance(i, j, self.common), self.odd[n]
            return np.where(column >= 0, base[pair] + screen.gap(i[pair], j[pair], column), base[pair])
        if self.shrinking:
            gaps = np.stack([screen.gap(i, j, c) for c in self.union])
            none = np.zeros((1, len(i)))
            before, after = np.cumsum(gaps, axis=0), np.cumsum(gaps[::-1], axis=0)[::-1]
            at = np.searchsorted(self.union, self.odd[n])
            return np.concatenate([none, before])[at, pair] + np.concatenate([after, none])[at + 1, pair]
        return screen.distance(i, j, self.sets[n[0]])[pair] if len(n) else np.zeros(0)

    def hits(self, ids: pd.Series, truth: np.ndarray, weights: str) -> list[int]:
        """Per set, the queries whose largest vote is their own class, the smaller class on ties; rows of equal id vote together."""
        group = pd.factorize(ids)[0]
        counts = np.bincount(group)
        out = []
        classes = np.concatenate([*self.classes, [_NO_CLASS]])  # of the rows, and of none
        for d, row in zip(self.d, self.row):
            d, y = d.copy(), classes[row]
            for g in np.flatnonzero(counts > 1):
                mine = np.flatnonzero(group == g)
                first = np.lexsort((row[mine].ravel(), d[mine].ravel()))[:self.k]
                d[mine], y[mine] = d[mine].ravel()[first], y[mine].ravel()[first]
            known = np.isfinite(d)
            with np.errstate(divide="ignore"):
                w = np.where(d[:, :1] == 0, d == 0, 1 / np.sqrt(d)) if weights != "uniform" else np.ones_like(d)
            w = np.where(known, w, 0.0)
            votes = ((y[:, :, None] == y[:, None, :]) * w[:, None, :]).sum(2)
            # Shares of twelve digits, so that equal votes tie whatever the order of addition.
            share = np.where(known, np.round(votes / np.maximum(w.sum(1, keepdims=True), 1e-300), 12), -1.0)
            best = np.where(known & (share == share.max(1, keepdims=True)), y, _NO_CLASS).min(1)
            out.append(int((best == truth).sum()))
        return out


def hits_of_blocks(batches: Iterator[pa.RecordBatch], sets: Sequence[Sequence[int]], k: int, weights: str) -> Iterator[list[int]]:
    """Hits per set of each block; rows are (block, side, id, x, y), by block the queries (side 0) before the train rows."""
    if not sets:
        return
    now, asked, near = None, [], None

    def begin():
        ids, x, y = zip(*asked)
        return Nearest(np.concatenate(x), sets, k), pd.concat(ids, ignore_index=True), np.concatenate(y)

    for b in batches:
        if not b.num_rows:
            continue
        runs = b.column("block").to_numpy().astype(np.int64) * 2 + b.column("side").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(runs)]
        for s, e in zip(cuts, cuts[1:]):
            part, (block, side) = b.slice(s, e - s), divmod(int(runs[s]), 2)
            if block != now:
                if near:
                    yield near[0].hits(*near[1:], weights)
                now, asked, near = block, [], None
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(e - s, -1)
            y = part.column("y").cast(pa.int64()).fill_null(_NO_CLASS if side else _NO_TRUTH).to_numpy()
            if not side:
                asked.append((part.column("id").to_pandas(), x, y))
            elif asked:
                near = near or begin()
                near[0].meet(x, y)
    if near:
        yield near[0].hits(*near[1:], weights)
