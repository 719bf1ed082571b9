"""DBSCAN on a grid whose cells are at most eps wide, and the k-distance statistic.

All points of a cell are neighbours of each other, so a cell holding ``min_samples``
points is core as a whole and a hot cell never produces pairs. Only points of thin
cells look at their neighbourhood, and there at boxes that count as a whole wherever
they can. Two core cells are linked by comparing bounding boxes. Boxes are halved
until the answer is certain.
"""
from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulon.operators import neighbors
from tabulon.operators.encode import apply_scaler, fit_standard
from tabulon.operators.graph import components
from tabulon.operators.impute import fill_medians
from tabulon.operators.order import fit_medians, fit_quantiles, number_rows
from tabulon.session import cut

#: Two boxes with up to so many pairs of points are compared point by point.
POINT_PAIRS = 4096
#: A point is compared with the points of a box of up to so many.
BOX_POINTS = 64
# Boxes are halved at most so often: beyond that their points differ in the last digits only.
_HALVINGS = 40
_TREE_BITS = 2


def k_distances(df: DataFrame, id_col: str, features: Sequence[str], k: int) -> DataFrame:
    """(id, k_distance): distance to the k-th nearest row, the row itself being the first."""
    near = neighbors.nearest(df, df, features, k, id_col)
    return near.where(F.col("rank") == k).select(
        F.col("query_id").alias(id_col), F.col("distance").alias("k_distance"))


def suggest_eps(kd: DataFrame, share: float = 0.98) -> float:
    return fit_quantiles(kd, ["k_distance"], [share])["k_distance"][0]


def prepare_continuous(df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """Median fill, then standardise."""
    filled = fill_medians(df.select(id_col, *features), fit_medians(df, features))
    return apply_scaler(filled, fit_standard(filled, features))


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` over all shuffle partitions: what they meet is large, which few bytes of input would hide from AQE."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _added(terms) -> Column:
    total = F.lit(0.0)
    for t in terms:
        total = total + t
    return total


# Written out per coordinate: functions over arrays would keep the joins out of generated code.
def _square(a: Column, b: Column, width: int) -> Column:
    """Squared distance of two points, added in feature order."""
    return _added((a[j] - b[j]) * (a[j] - b[j]) for j in range(width))


def _box_square(lo_a, hi_a, lo_b, hi_b, far: bool, width: int) -> Column:
    """Squared smallest (or largest) distance of two boxes."""
    if far:
        gaps = [F.greatest(hi_a[j] - lo_b[j], hi_b[j] - lo_a[j]) for j in range(width)]
    else:
        gaps = [F.greatest(lo_b[j] - hi_a[j], lo_a[j] - hi_b[j], F.lit(0.0)) for j in range(width)]
    return _added(g * g for g in gaps)


def _boxes(points: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    return points.groupBy(*keys).agg(
        F.array(*[F.min(F.col("x")[j]) for j in range(width)]).alias("lo"),
        F.array(*[F.max(F.col("x")[j]) for j in range(width)]).alias("hi"),
        F.count("*").alias("m"), F.sum("w").alias("w"), F.min("pid").alias("first_id"))


def _within(lo_a, hi_a, lo_b, hi_b, eps2: float, width: int) -> Column:
    return _box_square(F.col(lo_a), F.col(hi_a), F.col(lo_b), F.col(hi_b), False, width) <= eps2


def _block(shift: int) -> Column:
    """Key of blocks of two cells a side. Blocks may share a key, so what meets by it is still compared."""
    return F.xxhash64(F.transform("grid", lambda v: F.shiftright(v + shift, 1)))


def _near_cells(cells: DataFrame, width: int, eps2: float, once: bool) -> DataFrame:
    """(a, b) of the cells whose boxes come within eps: a is marked ``ask``, and a and b are not of the same ``root``.

    A cell is near itself; ``once`` gives one of (a, b) and (b, a) and is for cells that are all marked. Up to two
    coordinates the steps of a cell name its neighbours. More coordinates would give too many steps: the cells form a
    tree instead, and a pair of nodes within eps is replaced by the pairs of their children, one side at a time, so
    that every coordinate prunes at every level. Nodes whose cells are all of one root are not compared.
    """
    if width <= 2:
        return _stepped_cells(cells, width, eps2, once)
    ends = cells.agg(*[f(F.col("grid")[j]).alias(f"{n}{j}") for j in range(width)
                       for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
    if ends["lo0"] is None:
        return cells.select(F.col("cell").alias("a"), F.col("cell").alias("b"))
    base = F.array(*[F.lit(ends[f"lo{j}"]) for j in range(width)])
    bits = max(ends[f"hi{j}"] - ends[f"lo{j}"] for j in range(width)).bit_length()
    levels = list(range(0, bits + _TREE_BITS, _TREE_BITS))  # one node at the last
    zero = F.zip_with("grid", base, lambda v, low: v - low)

    def node(n):
        return F.struct(F.lit(n).alias("level"), F.transform("zero", lambda v: F.shiftright(v, n)).alias("node"))
    nodes = F.explode(F.array(*[node(n) for n in levels]))
    # A node is named by its smallest cell.
    tree = cut(cells.withColumn("zero", zero).select(nodes.alias("at"), "cell", "lo", "hi", "ask", "root")
               .groupBy("at.level", "at.node").agg(
        F.array(*[F.min(F.col("lo")[j]) for j in range(width)]).alias("lo"),
        F.array(*[F.max(F.col("hi")[j]) for j in range(width)]).alias("hi"),
        F.min("cell").alias("name"), F.max("ask").alias("ask"),
        F.when(F.min("root") == F.max("root"), F.min("root")).alias("root")))
    # The lowest level with one node is the root.
    level = min(r["level"] for r in tree.groupBy("level").count().where("count = 1").collect())
    top = tree.where(F.col("level") == level)
    above = tree.select((F.col("level") - _TREE_BITS).alias("level"), F.col("node").alias("up"), F.col("name").alias("parent"))
    tree = cut(tree.withColumn("up", F.transform("node", lambda v: F.shiftright(v, _TREE_BITS))).join(above, ["level", "up"])
               .drop("up", "node"))
    pairs = top.where("ask").select(F.col("name").alias("a"), F.col("name").alias("b"), F.col("lo").alias("lo_b"),
                                    F.col("hi").alias("hi_b"), F.col("root").alias("root_b"))
    apart = _within("lo_a", "hi_a", "lo_b", "hi_b", eps2, width) & F.coalesce(F.col("root_a") != F.col("root_b"), F.lit(True))
    while level > 0:
        level -= _TREE_BITS
        kids = tree.where(F.col("level") == level)

        def side(s):
            return kids.select(F.col("parent").alias(s), F.col("name").alias(f"new_{s}"), F.col("lo").alias(f"lo_{s}"),
                               F.col("hi").alias(f"hi_{s}"), F.col("root").alias(f"root_{s}"), "ask")
        half = pairs.join(side("a").where("ask").drop("ask"), "a").where(apart).drop("lo_b", "hi_b", "root_b")
        both = _dealt(half, "b", "new_a").join(side("b").drop("ask"), "b").where(apart)
        if once:
            both = both.where((F.col("a") != F.col("b")) | (F.col("new_a") <= F.col("new_b")))
        pairs = cut(both.select(F.col("new_a").alias("a"), F.col("new_b").alias("b"), "lo_b", "hi_b", "root_b"))
    return pairs.select("a", "b")


def _stepped_cells(cells: DataFrame, width: int, eps2: float, once: bool) -> DataFrame:
    reach = math.floor(math.sqrt(width) * (1 + 1e-9)) + 1

    def side(s):
        return cells.select(F.col("cell").alias(s), F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}"),
                            F.col("root").alias(f"root_{s}"), "ask", *[F.col("grid")[j].alias(f"g{j}") for j in range(width)])
    left, right = side("a").where("ask").drop("ask"), side("b").drop("ask")
    for j in range(width):
        left = left.withColumn("_s", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn(
            f"g{j}", F.col(f"g{j}") + F.col("_s")).drop("_s")
    pairs = left.join(right, [f"g{j}" for j in range(width)]).where(
        _within("lo_a", "hi_a", "lo_b", "hi_b", eps2, width) & F.coalesce(F.col("root_a") != F.col("root_b"), F.lit(True)))
    return (pairs.where("a <= b") if once else pairs).select("a", "b")


def _surely_core(thin: DataFrame, points: DataFrame, width: int, eps2: float, need: int) -> DataFrame:
    """(pid) of thin points that find ``need`` rows within eps in their own block already: almost all in most tables.

    A cell shows at most ``need`` points, so that a full one does not meet its block as a whole. Two places of the
    blocks are tried; what finds too few remains open.
    """
    first = Window.partitionBy("cell").orderBy("pid")
    shown = cut(points.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= need).select("x", "w", "grid"))
    sure = None
    for shift in (0, 1):
        asked = thin if sure is None else thin.join(sure, "pid", "left_anti")
        met = _dealt(asked.select("pid", "x", _block(shift).alias("block")), "pid").join(
            shown.select(_block(shift).alias("block"), F.col("x").alias("y"), F.col("w").alias("wy")), "block")
        got = cut(met.where(_square(F.col("x"), F.col("y"), width) <= eps2).groupBy("pid").agg(F.sum("wy").alias("w"))
                  .where(F.col("w") >= need).select("pid"))
        sure = got if sure is None else sure.unionByName(got)
    return sure


def _reached(ask: DataFrame, near: DataFrame, targets: DataFrame, width: int, eps2: float, side: float,
             by: Sequence[str], need: int) -> DataFrame:
    """(pid, b, w): weight of the targets of cell b within eps of each asked point, as far as ``need`` decides.

    ``ask`` has (pid, x, a), ``targets`` (pid, x, w, cell, grid). A box of targets inside eps counts as a whole, one beyond
    eps goes, one of few points is compared point by point and any other is halved. What has reached ``need``
    per ``by`` is asked no further, so a point never meets all points of a full cell.
    """
    def placed(at):
        return targets.withColumn("sub", F.transform("x", lambda v: F.floor(v / F.lit(side / 2 ** at))))

    def boxes(t):
        return t.select(F.col("cell").alias("b"), "sub", "lo", "hi", "m", "w")
    level, found = 0, None
    open_ = (ask.join(near, "a").select("pid", "x", "b")
             .join(boxes(_boxes(targets, ["cell", "grid"], width).withColumnRenamed("grid", "sub")), "b"))
    while True:
        gap = _box_square(F.col("x"), F.col("x"), F.col("lo"), F.col("hi"), False, width)
        span = _box_square(F.col("x"), F.col("x"), F.col("lo"), F.col("hi"), True, width)
        few = F.col("m") <= (BOX_POINTS if level < _HALVINGS else 1 << 62)
        open_ = cut(open_.where(gap <= eps2).withColumn("state", F.when(span <= eps2, 0).when(few, 1).otherwise(2))
                    .drop("lo", "hi", "m"))
        points = placed(level).select(F.col("cell").alias("b"), "sub", F.col("x").alias("y"), F.col("w").alias("wy"))
        close = (_dealt(open_.where("state = 1").drop("w"), "pid", "b").join(points, ["b", "sub"])
                 .where(_square(F.col("x"), F.col("y"), width) <= eps2).select("pid", "b", F.col("wy").alias("w")))
        hit = open_.where("state = 0").select("pid", "b", "w").unionByName(close)
        if found is not None:
            hit = hit.unionByName(found)
        found = cut(hit.groupBy("pid", "b").agg(F.sum("w").alias("w")))
        wide = open_.where("state = 2").drop("state", "w")
        if wide.isEmpty():
            return found
        done = found.groupBy(*by).agg(F.sum("w").alias("w")).where(F.col("w") >= need).select(*by)
        wide = cut(wide.join(done, list(by), "left_anti"))
        if wide.isEmpty():
            return found
        level += 1
        busy = wide.select(F.col("b").alias("cell"), F.col("sub").alias("up")).distinct()
        parts = placed(level).withColumn("up", F.transform("sub", lambda v: F.floor(v / F.lit(2.0))))
        parts = _boxes(parts.join(busy, ["cell", "up"], "left_semi"), ["cell", "up", "sub"], width)
        kids = parts.select(F.col("cell").alias("b"), "up", "sub", "lo", "hi", "m", "w")
        open_ = wide.withColumnRenamed("sub", "up").join(kids, ["b", "up"]).drop("up")


def dbscan(df: DataFrame, id_col: str, features: Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """(id, cluster, is_outlier); noise is -1, clusters count up by their smallest core id.

    A point is core with ``min_samples`` rows within eps, itself included. A border
    point in reach of several clusters takes the lowest. Integer ids are expected.
    """
    features, width, eps2 = list(features), len(features), float(eps) * float(eps)
    side = eps / math.sqrt(width) * (1 - 1e-9)
    rows = df.select(F.col(id_col), F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    # Copies collapse into one weighted point.
    points = cut(rows.groupBy("x").agg(F.count("*").alias("w"), F.min(id_col).alias("pid"))
                 .withColumn("grid", F.transform("x", lambda v: F.floor(v / F.lit(side)))))
    cells = cut(_boxes(points, ["grid"], width).withColumn("dense", F.col("w") >= min_samples)
                .withColumn("cell", F.monotonically_increasing_id()))
    points = cut(points.join(cells.select("grid", "cell", "dense"), "grid"))

    thin = points.where(~F.col("dense"))
    sure = _surely_core(thin, points, width, eps2, min_samples)
    thin = cut(thin.join(sure, "pid", "left_anti"))
    asked = thin.select("cell", F.lit(True).alias("ask")).distinct()
    near = cut(_near_cells(cells.join(asked, "cell", "left").withColumn("ask", F.coalesce("ask", F.lit(False)))
                           .withColumn("root", F.lit(None).cast("long")), width, eps2, once=False))
    counts = _reached(thin.select("pid", "x", F.col("cell").alias("a")), near, points, width, eps2, side,
                      ["pid"], min_samples).groupBy("pid").agg(F.sum("w").alias("reach"))
    sure = sure.unionByName(counts.where(F.col("reach") >= min_samples).select("pid")).distinct()
    points = cut(points.join(sure.withColumn("sure", F.lit(True)), "pid", "left")
                 .withColumn("core", F.col("dense") | F.coalesce("sure", F.lit(False)))
                 .select("pid", "x", "w", "cell", "grid", "core"))
    core = points.where("core")
    cell_root = _cell_roots(core, width, eps2, side)
    numbers = number_rows(cell_root.select("root").distinct(), ["root"], name="cluster").withColumn(
        "cluster", F.col("cluster") - 1)
    cell_cluster = cut(cell_root.join(numbers, "root").select("cell", F.col("cluster").cast("long")))

    rest = points.where("NOT core")
    border = (_reached(rest.select("pid", "x", F.col("cell").alias("a")), near, core, width, eps2, side, ["pid", "b"], 1)
              .join(cell_cluster.withColumnRenamed("cell", "b"), "b")
              .groupBy("pid").agg(F.min("cluster").alias("cluster")))
    named = core.join(cell_cluster, "cell").select("x", "cluster").unionByName(
        rest.join(border, "pid", "left").select("x", F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster")))
    return (rows.join(named, "x")
            .select(id_col, "cluster", (F.col("cluster") == -1).cast("int").alias("is_outlier")))


def _cell_roots(core: DataFrame, width: int, eps2: float, side: float) -> DataFrame:
    """(cell, root) of core cells: the smallest core id of their cluster.

    Cells of the same block are linked first. What they connect needs no further link, so that the search for near
    cells goes only to pairs that are still apart.
    """
    heads = cut(_boxes(core, ["cell", "grid"], width))
    roots = heads.select("cell", F.col("first_id").alias("root"))

    def joined(roots, pairs):
        names = [roots.select(F.col("cell").alias(s), F.col("root").alias(r)) for s, r in (("a", "u"), ("b", "v"))]
        links = _core_links(core, heads, pairs, width, eps2, side)
        found = components(links.join(names[0], "a").join(names[1], "b").select("u", "v"))
        return cut(roots.join(found.select(F.col("node").alias("root"), F.col("root").alias("least")), "root", "left")
                   .select("cell", F.coalesce("least", "root").alias("root")))
    keyed = [heads.select(F.col("cell").alias(s), _block(0).alias("k0"), _block(1).alias("k1")) for s in "ab"]
    same = [keyed[0].join(keyed[1], k).where("a < b").select("a", "b") for k in ("k0", "k1")]
    roots = joined(roots, same[0].unionByName(same[1]).distinct())
    apart = heads.join(roots, "cell").withColumn("ask", F.lit(True))
    return joined(roots, _near_cells(apart, width, eps2, once=True))


def _core_links(core, heads, near, width, eps2, side) -> DataFrame:
    """(a, b) of the pairs of core cells in ``near`` with two core points within eps."""
    def ends(t, key, suffix):
        return t.select(*[F.col(c).alias(f"{c}_{suffix}") for c in key], F.col("lo").alias(f"lo_{suffix}"),
                        F.col("hi").alias(f"hi_{suffix}"), F.col("m").alias(f"m_{suffix}"))

    def dist(far):
        return _box_square(F.col("lo_a"), F.col("hi_a"), F.col("lo_b"), F.col("hi_b"), far, width)

    firsts = heads.withColumnRenamed("grid", "sub")
    pairs = (near.where("a != b").select(F.col("a").alias("cell_a"), F.col("b").alias("cell_b"))
             .join(ends(firsts, ["cell", "sub"], "a"), "cell_a").join(ends(firsts, ["cell", "sub"], "b"), "cell_b"))
    level = 0
    found = None
    while True:
        pairs = cut(pairs.where(dist(False) <= eps2).withColumn("sure", dist(True) <= eps2))
        sure = pairs.where("sure").select("cell_a", "cell_b").distinct()
        found = sure if found is None else found.unionByName(sure)
        open_ = pairs.where("NOT sure").drop("sure").join(sure, ["cell_a", "cell_b"], "left_anti")
        open_ = cut(open_.select("cell_a", "cell_b", "sub_a", "sub_b", "m_a", "m_b"))
        if open_.isEmpty():
            break

        def keyed(at):
            return core.withColumn("sub", F.transform("x", lambda v: F.floor(v / F.lit(side / 2 ** at))))
        # Boxes of few points are compared point by point, the others are halved.
        few = F.col("m_a") * F.col("m_b") <= POINT_PAIRS
        p = keyed(level)
        left = p.select(F.col("cell").alias("cell_a"), F.col("sub").alias("sub_a"), "x")
        right = p.select(F.col("cell").alias("cell_b"), F.col("sub").alias("sub_b"), F.col("x").alias("y"))
        hit = cut(_dealt(open_.where(few), "cell_a", "cell_b").join(left, ["cell_a", "sub_a"]).join(right, ["cell_b", "sub_b"])
                  .where(_square(F.col("x"), F.col("y"), width) <= eps2).select("cell_a", "cell_b").distinct())
        found = found.unionByName(hit)
        open_ = cut(open_.where(~few).join(hit, ["cell_a", "cell_b"], "left_anti"))
        if open_.isEmpty():
            break
        level += 1
        busy = open_.select(F.col("cell_a").alias("cell")).unionByName(
            open_.select(F.col("cell_b").alias("cell"))).distinct()
        parts = cut(_boxes(keyed(level).join(busy, "cell", "left_semi"), ["cell", "sub"], width)
                    .withColumn("up", F.transform("sub", lambda v: F.floor(v / F.lit(2.0)))))

        def child(s):
            return ends(parts, ["cell", "up", "sub"], s).withColumnRenamed(f"sub_{s}", f"new_{s}").withColumnRenamed(
                f"up_{s}", f"sub_{s}")
        pairs = (open_.drop("m_a", "m_b").join(child("a"), ["cell_a", "sub_a"]).join(child("b"), ["cell_b", "sub_b"])
                 .drop("sub_a", "sub_b").withColumnRenamed("new_a", "sub_a").withColumnRenamed("new_b", "sub_b"))
    return found.distinct().select(F.col("cell_a").alias("a"), F.col("cell_b").alias("b"))


def outlier_profile(df: DataFrame, flag: str, features: Sequence[str], digits: int = 2) -> DataFrame:
    """Mean of each continuous column by outlier flag, plus counts and share."""
    total = df.count()
    return df.groupBy(flag).agg(
        F.count("*").alias("n"), F.round(F.count("*") * 100.0 / F.lit(total), 2).alias("pct"),
        *[F.round(F.avg(c), digits).alias(f"mean_{c}") for c in features])


def density_outliers(df: DataFrame, id_col: str, features: Sequence[str], min_samples: int = 10,
                     eps: float | None = None, share: float = 0.98) -> dict:
    """Median fill, scaling, eps from the k-distances, clusters and profile in one run.

    ``rows`` has the id, the features as they came, cluster and is_outlier; ``profile`` the means of the
    features (NULLs skipped) by is_outlier; ``eps`` the radius that was used.
    """
    features = list(features)
    scaled = cut(prepare_continuous(df, id_col, features))
    if eps is None:
        eps = suggest_eps(k_distances(scaled, id_col, features, min_samples), share)
    if not eps:
        raise ValueError("eps must be positive: give one where most rows have copies")
    found = dbscan(scaled, id_col, features, eps, min_samples)
    rows = cut(df.select(id_col, *features).join(found, id_col))
    return {"rows": rows, "profile": outlier_profile(rows, "is_outlier", features), "eps": eps}
