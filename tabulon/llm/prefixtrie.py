"""Prefix trie of conversations by the Euler-tour technique.

Every distinct sequence of the first d turns (role, text) of a conversation is a node of depth d; the conversations that start
with it are its members, the root has all. A node is named by (smallest member, depth). What a training run saves if it
computes a shared prefix once is (members - 1) times the last turn's length, summed over a subtree.

* Paths: the hashes of a conversation's turns, each mixed with its depth, are combined by exclusive or; a prefix is known by its
  depth and 128 such bits, which running sums over the range-sorted turns give without walking a conversation.
* Tour: each node has an enter and an exit arc. After an enter arc comes the first child's, or the own exit arc; after an
  exit arc the next sibling's enter arc, or the parent's exit arc. Siblings ascend by smallest member.
* List ranking: arcs lie in ranges of nodes that are sorted by name, so that most successors are near. Each task
  contracts the arcs of its range to segments; the segments double their pointers in joins until all know the way to the end.
* Subtrees: leaves and savings are counted at enter arcs and summed up over the ranked tour; a subtree's share is the difference
  between its exit and its enter arc.

No step gathers a node's members, children or a conversation's turns in one place. Only the SHA-256 over the ids that end at a node
has to run in sequence: the ids are joined to runs in the tasks that sorted them, and a stream of runs goes through the hash.

Defined cases: turns ascend by number (nulls first), equal numbers by md5 of role and text; repeated rows are repeated turns;
null roles and texts are empty; rows without conv_id belong to no conversation; an empty table has no node. Other columns are
not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulon.llm.common import prefix_sums, spread, stored, table
from tabulon.llm.merkle import crc32_sql

BRANCH, FAMILY = 6, 100
#: Ids joined to one run before hashing.
RUN = 4096


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("one", F.lit(1).cast("long"))


def turns_of(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n, rank, hash, chars): each conversation's turns with their rank from 1."""
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    t = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what).cast("binary")).alias("hash"),
        F.length(what).cast("long").alias("chars"))
    placed = stored(prefix_sums(_one(stored(t, "trie-turns")), ["conv", F.col("turn").asc_nulls_first(), "hash"], {"place": "one"}), "trie-placed")
    sizes = placed.groupBy("conv").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    return placed.join(sizes, "conv").select("conv", "n", (F.col("place") - F.col("first") + 1).alias("rank"), "hash", "chars")


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, hash, chars) and (conv, total): every conversation c anew, from the first h = crc32(c) % BRANCH turns of
    conversation c - c % FAMILY and its own turns after its first h."""
    ranked = stored(ranked, "trie-ranked")
    sizes = stored(ranked.where("rank = 1").select("conv", "n"), "trie-sizes")
    own = sizes.select("conv", "n", (F.crc32(F.col("conv").cast("string")) % BRANCH).alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = stored(own.join(bases, "base", "left").select(
        "conv", "base", "n", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "trie-plan")
    after = (ranked.join(plan.select("conv", "h", "taken"), "conv").where("rank > h")
             .select("conv", (F.col("taken") + F.col("rank") - F.col("h")).alias("depth"), "hash", "chars"))
    heads = ranked.where(F.col("rank") < BRANCH).select(F.col("conv").alias("base"), "rank", "hash", "chars")
    before = (plan.where("taken > 0").select("conv", "base", "taken").join(heads, "base").where("rank <= taken")
              .select("conv", F.col("rank").alias("depth"), "hash", "chars"))
    totals = plan.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("total"))
    return before.unionByName(after), totals


def paths(turns: DataFrame, totals: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, q1, q2, chars, ends): each prefix of each conversation, its path and the path above."""
    depth, content = F.col("depth").cast("long"), F.col("hash")
    rows = turns.select("conv", depth.alias("depth"), "chars", F.xxhash64(depth, content).alias("x1"), F.xxhash64(content, depth).alias("x2"))
    zero = F.lit(0).cast("long")
    roots = totals.select("conv", zero.alias("depth"), zero.alias("chars"), zero.alias("x1"), zero.alias("x2"))
    summed = stored(prefix_sums(stored(rows.unionByName(roots), "trie-rows"), ["conv", "depth"], {}, {"s1": "x1", "s2": "x2"}), "trie-paths")
    starts = summed.where("depth = 0").select("conv", F.col("s1").alias("f1"), F.col("s2").alias("f2")).join(totals, "conv")
    return summed.join(starts, "conv").select(
        "conv", "depth", "chars", *[(F.col(f"s{i}").bitwiseXOR(F.col(f"f{i}")).bitwiseXOR(F.col(f"x{i}"))).alias(f"k{i}") for i in (1, 2)],
        *[F.col(f"s{i}").bitwiseXOR(F.col(f"f{i}")).alias(f"q{i}") for i in (1, 2)], (F.col("depth") == F.col("total")).alias("ends"))


def nodes_of(prefixes: DataFrame) -> DataFrame:
    """(v, conv, depth, parent, k1, k2, n_convs, chars, n_children, child, sibling): ``v`` numbers the nodes by (conv, depth);
    ``child`` is the first child's conv, ``sibling`` that of the next one."""
    found = stored(prefixes.groupBy("depth", "k1", "k2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), *[F.first(c).alias(c) for c in ("chars", "q1", "q2")]), "trie-found")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv").alias("parent"))
    known = stored(found.join(above, ["depth", "q1", "q2"], "left").drop("q1", "q2"), "trie-known")
    children = known.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"), F.min("conv").alias("child"))
    ordered = stored(prefix_sums(_one(known.select("conv", "depth", "parent")), [F.col("parent").asc_nulls_first(), "depth", "conv"], {"place": "one"}),
                     "trie-siblings")
    following = ordered.select((F.col("place") - 1).alias("place"), "depth", "parent", F.col("conv").alias("sibling"))
    siblings = ordered.join(following, ["place", "depth", "parent"]).select("conv", "depth", "sibling")
    numbered = prefix_sums(_one(known), ["conv", "depth"], {"v": "one"}).drop("one")
    return (numbered.join(children, ["conv", "depth"], "left").join(siblings, ["conv", "depth"], "left")
            .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))


def arcs_of(nodes: DataFrame) -> DataFrame:
    """(arc, next, leaf, saved): enter arc 2v and exit arc 2v + 1 of each node, and the arc that follows (-1 at the end)."""
    long = lambda x: F.lit(x).cast("long")
    enter = F.struct((F.col("v") * 2).alias("arc"), F.coalesce("child", "conv").alias("conv"),
                     F.when(F.col("child").isNull(), F.col("depth")).otherwise(F.col("depth") + 1).alias("depth"),
                     F.when(F.col("child").isNull(), long(1)).otherwise(long(0)).alias("kind"),
                     F.when(F.col("n_children") == 0, long(1)).otherwise(long(0)).alias("leaf"),
                     ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    last = F.col("sibling").isNull()
    leave = F.struct((F.col("v") * 2 + 1).alias("arc"), F.when(last, F.col("parent")).otherwise(F.col("sibling")).alias("conv"),
                     F.when(last, F.col("depth") - 1).otherwise(F.col("depth")).alias("depth"),
                     F.when(last, long(1)).otherwise(long(0)).alias("kind"), long(0).alias("leaf"), long(0).alias("saved"))
    arcs = nodes.select(F.explode(F.array(enter, leave)).alias("a")).select("a.*")
    return (arcs.join(nodes.select("conv", "depth", "v"), ["conv", "depth"], "left")
            .select("arc", F.coalesce(F.col("v") * 2 + F.col("kind"), long(-1)).alias("next"), "leaf", "saved"))


def contracted(arc: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(head, offset, tails) of the arcs of one range, ``arc`` ascending: the first arc of each one's segment, the steps from
    there, and the arcs whose successor lies in another range."""
    place = np.searchsorted(arc, after)
    inside = (place < len(arc)) & (arc[np.minimum(place, len(arc) - 1)] == after)
    head, offset = np.arange(len(arc)), np.zeros(len(arc), np.int64)
    head[place[inside]] = np.flatnonzero(inside)
    offset[place[inside]] = 1
    while (head[head] != head).any():
        offset += offset[head]
        head = head[head]
    return head, offset, np.flatnonzero(~inside)


def ranked_tour(arcs: DataFrame) -> DataFrame:
    """(arc, place, leaf, saved): places in the tour, from 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = [b for b in batches if b.num_rows]  # one range of the arcs
        if not filled:
            return
        own = pa.Table.from_batches(filled)
        arc, after = (own.column(c).to_numpy() for c in ("arc", "next"))
        head, offset, tails = contracted(arc, after)
        length, beyond = np.zeros(len(arc), np.int64), np.full(len(arc), -1)
        length[head[tails]], beyond[head[tails]] = offset[tails] + 1, after[tails]
        yield from pa.table({"arc": arc, "head": arc[head], "offset": offset, "length": length, "beyond": beyond,
                             "leaf": own.column("leaf"), "saved": own.column("saved")}).to_batches(max_chunksize=100_000)

    spark = arcs.sparkSession
    placed = stored(stored(arcs, "trie-arcs").repartitionByRange(spread(spark), "arc").sortWithinPartitions("arc").mapInArrow(
        run, "arc long, head long, offset long, length long, beyond long, leaf long, saved long"), "trie-segments")
    way = stored(placed.where("arc = head").select("head", F.col("beyond").alias("next"), F.col("length").alias("way")), "trie-way")
    while not way.where("next >= 0").isEmpty():
        then = way.select(F.col("head").alias("next"), F.col("next").alias("far"), F.col("way").alias("more"))
        way = stored(way.join(then, "next", "left").select(
            "head", F.coalesce("far", F.lit(-1).cast("long")).alias("next"), (F.col("way") + F.coalesce("more", F.lit(0))).alias("way")), "trie-way")
    total = placed.count()
    return placed.join(way.select("head", "way"), "head").select(
        "arc", (F.lit(total).cast("long") - F.col("way") + F.col("offset")).alias("place"), "leaf", "saved")


def ends_of(prefixes: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): SHA-256 of the decimal ids, ascending and joined by commas, that end at each node."""
    names = ["depth", "k1", "k2"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, done = None, [], []
        for b in batches:
            for *key, conv in zip(*[c.to_pylist() for c in b.columns]):
                if key != node or len(ids) == RUN:
                    if ids:
                        done.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = key, []
                ids.append(conv)
            if done:
                yield _batch(done, [*names, "first"], "ids")
                done = []
        if ids:
            yield _batch([(*node, ids[0], ",".join(map(str, ids)))], [*names, "first"], "ids")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for b in batches:
            for *key, _, ids in zip(*[c.to_pylist() for c in b.columns]):
                if key == node:
                    state.update(b"," + ids.encode())
                else:
                    if state:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
            if done:
                yield _batch(done, names, "ends_sha256")
                done = []
        if state:
            yield _batch([(*node, state.hexdigest())], names, "ends_sha256")

    n = spread(prefixes.sparkSession)
    ended = stored(prefixes.where("ends").select(*names, "conv"), "trie-ends")
    joined = (ended.repartitionByRange(n, *names, "conv").sortWithinPartitions(*names, "conv")
              .mapInArrow(runs, "depth long, k1 long, k2 long, first long, ids string"))
    return (joined.repartition(n, *names).sortWithinPartitions(*names, "first")
            .mapInArrow(hashes, "depth long, k1 long, k2 long, ends_sha256 string"))


def _batch(rows: list[tuple], longs: list[str], text: str) -> pa.RecordBatch:
    *numbers, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), pa.array(texts, pa.string())], [*longs, text])


def trie(turns: DataFrame, totals: DataFrame) -> DataFrame:
    """All nodes of conversations given as (conv, depth, hash, chars), depths from 1, and (conv, total number of turns):
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    prefixes = stored(paths(turns, totals), "trie-prefixes")
    nodes = stored(nodes_of(prefixes), "trie-nodes")
    tour = stored(ranked_tour(arcs_of(nodes)), "trie-tour")
    sums = prefix_sums(tour, ["place"], {"leaves": "leaf", "savings": "saved"})
    subtrees = sums.groupBy(F.floor(F.col("arc") / 2).alias("v")).agg(
        (F.max("leaves") - F.min("leaves")).alias("n_leaves"), (F.max("savings") - F.min("savings")).alias("saved_tokens"))
    return (nodes.join(subtrees, "v").join(ends_of(prefixes), ["depth", "k1", "k2"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def op11_prefix_trie(spark, folder):
    return trie(*rebuilt(turns_of(table(spark, folder, "conversations"))))


SQL = f"""
WITH s AS (SELECT conv_id AS c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS hash,
    length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT c, hash, chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, hash) AS r FROM s),
n AS (SELECT c, count(*) AS n, {crc32_sql("c::VARCHAR")} % {BRANCH} AS h, c - c % {FAMILY} AS base FROM t GROUP BY c),
p AS (SELECT n.c, n.n, n.h, n.base, least(n.h, coalesce(b.n, 0)) AS m FROM n LEFT JOIN n b ON n.base = b.c),
r AS (SELECT p.c, t.r AS d, hash, chars FROM p JOIN t ON t.c = p.base AND t.r <= m
      UNION ALL SELECT p.c, m + t.r - h, hash, chars FROM p JOIN t ON t.c = p.c AND t.r > h),
k AS (SELECT c, 0 AS d, '' AS path, NULL AS above, 0 AS chars FROM p
      UNION ALL SELECT c, d, md5(string_agg(hash, '') OVER upto), CASE WHEN d = 1 THEN '' ELSE md5(string_agg(hash, '') OVER upto_above) END, chars FROM r
      WINDOW upto AS (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING),
             upto_above AS (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT c, max(d) AS total FROM k GROUP BY c),
v AS (SELECT d, path, any_value(above) AS above, min(k.c) AS c, count(*) AS n_convs, any_value(chars) AS chars,
      coalesce(string_agg(k.c::VARCHAR, ',' ORDER BY k.c) FILTER (d = total), '') AS ends FROM k JOIN e ON k.c = e.c GROUP BY d, path),
ch AS (SELECT d - 1 AS d, above AS path, count(*) AS n_children FROM v WHERE d > 0 GROUP BY 1, 2),
w AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN ch ON v.d = ch.d AND v.path = ch.path),
sums AS (SELECT a.d, a.path, count(*) FILTER (w.n_children = 0) AS n_leaves, sum((w.n_convs - 1) * w.chars) AS saved
         FROM w JOIN k a ON a.c = w.c AND a.d <= w.d GROUP BY a.d, a.path)
SELECT w.c AS conv_id, w.d::BIGINT AS depth, u.c AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved::BIGINT AS saved_tokens,
  sha256(w.ends) AS ends_sha256
FROM w JOIN sums ON w.d = sums.d AND w.path = sums.path LEFT JOIN v u ON u.d = w.d - 1 AND u.path = w.above"""
