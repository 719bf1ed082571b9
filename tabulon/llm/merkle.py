"""Merkle manifest of a dataset with incremental witnesses.

Each document is a leaf: the SHA-256 (lowercase hex) of its columns, each as ``-`` if null, else UTF-8 byte count, ``:`` and
value. The leaves of a language, ascending by id (nulls first, equal ids by leaf), are the nodes of the lowest level; every
``ARITY`` consecutive nodes, and the fewer at the end, become their hash until one is left. These subroots, by language (null
first), likewise give the root.

Nodes are appended one after the other to a tree of open runs. A node that joins a run gets a partial witness, the siblings to
its left; each later sibling extends the witness of the open subtrees of its run. ``BLOCK`` nodes that are aligned to whole
runs make a block, which one task appends without the others; the roots of the blocks are appends to the next tree above, so
that a witness is the chain of those of its blocks. A tree of n nodes has log(n) / log(BLOCK) such levels.

Defined cases: repeated rows are leaves of their own, in adjacent places; a null text is ``-``, an empty one ``0:``; a language
with one document has its leaf as subroot, a table with one language its subroot as root; an empty table has an empty
manifest. Other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabulon.llm.common import prefix_sums, stored, table

ARITY, DEPTH = 8, 3
BLOCK = ARITY ** DEPTH
#: Places of one stretch in the join of rows and languages.
STRETCH = 8 * BLOCK
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WITNESS = "array<struct<left: string, right: string>>"


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


@dataclass(slots=True)
class Node:
    digest: str
    left: str = ""
    right: list[str] = field(default_factory=list)
    parent: Node | None = None

    def witness(self) -> list[tuple[str, str]]:
        """Siblings to the left and right, from the lowest level up."""
        out, node = [], self
        while node.parent is not None:
            out.append((node.left, "".join(node.right)))
            node = node.parent
        return out


class Appender:
    """A tree of ``levels`` levels to which nodes are appended in order."""

    def __init__(self, levels: int):
        self.open: list[list[Node]] = [[] for _ in range(levels)]
        self.root: Node | None = None

    def append(self, value: str) -> Node:
        return self._place(Node(value), 0)

    def _place(self, node: Node, level: int) -> Node:
        if level == len(self.open):
            self.root = node
            return node
        run = self.open[level]
        node.left = "".join(n.digest for n in run)
        for sibling in run:
            sibling.right.append(node.digest)
        run.append(node)
        if len(run) == ARITY:
            self._complete(level)
        return node

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parent = Node(digest("".join(n.digest for n in run)))
        for n in run:
            n.parent = parent
        self._place(parent, level + 1)

    def close(self) -> Node:
        """Complete the runs at the end; the node that is left."""
        for level in range(len(self.open)):
            if self.open[level]:
                self._complete(level)
        return self.root


def levels_of(n: int) -> int:
    """Levels within a block of a tree of ``n`` nodes."""
    k = 0
    while k < DEPTH and ARITY ** k < n:
        k += 1
    return k


def fold(value: str, witness: list[tuple[str, str]]) -> str:
    """The root that a node and its witness lead to."""
    for left, right in witness:
        value = digest(left + value + right)
    return value


def proof(witness: list[tuple[str, str]]) -> str:
    """Hash of all siblings, level by level."""
    return digest("".join(part for level in witness for part in level))


def leaf(values: dict[str, Column]) -> Column:
    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[framed(c) for c in values.values()]), 256)


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(key, doc_id, leaf, other): ``key`` is the language with a mark in front, empty for null; ``other`` is the leaf with
    texts in lower case (A to Z only) where ``tampered`` holds, else null."""
    plain = {c: F.col(c) for c in COLUMNS}
    changed = plain | {"text": F.translate(F.col("text"), UPPER, LOWER)}
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("key"), "doc_id",
                       leaf(plain).alias("leaf"), F.when(tampered, leaf(changed)).alias("other"))


def _blocks(nodes: DataFrame, payload: list[str], name: str) -> DataFrame:
    """(key, n, block, members) of (key, n, position, digest, payload): members are at most BLOCK nodes in order."""
    b = nodes.groupBy("key", "n", F.floor(F.col("position") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("position", "digest", *payload))).alias("members"))
    return stored(b, name)


def _roots(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for n, members in zip(b.column("n").to_pylist(), _members(b, ["digest"])):
                tree = Appender(levels_of(n))
                for (value,) in members:
                    tree.append(value)
                out.append(tree.close().digest)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("n"), b.column("block"), pa.array(out, pa.string())],
                                             ["key", "n", "block", "digest"])

    return blocks.select("key", "n", "block", "members").mapInArrow(run, "key string, n long, block long, digest string")


def _members(b: pa.RecordBatch, names: list[str]) -> Iterator[list[tuple]]:
    """The named fields of each row's members."""
    lists = b.column("members")
    ends = lists.offsets.to_pylist()
    flat = lists.values
    fields = [flat.field(flat.type.get_field_index(n)) for n in names]
    for a, z in zip(ends[:-1], ends[1:]):
        yield list(zip(*[f.slice(a, z - a).to_pylist() for f in fields]))


def build(nodes: DataFrame, payload: list[str], name: str) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Trees over (key, n, position, digest, payload), n nodes per key: roots (key, digest), and of each level of blocks the
    blocks and the roots (key, digest) of the trees that end there."""
    levels = []
    while True:
        blocks = _blocks(nodes, payload, f"{name}-{len(levels)}")
        roots = stored(_roots(blocks), f"{name}-roots-{len(levels)}")
        levels.append((blocks, roots.where(f"n <= {BLOCK}").select("key", "digest")))
        if (roots.agg(F.max("n")).first()[0] or 0) <= BLOCK:
            break
        nodes = roots.where(f"n > {BLOCK}").select(
            "key", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("position"), "digest")
        payload = []
    found = levels[0][1]
    for _, ended in levels[1:]:
        found = found.unionByName(ended)
    return found, levels


def _chains(b: pa.RecordBatch, names: list[str]) -> Iterator[tuple[dict, list[tuple], list[list[tuple[str, str]]]]]:
    """Of each block its row, its members and their witnesses up to the root that ``upper`` leads to."""
    rows = b.select([n for n in b.schema.names if n != "members"]).to_pylist()
    for row, members in zip(rows, _members(b, ["digest", *names])):
        tree, upper = Appender(levels_of(row["n"])), [(w["left"], w["right"]) for w in row["upper"]]
        placed = [tree.append(m[0]) for m in members]
        tree.close()
        yield row, members, [node.witness() + upper for node in placed]


def _structs(chains: list[list[tuple[str, str]]], kind: pa.DataType) -> pa.Array:
    return pa.array([[{"left": left, "right": right} for left, right in w] for w in chains], kind)


def witnesses(levels: list[tuple[DataFrame, DataFrame]], tops: DataFrame) -> DataFrame:
    """(key, n, block, members, subroot, upper): the lowest blocks with the witness of their root; ``tops`` has
    (key, subroot, upper) of each tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, members, chains in _chains(b, ["position"]):
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["key"]] * len(members), pa.string()), pa.array([m[1] for m in members], pa.int64()),
                    pa.array([row["subroot"]] * len(members), pa.string()), _structs(chains, b.schema.field("upper").type)],
                    ["key", "block", "subroot", "upper"])

    above = None
    for k in range(len(levels) - 1, -1, -1):
        blocks, ended = levels[k]
        here = ended.select("key").join(tops, "key").select("key", F.lit(0).cast("long").alias("block"), "subroot", "upper")
        if above is not None:
            here = here.unionByName(above)
        joined = blocks.join(here, ["key", "block"])
        if k:
            above = joined.select("key", "n", "subroot", "upper", "members").mapInArrow(
                run, f"key string, block long, subroot string, upper {WITNESS}")
    return joined


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root): the root that each row's witness leads to from its leaf, or from
    that of the tampered row where ``tampered`` holds."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    given = stored(leaves(docs, F.lit(False) if tampered is None else tampered), "merkle-leaves")
    placed = prefix_sums(given.withColumn("one", F.lit(1).cast("long")), ["key", F.col("doc_id").asc_nulls_first(), "leaf"], {"place": "one"})
    keys = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    # A language meets its rows stretch by stretch of places, so that a frequent one spreads.
    stretch = F.floor(F.col("place") / STRETCH).alias("stretch")
    parts = keys.select("key", "n", "first", F.explode(F.sequence(F.floor(F.col("first") / STRETCH), F.floor((F.col("first") + F.col("n") - 1) / STRETCH)))
                        .alias("stretch"))
    nodes = placed.withColumn("stretch", stretch).join(parts, ["key", "stretch"]).select("key", "n", (F.col("place") - F.col("first")).alias("position"),
                                            F.col("leaf").alias("digest"), "doc_id", "other")
    subroots, levels = build(nodes, ["doc_id", "other"], "merkle")
    subroots = stored(subroots, "merkle-subroots")
    ordered = prefix_sums(subroots.withColumn("one", F.lit(1).cast("long")), ["key"], {"position": "one"})
    size = subroots.count()
    top, upper = build(ordered.select(F.lit("").alias("key"), F.lit(size).cast("long").alias("n"), "position", "digest",
                                      F.col("key").alias("name")), ["name"], "merkle-top")
    first = top.first()
    root = first["digest"] if first else ""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, members, chains in _chains(b, ["name"]):
                yield pa.RecordBatch.from_arrays([
                    pa.array([m[1] for m in members], pa.string()), pa.array([m[0] for m in members], pa.string()),
                    _structs(chains, b.schema.field("upper").type)], ["key", "subroot", "upper"])

    start = spark.createDataFrame([("", root, [])], f"key string, subroot string, upper {WITNESS}")
    heads = stored(witnesses(upper, start).select("n", "upper", "members").mapInArrow(
        tops, f"key string, subroot string, upper {WITNESS}"), "merkle-heads")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            member = b.column("members").values.type
            id_type = member.field(member.get_field_index("doc_id")).type
            for row, members, chains in _chains(b, ["doc_id", "other"]):
                texts = ([m[0] for m in members], [row["subroot"]] * len(members), [root] * len(members), [proof(w) for w in chains],
                         [fold(other or value, w) for (value, _, other), w in zip(members, chains)])
                yield pa.RecordBatch.from_arrays([pa.array([m[1] for m in members], id_type), *(pa.array(t, pa.string()) for t in texts)],
                                                 ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return witnesses(levels, heads).select("n", "subroot", "upper", "members").mapInArrow(
        prove, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def op12_merkle_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    out = manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def crc32_sql(text: str) -> str:
    """DuckDB expression: unsigned CRC-32 of an ASCII string, bit by bit (3988292384 is its reversed polynomial)."""
    bits = "list_reduce(list_prepend(xor(c, b), [0::BIGINT for _ in range(8)]), lambda x, _z: xor(x >> 1, 3988292384 * (x & 1)))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, [ascii(ch)::BIGINT for ch in string_split({text}, '')]), "
            f"lambda c, b: {bits}))")


def _tree_sql(tag: str, by: str, levels: int) -> str:
    """Tables {tag}1 .. of the levels above {tag}0 (by, p, d, n), and {tag}s0 .. of each node's siblings."""
    out = []
    for k in range(levels):
        out.append(f"""{tag}s{k} AS (SELECT a.{by}, a.p, a.n, a.d,
    coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l, coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS r
  FROM {tag}{k} a JOIN {tag}{k} b ON a.{by} = b.{by} AND a.p // 8 = b.p // 8 GROUP BY a.{by}, a.p, a.n, a.d)""")
        out.append(f"""{tag}{k + 1} AS (SELECT {by}, p // 8 AS p, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY {tag}{k}.p)) END AS d,
    (n + 7) // 8 AS n FROM {tag}{k} GROUP BY {by}, p // 8, n)""")
    return ",\n".join(out)


def _sql(low: int = 8, high: int = 3) -> str:
    """The manifest with trees of up to 8**low documents a language and 8**high languages."""
    framed = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    whole = " || ".join(framed(c) for c in COLUMNS)
    other = whole.replace("text::VARCHAR", f"translate(text, '{UPPER}', '{LOWER}')")
    steps, proofs = [], []
    joins = ""
    for tag, by, levels in (("t", "key", low), ("u", "top", high)):
        for k in range(levels):
            name = f"{tag}s{k}"
            at = f"x.p // {8 ** k}" if tag == "t" else f"y.p // {8 ** k}"
            joins += f" JOIN {name} ON {name}.{by} = {'x.key' if tag == 't' else '0'} AND {name}.p = {at}"
            steps.append(name)
            proofs.append(f"{name}.l || {name}.r")
    chain = []
    for i, name in enumerate(steps):
        chain.append(f"f{i + 1} AS (SELECT * EXCLUDE (f), CASE WHEN n{i} = 1 THEN f ELSE sha256(l{i} || f || r{i}) END AS f FROM f{i})")
    cols = ", ".join(f"{s}.n AS n{i}, {s}.l AS l{i}, {s}.r AS r{i}" for i, s in enumerate(steps))
    return f"""
WITH raw AS (SELECT coalesce('=' || lang, '') AS key, doc_id, sha256({whole}) AS leaf,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN sha256({other}) ELSE sha256({whole}) END AS other FROM documents),
x AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY key) AS n FROM raw),
t0 AS (SELECT key, p, leaf AS d, n FROM x),
{_tree_sql("t", "key", low)},
y AS (SELECT key, d, row_number() OVER (ORDER BY key) - 1 AS p, count(*) OVER () AS n FROM t{low}),
u0 AS (SELECT 0 AS top, p, d, n FROM y),
{_tree_sql("u", "top", high)},
f0 AS (SELECT x.doc_id, x.leaf, y.d AS subroot, u{high}.d AS root, sha256({" || ".join(proofs)}) AS proof_sha256, {cols}, x.other AS f
  FROM x JOIN y ON x.key = y.key JOIN u{high} ON true{joins}),
{", ".join(chain)}
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(steps)}"""


SQL = _sql()
