"""Prefix trie, Merkle manifest and source mixing against brute force on small frames."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import merkle, mixing, prefixtrie
from tabulon.llm.common import prefix_sums

TURNS = "conv_id long, turn long, role string, text string, conv string, KEY int, depth int"
DOCS = "doc_id long, source string, lang string, n_chars long, text string, key string, N int, leaf string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def crc(i):
    return zlib.crc32(str(i).encode())


def test_prefix_sums_over_ranges(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 2, 3]), i, rng.randrange(-5, 9), rng.getrandbits(62)) for i in range(3000)]
    got = prefix_sums(spark.createDataFrame(data, "g int, i long, a long, b long").repartition(5),
                      [F.col("g").asc_nulls_first(), "i"], {"s": "a"}, {"x": "b"}).collect()
    total, mixed = 0, 0
    for r in sorted(got, key=lambda r: (r.g is not None, r.g, r.i)):
        assert (r.s, r.x) == (total, mixed)
        total, mixed = total + r.a, mixed ^ r.b


# ------------------------------------------------------------------ prefix trie

def trie_by_hand(rows):
    original = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            original[c].append(((turn is not None, turn or 0, tie), (role, text)))
    original = {c: [t for _, t in sorted(ts)] for c, ts in original.items()}
    members = defaultdict(list)
    for c, own in original.items():
        h = crc(c) % 6
        base = int(c - np.fmod(c, 100))
        turns = original.get(base, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, len(turns) == d))
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[x] for x in below) or 1
        saved[path] = sum(saved[x] for x in below) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    name = lambda path: min(c for c, _ in members[path])
    return sorted((name(p), len(p), name(p[:-1]) if p else -1, len(m), len(children[p]), leaves[p], saved[p],
                   sha(",".join(str(c) for c in sorted(c for c, end in m if end)))) for p, m in members.items())


def trie_rows(spark, rows):
    df = prefixtrie.trie(*prefixtrie.rebuilt(prefixtrie.turns_of(spark.createDataFrame(rows, TURNS).repartition(3))))
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


def test_trie_as_by_hand(spark):
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 260), 1000, 1007, 1907, -3, -250, 10**12 + 5]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([None, t, t, t]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", "é€", "", None]), "a", 1, 2))
    rows += rng.sample(rows, 60)  # repeated rows
    rows += [(None, 1, "u", "no conversation", "", 0, 0)]
    rows += [(300 + i, t, "u", f"same {t}", "", 0, 0) for i in range(40) for t in range(7)]  # one conversation many times
    rows += [(777, t, "a", str(t % 3), "", 0, 0) for t in range(500)]  # a long one
    rows += [(778, 0, "u", "z" * 200_000, "", 0, 0)]
    assert trie_rows(spark, rows) == trie_by_hand(rows)


def test_trie_without_turns(spark):
    assert trie_rows(spark, []) == []
    lone = next(c for c in range(100, 200) if crc(c) % 6 > 1 and c % 100)  # its base is absent, its only turn is dropped
    assert trie_rows(spark, [(lone, 1, "u", "x", "", 0, 0)]) == [(lone, 0, -1, 1, 0, 1, 0, sha(str(lone)))]


def test_arcs_contract_within_a_range():
    order = np.random.default_rng(3).permutation(200)
    after = np.full(200, -1)
    after[order[:-1]] = order[1:]
    part = np.sort(order[np.random.default_rng(4).permutation(200)[:120]])
    head, offset, tails = prefixtrie.contracted(part, after[part])
    place = np.empty(200, int)
    place[order] = np.arange(200)
    assert (place[part] - place[part[head]] == offset).all()
    assert not np.isin(after[part[tails]], part).any() and len(tails) == len(np.unique(head))


# --------------------------------------------------------------- Merkle manifest

def tree_by_hand(nodes):
    """The root, and of each node the (left, right) siblings from below up."""
    chains, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_groups = [], []
        for k in range(0, len(nodes), 8):
            run = nodes[k:k + 8]
            for j in range(len(run)):
                for i in groups[k + j]:
                    chains[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha("".join(run)))
            up_groups.append(sum(groups[k:k + 8], []))
        nodes, groups = up, up_groups
    return nodes[0], chains


def manifest_by_hand(rows):
    def leaf(i, source, lang, n, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))
    by = defaultdict(list)
    for i, source, lang, n, text, *_ in rows:
        low = None if text is None else text.translate(str.maketrans(merkle.UPPER, merkle.LOWER))
        changed = i is not None and crc(i) % 3 == 0
        by[lang].append(((i is not None, i or 0, leaf(i, source, lang, n, text)), i, leaf(i, source, lang, n, low if changed else text)))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree_by_hand([k[2] for k, _, _ in sorted(by[x], key=lambda r: r[0])]) for x in langs}
    root, tops = tree_by_hand([trees[x][0] for x in langs])
    out = []
    for x, top in zip(langs, tops):
        for (key, i, other), chain in zip(sorted(by[x], key=lambda r: r[0]), trees[x][1]):
            chain, folded = chain + top, other
            for left, right in chain:
                folded = sha(left + folded + right)
            out.append((i, key[2], trees[x][0], root, sha("".join(a + b for a, b in chain)), folded))
    return out


@pytest.mark.parametrize("n,langs", [(1, 1), (8, 1), (9, 1), (513, 1), (4700, 2), (900, 600)])
def test_manifest_as_by_hand(spark, n, langs):
    rng = random.Random(n)
    names = [None, "", "Ünd", "en", *(f"l{i}" for i in range(langs))][:langs] if langs > 2 else ["en", None][:langs]
    rows = [(i, rng.choice([None, "src0", "a:b"]), names[min(i % 700, langs - 1)], rng.choice([None, i]),
             rng.choice([None, "", "ABC déf ÀÉ", "plain"]), "k", 7, "x") for i in range(n)]
    if n == 4700:
        rows += [(None, None, None, None, None, "k", 7, "x")] * 3 + [rows[5]] * 20 + [(5, "other", "en", 1, "T" * 300_000, "k", 7, "x")]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(4), F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(manifest_by_hand(rows), key=repr)


def test_manifest_of_nothing_and_appender(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0
    tree = merkle.Appender(3)
    nodes = [tree.append(sha(str(i))) for i in range(70)]
    assert not nodes[69].witness() and nodes[0].witness()[0][1] == "".join(sha(str(i)) for i in range(1, 8))  # run complete, tree open
    root = tree.close().digest
    assert all(merkle.fold(sha(str(i)), n.witness()) == root for i, n in enumerate(nodes))


# --------------------------------------------------------------- mixing

def mix_by_hand(rows):
    """{source: (size, target)} by filling the shares anew until none is above its cap."""
    sizes = defaultdict(int)
    for _, source, text, *_ in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, free, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in above} | {s: share[s] for s in free - above}
        if not above:
            return {s: (sizes[s], target[s]) for s in sizes}
        left, free = left - sum(2 * sizes[s] for s in above), free - above


MIX = "doc_id long, source string, text string, row long, copy int, KEY string, size int"


def test_mix_as_by_hand(spark):
    rng = random.Random(5)
    names = [None, "", "src0", "src1", "é", "z", ">", "="]
    rows = [(i, rng.choice(names + ["src0"] * 9), rng.choice(["", None, "a b\tc\nd", "one two " * rng.randrange(1, 20)]), 1, 2, "k", 3)
            for i in range(3000)]
    rows += [(None, "src1", "no id"), (None, "src1", "no id"), (7, "z", "same id"), (8, "src1", "long word " * 20_000)] + [(9, "twin", "x y")] * 5
    rows = [(*r, 1, 2, "k", 3)[:7] for r in rows]
    df = spark.createDataFrame(rows, MIX)
    first, again = (mixing.mix(x).select("doc_id", "source", "size", "source_size", "target", "copy", "taken").toPandas()
                    for x in (df, df.repartition(7)))
    key = ["doc_id", "source", "size", "copy", "taken"]
    assert first.sort_values(key, ignore_index=True).equals(again.sort_values(key, ignore_index=True))
    want = mix_by_hand(rows)
    assert len(first) == 2 * len(rows) and ((first["taken"] >= 0) & (first["taken"] <= first["size"])).all()
    assert first["taken"].sum() == 3 * sum(s for s, _ in want.values()) // 2
    longest = first["size"].max()
    for source, (size, target) in want.items():
        own = first[first["source"].isna() if source is None else first["source"] == source]
        assert (own["source_size"] == size).all() and np.allclose(own["target"], target)
        assert abs(own["taken"].sum() - target) <= (longest if source == "src1" else 200)


def test_mix_follows_finish_times(spark):
    rows = [(i, "ab"[i % 2], "w " * (1 + i % 5), 0, 0, "", 0) for i in range(200)]
    got = mixing.mix(spark.createDataFrame(rows, MIX)).orderBy("at", "copy", "row").toPandas()
    assert got["finish"].is_monotonic_increasing and (got["at"] == got["size"].cumsum() - got["size"]).all()
    budget = got["size"].sum() * 3 // 4
    assert (got["taken"] == (budget - got["at"]).clip(0).clip(upper=got["size"])).all()
    again = mixing.mix(spark.createDataFrame(rows, MIX).where("doc_id < 0"))
    assert again.count() == 0
    silent = mixing.mix(spark.createDataFrame([(1, "a", "", 0, 0, "", 0), (2, None, None, 0, 0, "", 0)], MIX)).collect()
    assert [(r.taken, r.target) for r in silent] == [(0, 0.0)] * 4
