"""Byte-level BPE by recursive DuckDB queries inside the tasks of a partition.

Texts are cut by the tokenizer's pattern; each match is encoded separately. A task keeps the ids of words and of matches
it has seen (twice ``WORDS_KEPT`` of each at most) and hands the new matches, ``PIECES`` at a time, to one recursive query:
token-position rows join the merge table, each step contracts the leftmost minimum-rank pair of each match, matches without
a mergeable pair leave the recursion. Decoding joins ids with the vocabulary and aggregates bytes in the order of positions.

The merge table has, for each token and each way to cut it into two tokens, the token's rank. Defined cases: a null or
empty text has no ids and decodes to no bytes; rows are encoded one by one, whatever their ids; lone surrogates cannot
occur in Spark strings; texts of any length are encoded whole. Steps of one match grow with its length in bytes, so that
an unbroken run of letters of n bytes costs n * n / 2 rows. ``encode`` and ``decode`` pass all other columns through.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tabulon.llm.common import free_name, held, table

WORDS_KEPT, PIECES = 150_000, 40_000
#: Bytes of texts or ids that a task takes at once, and bytes of ids that go to one decoding query (a longer text goes alone).
BYTES_AT_ONCE, IDS_AT_ONCE = 4_000_000, 1_000_000
_U32 = np.dtype("<u4")

#: Rows (word, position, token, next position, next token). ``best`` is each word's leftmost pair of least rank; the second token's
#: row goes, and the rows before and at the pair take over its links.
_ENCODE = """
WITH RECURSIVE s AS (
  SELECT w, p, t, p + 1 AS np, nt, 0 AS step FROM start
  UNION ALL
  SELECT w, p, t, np, nt, step FROM (
    WITH best AS (SELECT w, min((rank::BIGINT << 32) + p) AS k, arg_min(np, (rank::BIGINT << 32) + p) AS gone
                  FROM s JOIN merges g ON g.l = s.t AND g.r = s.nt GROUP BY w),
    pair AS (SELECT b.w, (k & 4294967295)::INTEGER AS place, (k >> 32)::INTEGER AS rank, gone, s.np AS far, s.nt AS beyond
             FROM best b JOIN s ON s.w = b.w AND s.p = gone)
    SELECT s.w, p, CASE WHEN p = place THEN rank ELSE t END AS t, CASE WHEN p = place THEN far ELSE np END AS np,
           CASE WHEN p = place THEN beyond WHEN np = place THEN rank ELSE nt END AS nt, step + 1 AS step
    FROM s JOIN pair ON s.w = pair.w WHERE p <> gone))
SELECT w, t FROM s JOIN (SELECT w, max(step) AS step FROM s GROUP BY w) USING (w, step) ORDER BY w, p"""

_DECODE = "SELECT d, list(b ORDER BY p) AS parts FROM ids JOIN vocabulary USING (t) GROUP BY d"


#: White space besides the space.
_GAPS = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def _odd(text: str) -> bool:
    """If a space stands at an end or beside other white space. A space between two other characters always begins a match;
    texts with other gaps are cut whole."""
    return (text[:1] == " " or text[-1:] == " " or "  " in text
            or any(f" {c}" in text or f"{c} " in text for c in _GAPS if c in text))


class Known:
    """Ids of words in two generations: words of the older one that are seen again move to the younger."""

    def __init__(self):
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def missing(self, words: set[str]) -> list[str]:
        if len(self.ids) > WORDS_KEPT:
            self.older, self.ids = self.ids, {}
        new = [w for w in words if w not in self.ids]
        self.ids.update((w, self.older[w]) for w in new if w in self.older)
        return [w for w in new if w not in self.older]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Bpe:
    """The merge table and the vocabulary of one rank file in a DuckDB session of one thread."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        ranks = read_ranks(path)
        self.find = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        cuts = np.array([(ranks[k[:i]], ranks[k[i:]], r) for k, r in ranks.items() for i in range(1, len(k))
                         if k[:i] in ranks and k[i:] in ranks], np.int32).reshape(-1, 3)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self.db.register("cuts", pa.table({"l": cuts[:, 0], "r": cuts[:, 1], "rank": cuts[:, 2]}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM cuts")
        self.db.register("tokens", pa.table({"t": pa.array(ranks.values(), pa.int32()), "b": pa.array(ranks.keys(), pa.binary())}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM tokens")
        # Words as they stand, and words that follow a space, which their keys leave out; and the matches in them.
        self.known, self.matches = {"": Known(), " ": Known()}, Known()

    def pieces(self, matches: list[str]) -> dict[str, bytes]:
        """Ids of pattern matches, as little-endian 32-bit integers."""
        out = {}
        for k in range(0, len(matches), PIECES):
            part = [m.encode() for m in matches[k:k + PIECES]]
            lengths = np.array([len(x) for x in part])
            word = np.repeat(np.arange(len(part), dtype=np.int32), lengths)
            place = (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            token = self.byte[np.frombuffer(b"".join(part), np.uint8)]
            after = np.append(token[1:], np.int32(-1))
            after[np.cumsum(lengths) - 1] = -1
            self.db.register("start", pa.table({"w": word, "p": place, "t": token, "nt": after}))
            found = self.db.sql(_ENCODE).to_arrow_table()
            ids, ends = found.column("t").to_numpy().astype(_U32).tobytes(), np.cumsum(np.bincount(found.column("w").to_numpy())) * 4
            out.update(zip(matches[k:k + PIECES], (ids[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()))))
        return out

    def words(self, text: str) -> tuple[list[str], list[str]]:
        """The words of a text: those as they stand, and after them those that follow a space each."""
        if _odd(text):
            return self.find(text), []
        head, *rest = text.split(" ")
        return [head], rest

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = dict(zip(self.known, zip(*map(self.words, texts))))
        found = {before: {w: self.find(before + w) for w in known.missing(set().union(*cut[before]))} for before, known in self.known.items()}
        new = self.matches.missing(set().union(*(m for words in found.values() for m in words.values())))
        self.matches.ids.update(self.pieces(new))
        ids = self.matches.ids.__getitem__
        for before, words in found.items():
            self.known[before].ids.update((w, b"".join(map(ids, matches))) for w, matches in words.items())
        plain, spaced = (known.ids.__getitem__ for known in self.known.values())
        return [b"".join(map(plain, a)) + b"".join(map(spaced, b)) for a, b in zip(*cut.values())]

    def decode(self, coded: list[bytes]) -> list[bytes]:
        return [x for s in _groups([len(x) for x in coded], IDS_AT_ONCE) for x in self._decode(coded[s])]

    def _decode(self, coded: list[bytes]) -> list[bytes]:
        lengths = np.array([len(x) // 4 for x in coded], np.int64)
        ids = np.frombuffer(b"".join(coded), _U32).astype(np.int32)
        out = [b""] * len(coded)
        if not len(ids):
            return out
        place = (np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        self.db.register("ids", pa.table({"d": np.repeat(np.arange(len(coded), dtype=np.int32), lengths), "p": place, "t": ids}))
        for b in self.db.sql(_DECODE).to_arrow_table().to_batches():
            # The bytes of a row's parts lie one after the other in the batch.
            parts = b.column("parts")
            _, ends, data = parts.values.buffers()
            ends, at = np.frombuffer(ends, np.int32)[parts.values.offset:], parts.offsets.to_numpy()
            data = memoryview(data)
            for d, first, last in zip(b.column("d").to_pylist(), ends[at[:-1]].tolist(), ends[at[1:]].tolist()):
                out[d] = bytes(data[first:last])
        return out


def _groups(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices of at most ``most`` in sum, or of one element."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def _bpe(path: str, pattern: str) -> Bpe:
    """One coder for all tasks of a Python worker."""
    return held(("byte BPE", path, pattern), lambda: Bpe(path, pattern))


def _added(df: DataFrame, names: list[str], read: str, work, keep: bool = True) -> DataFrame:
    """``df`` with binary columns ``names`` (replaced if there); ``work(values)`` makes them from slices of column ``read``, which
    goes unless ``keep`` is set."""
    kept = df.drop(*names, *([] if keep else [read]))
    given = free_name(df, "_given")
    source = df.withColumn(given, df[read]).select(*kept.columns, given)
    place = len(source.columns) - 1
    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, T.BinaryType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(place)), 0).to_pylist()
            for s in _groups(sizes, BYTES_AT_ONCE):
                b = whole.slice(s.start, s.stop - s.start)
                done = [pa.array(x, pa.binary()) for x in work(b.column(place).to_pylist())]
                yield pa.RecordBatch.from_arrays([*b.columns[:place], *done], [*b.schema.names[:place], *names])

    return source.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text as little-endian 32-bit integers (binary)."""
    return _added(docs, [ids], text, lambda v: [_bpe(path, pattern).encode([x or "" for x in v])])


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of each id list (binary)."""
    return _added(docs, [decoded], ids, lambda v: [_bpe(path, pattern).decode([x or b"" for x in v])])


def encode_decode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded",
                  keep: bool = True) -> DataFrame:
    """``docs`` with the ids of each whole text and the bytes that these ids decode to, by one Python worker a task; without the
    texts unless ``keep`` is set."""
    def work(values):
        coded = _bpe(path, pattern).encode([x or "" for x in values])
        return [coded, _bpe(path, pattern).decode(coded)]
    return _added(docs, [ids, decoded], text, work, keep)


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row."""
    import public_tokenizers
    path, pattern = public_tokenizers.path(file), public_tokenizers.PATTERN
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    both = encode_decode(given, path, pattern, keep=False)
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_bpe(spark, folder):
    return round_trip(table(spark, folder, "documents"))
