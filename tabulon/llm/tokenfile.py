"""Token-id files coded by a static range asymmetric numeral system.

A token file is a folder of two Parquet tables. ``table`` has one row with the frequencies of all symbols, scaled to sum
to 2**20, which all blocks share. ``blocks`` has independent blocks of whole documents (at least ``BLOCK`` ids each,
except the last of a part): ``LANES`` interleaved 64-bit states and one stream of 32-bit words, a checkpoint (states and
place in the stream) every ``STEPS`` steps from which decoding can start, a CRC-32 of the ids, and the ids and lengths of
the documents. Parts are consecutive ranges of the order of documents; ``first`` is the place of a block in its part.

Documents are in ascending order of id (nulls first), those of equal id by the hash of their text. Defined cases: a null
or empty text has only the end id; repeated rows are kept; texts of any length are coded whole, a long one is a block of
its own; an empty table gives a file without blocks; an added token of the vocabulary ("<|endoftext|>") that stands in a text
is that token if ``added`` is set, as in the library's plain call and in op8, else plain text. Other columns are not read.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabulon.llm.common import held, shared_folder, spread, stored, table

SCALE = 20
LOW = np.uint64(1 << 31)
LANES, STEPS, BLOCK = 256, 128, 1 << 16
#: Distinct words whose ids a worker keeps in each of two generations.
WORDS_KEPT = 300_000
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Characters that Python takes for white space and the vocabulary does not.
_ODD = re.compile("[\x1c-\x1f]")
_U32, _U64 = np.dtype("<u4"), np.dtype("<u8")


def packed_type(path: str) -> str:
    """The type in which ids pass between tasks: 16 bits if the vocabulary fits."""
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


class WordIds:
    """Ids of texts by the tokenizers library, which sees each distinct word once.

    The vocabulary drops white space before it merges, so that words between white space are encoded independently. New
    words go to the library many at a time, with a mark of their own between them, and are cut apart at its id. Texts
    with added tokens go to the library as they stand; their words with such a token are known as None.
    """
    MARK, TOGETHER = "\x01", 2000

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = self.tokenizer.get_added_tokens_decoder() if added else {}
        self.added = np.array(sorted(tokens), np.int64)
        #: An added token with white space inside is in no word.
        self.whole = any(len(_SPACE.split(t.content)) > 1 for t in tokens.values())
        self.type = np.dtype(packed_type(path))
        self.mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        # Two generations of known words: those of the older one that are seen again move to the younger.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.type) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if self.MARK not in w] if len(self.mark) == 1 else []
        groups = [plain[k:k + self.TOGETHER] for k in range(0, len(plain), self.TOGETHER)]
        for group, ids in zip(groups, self._ids([f" {self.MARK} ".join(g) for g in groups])):
            cuts = np.flatnonzero(ids == self.mark[0])
            data, size = ids.tobytes(), self.type.itemsize
            starts, ends = np.r_[0, cuts + 1] * size, np.r_[cuts, len(ids)] * size
            self.known.update(zip(group, (data[a:b] for a, b in zip(starts.tolist(), ends.tolist())), strict=True))
            if len(self.added):
                places = np.flatnonzero(np.isin(ids, self.added))
                self.known.update((group[k], None) for k in np.searchsorted(cuts, places).tolist())
        rest = [w for w in words if w not in self.known]
        self.known.update(zip(rest, (None if np.isin(x, self.added).any() else x.tobytes() for x in self._ids(rest))))

    def __call__(self, texts: list[str], end: int) -> list[bytes]:
        """Packed ids of each text and the end id."""
        cut = [_SPACE.split(t) if _ODD.search(t) else t.split() for t in texts]
        if len(self.known) > WORDS_KEPT:
            self.older, self.known = self.known, {}
        wanted = {w for w in set().union(*cut) if w not in self.known}
        again = {w: self.older[w] for w in wanted if w in self.older}
        self.known.update(again)
        self.learn([w for w in wanted if w not in again])
        last = np.array([end], self.type).tobytes()
        parts = [list(map(self.known.__getitem__, c)) for c in cut]
        return [(self._ids([t])[0].tobytes() if self.whole or None in p else b"".join(p)) + last for t, p in zip(texts, parts)]


def _word_ids(path: str, added: bool) -> WordIds:
    """One encoder for all tasks of a Python worker."""
    return held(("word ids", path, added), lambda: WordIds(path, added))


def token_ids(docs: DataFrame, path: str, end: int, doc_id: str = "doc_id", text: str = "text", added: bool = False) -> DataFrame:
    """(doc_id, tie, ids): the ids of each whole text with the end id, as little-endian integers of ``packed_type``."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tie"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                done = pa.array(_word_ids(path, added)(b.column("text").to_pylist(), end), pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tie"), done], ["doc_id", "tie", "ids"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, tie long, ids binary")


def frequencies(ids: DataFrame, packed: str) -> np.ndarray:
    """Counts of all ids scaled to sum to 2**SCALE, at least 1 for each id that occurs."""
    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for x in b["ids"]:
                c = np.bincount(np.frombuffer(x, packed))
                if len(c) > len(total):
                    total = np.pad(total, (0, len(c) - len(total)))
                total[:len(c)] += c
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"symbol": seen, "n": total[seen]})

    # One row per symbol of the vocabulary at most.
    rows = ids.select("ids").mapInPandas(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()
    if rows.empty:
        return np.zeros(0, np.uint32)
    if len(rows) > 1 << SCALE:
        raise ValueError(f"{len(rows)} symbols do not fit into 2**{SCALE} slots")
    counts = np.zeros(int(rows["symbol"].max()) + 1, np.int64)
    counts[rows["symbol"]] = rows["n"]
    room = (1 << SCALE) - len(rows)
    scaled = np.where(counts > 0, (counts.astype(float) / counts.sum() * room).astype(np.int64) + 1, 0)
    scaled[scaled.argmax()] += (1 << SCALE) - scaled.sum()
    return scaled.astype(np.uint32)


class Coder:
    """Encodes and decodes blocks with one frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
        """(states, places, words): states and place in the word stream at each checkpoint, and the stream."""
        x = np.full(LANES, LOW, np.uint64)
        steps = -(-len(ids) // LANES)
        chunks, emitted, states, places = [], 0, [], []
        for t in range(steps - 1, -1, -1):
            s = ids[t * LANES:(t + 1) * LANES]
            f, y = self.freq[s], x[:len(s)]
            full = y >= (f << np.uint64(63 - SCALE))
            chunks.append(y[full].astype(np.uint32))
            emitted += len(chunks[-1])
            y = np.where(full, y >> np.uint64(32), y)
            q = y // f
            x[:len(s)] = (q << np.uint64(SCALE)) + (y - q * f) + self.start[s]
            if t % STEPS == 0:
                states.append(x.copy())
                places.append(emitted)
        words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, np.uint32)
        states = np.array(states[::-1], np.uint64)
        places = emitted - np.array(places[::-1], np.int64)
        return states.astype(_U64).tobytes(), places.astype(_U32).tobytes(), words.astype(_U32).tobytes()

    def decode_from(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids from one checkpoint on; needs nothing of what stands before it."""
        x, out, at = states.astype(np.uint64), np.empty(n, np.uint32), 0
        mask = np.uint64((1 << SCALE) - 1)
        for k in range(0, n, LANES):
            y = x[:min(LANES, n - k)]
            slot = y & mask
            s = self.symbol[slot.astype(np.int64)]
            out[k:k + len(y)] = s
            y = self.freq[s] * (y >> np.uint64(SCALE)) + slot - self.start[s]
            low = np.flatnonzero(y < LOW)
            y[low] = (y[low] << np.uint64(32)) | words[at:at + len(low)]
            at += len(low)
            x[:len(y)] = y
        return out

    def decode(self, states: bytes, places: bytes, words: bytes, n: int) -> np.ndarray:
        states, places = np.frombuffer(states, _U64).reshape(-1, LANES), np.frombuffer(places, _U32)
        words, span = np.frombuffer(words, _U32).astype(np.uint64), LANES * STEPS
        parts = [self.decode_from(s, words[p:], min(span, n - i * span)) for i, (s, p) in enumerate(zip(states, places))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write(ids: DataFrame, folder: str, packed: str, partitions: int | None = None) -> None:
    """Write (doc_id, tie, ids) rows, ids of type ``packed``, as a token file. The order is by ranges of ids: no task holds more than a range."""
    spark = ids.sparkSession
    freq = frequencies(ids, packed)
    spark.createDataFrame([(SCALE, bytearray(freq.astype(_U32).tobytes()), zlib.crc32(freq.astype(_U32).tobytes()))],
                          "scale int, frequencies binary, crc32 long").write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(freq)  # at most 4 bytes per symbol of the vocabulary
    kind, width = ids.schema["doc_id"].dataType.simpleString(), np.dtype(packed).itemsize
    schema = (f"part int, first long, n_ids long, states binary, places binary, words binary, crc32 long, "
              f"doc_ids array<{kind}>, lengths array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, first, size = Coder(shared.value), TaskContext.get().partitionId(), 0, 0
        names, pieces = [], []

        def block(name_type):
            symbols = np.frombuffer(b"".join(pieces), packed).astype(_U32)
            states, places, words = coder.encode(symbols)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(symbols)], pa.int64()),
                *(pa.array([x], pa.binary()) for x in (states, places, words)), pa.array([zlib.crc32(symbols.tobytes())], pa.int64()),
                pa.array([names], pa.list_(name_type)), pa.array([[len(x) // width for x in pieces]], pa.list_(pa.int64()))],
                ["part", "first", "n_ids", "states", "places", "words", "crc32", "doc_ids", "lengths"])

        for b in batches:
            for name, x in zip(b.column("doc_id").to_pylist(), b.column("ids")):
                names.append(name)
                pieces.append(x.as_py())
                size += len(pieces[-1]) // width
                if size >= BLOCK:
                    yield block(b.column("doc_id").type)
                    first, size, names, pieces = first + size, 0, [], []
        if pieces:
            yield block(b.column("doc_id").type)

    (ids.repartitionByRange(partitions or spread(spark), F.col("doc_id").asc_nulls_first(), "tie")
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
     .mapInArrow(run, schema).write.parquet(f"{folder}/blocks"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of a token file: ``start`` counts the ids of all documents before; blocks decode in parallel."""
    head = spark.read.parquet(f"{folder}/table").first()
    if zlib.crc32(bytes(head["frequencies"])) != head["crc32"]:
        raise ValueError("the frequency table is damaged")
    shared = spark.sparkContext.broadcast(np.frombuffer(bytes(head["frequencies"]), _U32))
    blocks = spark.read.parquet(f"{folder}/blocks")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per part of the file.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", before.alias("base"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                ids = coder.decode(r["states"], r["places"], r["words"], r["n_ids"]).astype(_U32)
                if zlib.crc32(ids.tobytes()) != r["crc32"]:
                    raise ValueError(f"block {r['first']} of part {r['part']} is damaged")
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["doc_ids"], b.column("doc_ids").type.value_type),
                    pa.array(r["base"] + r["first"] + ends - lengths, pa.int64()),
                    pa.array([ids[e - n:e].tobytes() for e, n in zip(ends, lengths)], pa.binary())], ["doc_id", "start", "ids"])

    return blocks.join(F.broadcast(parts), "part").mapInArrow(run, f"doc_id {kind}, start long, ids binary")


def op8_token_file(spark, folder):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = stored(token_ids(table(spark, folder, "documents"), path, 1, added=True), "token-ids")
    file = shared_folder(spark, "token-file")
    write(ids, file, packed_type(path))
    wide = read(spark, file)
    return wide.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
