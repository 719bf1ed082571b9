"""Mixing sources to target weights by weighted fair queueing.

The size of a document is its number of words, runs of characters other than ASCII white space. Sources, by code point and null
last, weigh ``WEIGHTS`` in turn and share ``BUDGET`` times all sizes: a source's target is its share by weight, but at most
``EPOCHS`` times its own size; what is above is shared again by weight until no target is above.

The queue of a source is its documents in an order shuffled by a hash, ``EPOCHS`` times over. A copy's virtual finish time is
the sizes in the queue up to its end, divided by the target, so that all queues reach their targets at time 1. All copies of
all queues are range-sorted by finish time and cut at the total budget: copies that end within it are taken whole, the one
that crosses it in part, later ones not. A source is off its target by about one document at most.

Defined cases: a null text has size 0 and takes nothing, as an empty one; a null source is a source of its own, the last;
repeated rows are documents of their own; ties follow source, hash, id and row; a table without words has targets 0; an empty
table gives none. The result depends on the rows only. Other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabulon.llm.common import prefix_sums, stored, table, whole_text

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: The budget in halves of all sizes (an integer, so that targets are exact until the last division).
BUDGET_HALVES = 3
EPOCHS = 2
SEED = 13


def sized(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, key, size, draw, tie): ``key`` sorts sources by code point and null last."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    tie = F.md5(whole_text("text").cast("binary"))
    return d.select("doc_id", "source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(">")).alias("key"),
                    F.regexp_count(whole_text("text"), F.lit(WORD)).cast("long").alias("size"),
                    F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(str(SEED)))).alias("draw"), tie.alias("tie"))


def targets(sizes: DataFrame) -> DataFrame:
    """(key, source_size, first, target) of (key, size) rows: ``first`` counts the words of the sources before.

    Sources and their caps stay distributed; each round of sharing brings two sums to the driver.
    """
    sources = stored(sizes.groupBy("key").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long")), "mix-sources")
    ranked = stored(prefix_sums(sources, ["key"], {"rank": "one", "first": "source_size"})
                    .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS)).cast("int") + 1)),
                    "mix-ranked")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    total = ranked.agg(F.sum(exact("source_size"))).first()[0] or 0
    limit = None  # the level at which a source's cap is reached: halves of the budget left and weights that share them
    capped = F.lit(False)
    while True:
        left, weights = ranked.agg(F.sum(F.when(capped, exact("source_size") * (2 * EPOCHS)).otherwise(F.lit(0))),
                                   F.sum(F.when(capped, F.lit(0)).otherwise(F.col("weight")))).first()
        now = (BUDGET_HALVES * int(total) - int(left or 0), int(weights or 0))
        if now == limit or not now[1]:
            break
        limit = now
        share = F.lit(now[0]).cast("decimal(19,0)") * F.col("weight")
        capped = share >= exact("source_size") * F.lit(2 * EPOCHS * now[1]).cast("decimal(19,0)")
    if not limit:
        return ranked.select("key", "source_size", "first", F.lit(0.0).alias("target"))
    level = limit[0] / (2 * limit[1])
    return ranked.select("key", "source_size", "first", F.when(capped, F.col("source_size") * float(EPOCHS))
                         .otherwise(F.col("weight") * F.lit(float(level))).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(row, doc_id, source, size, source_size, target, copy, finish, at, taken): all copies of all queues.

    ``row`` marks the document, ``finish`` is the virtual finish time (null if the source has no words), ``at`` the words
    of all copies before, ``taken`` those of this copy that are within the budget: sorted by ``at`` and with
    ``taken > 0`` it is the mix.
    """
    given = stored(sized(docs, doc_id, source, text), "mix-sizes")
    sources = stored(targets(given), "mix-targets")
    queued = prefix_sums(given.withColumn("one", F.lit(1).cast("long")),
                         ["key", "draw", F.col("doc_id").asc_nulls_first(), "tie"], {"row": "one", "before": "size"})
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    copy = F.explode(F.array(*[F.lit(k).cast("long") for k in range(EPOCHS)])).alias("copy")
    ends = (F.col("before") - F.col("first") + F.col("size") + F.col("copy") * F.col("source_size")).cast("double")
    copies = (queued.join(sources, "key").select("row", "doc_id", "source", "size", "source_size", "target", "first", "before", copy)
              .select("row", "doc_id", "source", "size", "source_size", "target", "copy",
                      F.when(F.col("target") > 0, ends / F.col("target")).alias("finish")))
    placed = prefix_sums(stored(copies, "mix-copies"), [F.col("finish").asc_nulls_last(), "row", "copy"], {"at": "size"})
    left = F.lit(BUDGET_HALVES * total // 2).cast("long") - F.col("at")
    return placed.withColumn("taken", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left)))


def op13_source_mixing(spark, folder):
    return (mix(table(spark, folder, "documents")).groupBy("row")
            .agg(*[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum("taken").alias("taken")).drop("row"))


_CAP = 2 * EPOCHS
SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    md5(concat_ws(':', doc_id::VARCHAR, '{SEED}')) AS draw, md5(coalesce(text, '')) AS tie FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM d GROUP BY source),
w AS (SELECT *, coalesce(sum({_CAP} * source_size) OVER before, 0) AS filled, sum(weight) OVER rest AS sharing, sum(source_size) OVER () AS total
  FROM s WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                rest AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
c AS (SELECT *, ({BUDGET_HALVES} * total - filled) * weight >= {_CAP} * source_size * sharing AS capped FROM w),
l AS (SELECT ({BUDGET_HALVES} * any_value(total) - coalesce(sum({_CAP} * source_size) FILTER (capped), 0))::DOUBLE
    / (2 * sum(weight) FILTER (NOT capped))::DOUBLE AS level FROM c),
t AS (SELECT source, source_size, total, CASE WHEN capped THEN source_size * {EPOCHS}::DOUBLE ELSE weight * level END AS target FROM c, l),
q AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id NULLS FIRST, tie ROWS UNBOUNDED PRECEDING) AS upto,
    row_number() OVER (ORDER BY source NULLS LAST, draw, doc_id NULLS FIRST, tie) AS row FROM d),
f AS (SELECT q.*, source_size, total, target, CASE WHEN target > 0 THEN (upto + copy * source_size)::DOUBLE / target END AS finish, copy
  FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source, range({EPOCHS}) copies(copy)),
a AS (SELECT *, sum(size) OVER (ORDER BY finish NULLS LAST, row, copy ROWS UNBOUNDED PRECEDING) - size AS passed FROM f)
SELECT any_value(doc_id) AS doc_id, any_value(size)::BIGINT AS size, any_value(source_size) AS source_size, any_value(target) AS target,
  sum(greatest(0, least(size, {BUDGET_HALVES} * total // 2 - passed)))::BIGINT AS taken FROM a GROUP BY row"""
