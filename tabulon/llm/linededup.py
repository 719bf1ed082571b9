"""Line deduplication by site-relative frequency.

A line is boilerplate of its host if the share of the host's pages that contain it exceeds ``ratio`` and at least
``min_pages`` pages contain it. Boilerplate lines are dropped from the pages of that host only.

Exact copies of a text on one host count as one page, so that a copied page does not turn its own lines into
boilerplate. Lines are split at line feeds and compared without leading and trailing spaces; blank lines are
neither counted nor dropped. Defined cases: a null or empty text stays as it is; null hosts form one host of their own;
a line repeated within a page counts once for it, all its repetitions are dropped; repeated rows count once and all
lose the line; a page may lose all its lines and then has an empty text; an empty table gives an empty table. Columns besides
host and text pass through, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabulon.llm.common import free_name, stored, table

RATIO = 0.01
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """128 bits stand for a line, so that only 16 bytes of it are shuffled."""
    return F.unhex(F.md5(F.trim(line)))


def _host(host: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_key, n_pages, host_pages) of the boilerplate lines; ``host`` is null-safe text ('' for null).

    Counts combine before the shuffle, which deals by host and line: neither a hot host nor a hot line meets in one task.
    """
    of = pages.select(_host(host).alias("host"), F.col(text).alias("text"),
                      F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("page"))
    sizes = of.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), _key))
    counts = (of.select("host", "page", F.explode(keys).alias("line_key")).distinct().groupBy("host", "line_key")
              .agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages))
    return counts.join(sizes, "host").where(F.col("n_pages") > ratio * F.col("host_pages"))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped: str | None = None) -> DataFrame:
    """``pages`` without boilerplate lines; ``dropped`` names an added column with the number of lines taken out.

    A host has at most (its mean number of lines per page) / ``ratio`` boilerplate lines, so its list is one array. The lists
    are stored first: by their size on disk the planner sends them to the pages, or else joins by host, where a hot host's
    pages are split and each part meets the one list. In the first case no text is shuffled.
    """
    h, bad, parts = (free_name(pages, x) for x in ("_host", "_bad", "_parts"))
    lists = stored(boilerplate(pages, host, text, ratio, min_pages).groupBy("host")
                   .agg(F.collect_set("line_key").alias(bad)).withColumnRenamed("host", h), "lines")
    joined = pages.withColumn(h, _host(host)).join(lists, h, "left")
    kept = F.filter(_lines(F.col(text)), lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(bad), _key(x)))
    out = joined.withColumn(parts, F.when(F.col(bad).isNotNull() & F.col(text).isNotNull(), kept))
    columns = [F.when(F.col(parts).isNull(), F.col(text)).otherwise(F.concat_ws("\n", parts)).alias(text) if c == text
               else F.col(f"`{c}`") for c in pages.columns]
    if dropped:
        columns.append(F.when(F.col(parts).isNull(), F.lit(0))
                       .otherwise(F.size(_lines(F.col(text))) - F.size(parts)).cast("long").alias(dropped))
    return out.select(*columns)


def op9_line_dedup(spark, folder):
    return drop_boilerplate(table(spark, folder, "documents"), dropped="n_dropped").select("doc_id", "source", "text", "n_dropped")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(text, '') AS page, doc_id, source, text FROM documents),
lines AS (SELECT k, page, doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS i,
                 unnest(string_split(text, chr(10))) AS line FROM d),
counts AS (SELECT source, trim(line) AS line, count(DISTINCT page) AS n FROM lines WHERE trim(line) <> '' GROUP BY ALL),
sizes AS (SELECT source, count(DISTINCT page) AS pages FROM d GROUP BY ALL),
bad AS (SELECT c.source, c.line FROM counts c JOIN sizes s ON c.source IS NOT DISTINCT FROM s.source
        WHERE n >= {MIN_PAGES} AND n > {RATIO} * pages),
kept AS (SELECT l.k, string_agg(l.line, chr(10) ORDER BY i) FILTER (b.line IS NULL) AS text,
                count(b.line)::BIGINT AS n_dropped
         FROM lines l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line) = b.line GROUP BY ALL)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(n_dropped, 0) AS n_dropped
FROM d LEFT JOIN kept USING (k)"""
