"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders (``\\ue000``, ``\\ue001``, ``\\ue002``), the rest is lower-cased and cut
into words, so that a question asked again with other numbers, names or units has the same template. Windows of ``WINDOW``
template words are hash-joined with those of the benchmark items. The matches of a document and an item on one diagonal
(document position minus item position) form an alignment; it counts only if its slots are consistent: each value of the
item stands for one value of the document throughout. An item leaks into a document if a consistent alignment has at
least ``MIN_SHARE`` of the item's windows, or ``ENOUGH`` of them.

A name is a row of capitalised words with single spaces between them, also at the start of a sentence; words of ``PLAIN`` are
no names. A unit is a word of ``UNITS`` after a number. The templates of windows with more than half placeholders match too much: such a window is exact,
it matches with the values as they stand only. An item also leaks if its template and exact windows together reach the
limits, taken of all its windows. An item of fewer than ``WINDOW`` words is one exact window of its whole length, in short
documents too.

Defined cases: a null or empty text has no windows; a passage repeated in a document has an alignment for each place, the best one counts; rows with the same id and
text are one document, rows with the same id and different texts are told apart; null ids are ids like any other; empty
tables give no matches. Other columns are not read; ``remove_contaminated`` passes them through.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabulon.llm.common import free_name, stored, table

WINDOW = 8
MIN_SHARE = 0.5
ENOUGH = 6
#: Benchmark windows up to this number (about 60 bytes each) are broadcast, more of them are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000
#: Words that often begin a sentence or question and are no names (fixed values).
PLAIN = ("A After Although An And As At Because Before But By Calculate Can Compute Consider Did Do Does Each Every Find First "
         "For From Given Has Have He Her His How However I If In Is It Its Let Many Most My No Not Now Of On Once One Or Our She "
         "Show Since So Solve Some Suppose That The Their Then There These They This Those To Today Two Under Was We Were What "
         "When Where Which While Who Whose Why Will With Write You Your").split()
#: Words that are units after a number.
UNITS = ("mm cm dm m km inch inches foot feet ft yard yards mile miles mg g kg t gram grams kilogram kilograms ton tons "
         "pound pounds lb lbs ounce ounces oz ml cl l liter liters litre litres gallon gallons s sec second seconds min "
         "minute minutes h hour hours day days week weeks month months year years percent euro euros eur dollar dollars usd "
         "cent cents degree degrees meter meters metre metres kilometer kilometers kilometre kilometres kmh mph").split()

# The repeats are possessive: nothing follows that could fail, and the pattern engine goes through them without recursion.
_NUMBER = r"\p{N}+(?:[.,]\p{N}+)*+"
_CAPITAL = r"(?!(?:" + "|".join(PLAIN) + r")(?![\p{L}\p{M}]))\p{Lu}[\p{L}\p{M}]*"
_NAME = r"(?=\p{Lu})(?<![\p{L}\p{M}])" + _CAPITAL + "(?: (?=\\p{Lu})" + _CAPITAL + ")*+"
_UNIT = r"(?<=\x{e000} ?)(?:" + "|".join(UNITS) + r")(?![\p{L}\p{M}])"
_WORD = r"[\p{L}\p{M}]+|[\x{e000}-\x{e002}]"
_RAW = _NAME + r"|[\p{L}\p{M}]+|" + _NUMBER


def template_words(text: Column) -> Column:
    """The template of a text: one entry per word or number, placeholders where slots are."""
    t = F.regexp_replace(text, r"[\x{e000}-\x{e003}]", " ")
    t = F.regexp_replace(t, _NAME, "\ue001")
    t = F.lower(F.regexp_replace(t, _NUMBER, "\ue000"))
    t = F.regexp_replace(t, _UNIT, "\ue002")
    return F.regexp_extract_all(t, F.lit(_WORD), F.lit(0))


def raw_words(text: Column) -> Column:
    """The words, names and numbers of a text as they stand, place by place those of its template."""
    return F.regexp_extract_all(F.regexp_replace(text, r"[\x{e000}-\x{e003}]", " "), F.lit(_RAW), F.lit(0))


def _positions(rows: DataFrame, keep: list[str], position: str, lengths: list[int] = [], exact: bool = True) -> DataFrame:
    """(keep, position, exact, key) of the windows of the columns ``w`` and ``r``, and of those of some shorter lengths.

    Words stand beside those that follow them in shifted copies of the arrays, so that a window is a row of columns.
    """
    raw = exact or bool(lengths)
    shifted = [F.slice(c, k + 1, F.greatest(F.size(c), F.lit(1))) for c in ["w"] + ["r"] * raw for k in range(WINDOW)]
    source = rows.withColumn("r", F.coalesce("r", F.array().cast("array<string>"))) if raw else rows
    cells = source.select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias(position, "z")).select(
        *keep, position, *[F.col("z")[str(k)].alias(f"w{k}") for k in range(WINDOW)],
        *[F.col("z")[str(WINDOW + k)].alias(f"r{k}") for k in range(WINDOW * raw)])
    slots = sum(((F.col(f"w{k}") >= "\ue000").cast("int") for k in range(1, WINDOW)), (F.col("w0") >= "\ue000").cast("int"))
    as_it_stands = F.xxhash64(F.lit(WINDOW), *[f"r{k}" for k in range(WINDOW)]) if exact else F.lit(None).cast("long")
    full = cells.where(f"w{WINDOW - 1} IS NOT NULL").withColumn("exact", slots > WINDOW // 2).select(
        *keep, position, "exact", F.when(F.col("exact"), as_it_stands).otherwise(F.xxhash64(*[f"w{k}" for k in range(WINDOW)])).alias("key"))
    if not exact:
        full = full.where("key IS NOT NULL")
    for n in lengths:
        full = full.unionByName(cells.where(f"w{n - 1} IS NOT NULL").select(
            *keep, position, F.lit(True).alias("exact"), F.xxhash64(F.lit(n), *[f"r{k}" for k in range(n)]).alias("key")))
    return full


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, item_windows): the items that leak into each document.

    ``n_windows`` is that of the best consistent alignment, ``text_key`` the hash of the document's text. Both numbers are
    those of the template windows where these suffice, else of all windows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.struct(F.col(item_id).alias("id"), F.xxhash64(item_text).alias("key")).alias("item"),
                             template_words(F.col(item_text)).alias("w"), raw_words(F.col(item_text)).alias("r"))
    n_words = F.size("w")
    whole = items.where((n_words > 0) & (n_words < WINDOW))
    of_items = stored(_positions(items.where(n_words >= WINDOW), ["item"], "j").withColumn("n", F.lit(WINDOW)).unionByName(
        whole.select("item", F.lit(0).alias("j"), F.lit(True).alias("exact"), F.xxhash64(n_words, "r").alias("key"), n_words.alias("n")))
        .distinct(), "benchmark-windows")
    known = of_items.select("key", "item", "j", "exact")
    # At most ``WINDOW`` lengths.
    kinds = of_items.groupBy("exact", "n").agg(F.count("*").alias("rows")).collect()
    lengths, exact = sorted(x.n for x in kinds if x.n < WINDOW), any(x.exact and x.n == WINDOW for x in kinds)
    if sum(x.rows for x in kinds) <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    d = docs.select(F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("key")).alias("doc"), F.col(text).alias("text"))
    cut = d.select("doc", template_words(F.col("text")).alias("w"), "text").where(n_words >= min([*lengths, WINDOW]))
    # The values of a document only where an exact window can be.
    slotted = F.size(F.filter("w", lambda x: x >= "\ue000")) > WINDOW // 2
    values = raw_words(F.col("text")) if lengths else F.when(slotted, raw_words(F.col("text")))
    cut = cut.withColumn("r", values) if lengths or exact else cut
    hits = (_positions(cut, ["doc"], "i", lengths, exact).join(known, ["key", "exact"])
            .groupBy("doc", "item", (F.col("i") - F.col("j")).alias("diagonal"))
            .agg(F.collect_set(F.when(~F.col("exact"), F.col("j"))).alias("js"), F.collect_set("j").alias("all_js")))  # at most the windows of one item
    hits = stored(hits, "window-hits")
    sizes = of_items.groupBy("item").agg(F.count_distinct(F.when(~F.col("exact"), F.col("j"))).alias("item_windows"),
                                         F.count_distinct("j").alias("all_windows"))

    def reached(js, of):
        return (F.size(js) >= ENOUGH) | ((F.size(js) > 0) & (F.size(js) >= MIN_SHARE * F.col(of)))
    enough = (hits.join(sizes, "item").withColumn("template", reached("js", "item_windows"))
              .where(F.col("template") | reached("all_js", "all_windows"))
              .select("doc", "item", "diagonal", "template", F.when(F.col("template"), F.col("js")).otherwise(F.col("all_js")).alias("js"),
                      F.when(F.col("template"), F.col("item_windows")).otherwise(F.col("all_windows")).alias("item_windows")))
    # Slots of the matches only: template words that are placeholders, as the item and as the document have them.
    there = items.join(enough.select("item").distinct(), "item", "left_semi").dropDuplicates(["item"])
    texts = d.join(enough.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"]).select(
        "doc", raw_words(F.col("text")).alias("dr"))
    place = F.array_distinct(F.flatten(F.transform("js", lambda j: F.sequence(j, j + WINDOW - 1))))
    slots = F.transform(F.filter(place, lambda p: F.get("w", p) >= "\ue000"),
                        lambda p: F.struct(F.concat(F.get("w", p), F.get("r", p)).alias("v"),
                                           F.get("dr", p + F.col("diagonal")).alias("d")))
    slots = F.array_distinct(slots)
    joined = enough.join(there, "item").join(texts, "doc").withColumn("slots", slots)
    good = joined.where(F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["v"]))))
    best = F.max(F.struct("template", F.size("js").cast("long").alias("n"), "item_windows"))
    return (good.groupBy("doc", "item").agg(best.alias("best"))
            .select(F.col("doc.id").alias("doc_id"), F.col("doc.key").alias("text_key"), F.col("item.id").alias("item_id"),
                    F.col("best.n").alias("n_windows"), F.col("best.item_windows").alias("item_windows")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the documents that an item leaks into."""
    i, k = free_name(docs, "_leak_id"), free_name(docs, "_leak_key")
    found = leaks(docs, benchmark, doc_id, text, item_id, item_text).select(F.col("doc_id").alias(i), F.col("text_key").alias(k)).distinct()
    return docs.join(found, F.col(doc_id).eqNullSafe(F.col(i)) & (F.xxhash64(text) == F.col(k)), "left_anti")


def op3_decontamination(spark, folder):
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "item_id", "n_windows", "item_windows")


_NAME_SQL = r"\p{Lu}[\p{L}\p{M}]*(?: \p{Lu}[\p{L}\p{M}]*)*"
#: Marks the plain words; twice, because a match takes the place between two of them.
_PLAIN_SQL = ("regexp_replace({}, '(^|[^\\p{{L}}\\p{{M}}\\x{{e003}}])(" + "|".join(PLAIN) + ")([^\\p{{L}}\\p{{M}}]|$)', '\\1\ue003\\2\\3', 'g')")
SQL = f"""
WITH texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION SELECT 'b', item_id, text FROM benchmark),
cleaned AS (SELECT side, id, text, {_PLAIN_SQL.format(_PLAIN_SQL.format("regexp_replace(text, '[\\x{e000}-\\x{e003}]', ' ', 'g')"))} AS c FROM texts),
named AS (SELECT *, regexp_replace(c, '(^|[^\\p{{L}}\\p{{M}}\\x{{e003}}]){_NAME_SQL}', '\\1\ue001', 'g') AS t FROM cleaned),
numbered AS (SELECT *, lower(regexp_replace(t, '\\p{{N}}+(?:[.,]\\p{{N}}+)*', '\ue000', 'g')) AS u FROM named),
words AS (SELECT side, id, text,
    regexp_extract_all(regexp_replace(u || ' ', '(\ue000 ?)({"|".join(UNITS)})([^\\p{{L}}\\p{{M}}])', '\\1\ue002\\3', 'g'),
                       '[\\p{{L}}\\p{{M}}]+|[\\x{{e000}}-\\x{{e002}}]') AS w,
    regexp_extract_all(c, '\\x{{e003}}[\\p{{L}}\\p{{M}}]+|{_NAME_SQL}|[\\p{{L}}\\p{{M}}]+|\\p{{N}}+(?:[.,]\\p{{N}}+)*') AS r FROM numbered),
spots AS (SELECT side, id, text, unnest(range(len(w) - {WINDOW} + 1)) AS i, w FROM words WHERE len(w) >= {WINDOW}),
win AS (SELECT side, id, text, i, array_to_string(w[i + 1 : i + {WINDOW}], ' ') AS k FROM spots
        WHERE len(list_filter(w[i + 1 : i + {WINDOW}], lambda x: x >= '\ue000')) <= {WINDOW // 2}),
sizes AS (SELECT id, text, count(*) AS item_windows FROM win WHERE side = 'b' GROUP BY ALL),
hits AS (SELECT d.id AS doc_id, d.text AS dt, b.id AS item_id, b.text AS bt, d.i - b.i AS diagonal, list(DISTINCT b.i) AS js
         FROM win d JOIN win b ON d.side = 'd' AND b.side = 'b' AND d.k = b.k GROUP BY ALL),
enough AS (SELECT h.*, item_windows FROM hits h JOIN sizes s ON h.item_id = s.id AND h.bt = s.text
           WHERE len(js) >= {ENOUGH} OR len(js) >= {MIN_SHARE} * item_windows),
places AS (SELECT DISTINCT e.doc_id, dt, e.item_id, bt, diagonal, j + o AS p
           FROM (SELECT *, unnest(js) AS j FROM enough) e, range({WINDOW}) r(o)),
slots AS (SELECT p.doc_id, dt, item_id, bt, diagonal, count(DISTINCT b.w[p + 1] || b.r[p + 1]) AS given,
                 count(DISTINCT b.w[p + 1] || b.r[p + 1] || chr(10) || d.r[p + diagonal + 1]) AS pairs
          FROM places p JOIN words b ON b.side = 'b' AND b.id = item_id AND b.text = bt
          JOIN words d ON d.side = 'd' AND d.id = p.doc_id AND d.text = dt WHERE b.w[p + 1] >= '\ue000' GROUP BY ALL)
SELECT e.doc_id, e.item_id, max(len(js))::BIGINT AS n_windows, any_value(item_windows) AS item_windows
FROM enough e LEFT JOIN slots s USING (doc_id, dt, item_id, bt, diagonal)
WHERE s.given IS NULL OR s.given = s.pairs GROUP BY e.doc_id, e.dt, e.item_id, e.bt"""
