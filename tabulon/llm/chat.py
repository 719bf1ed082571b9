"""Multi-party perspective rotation of conversations.

Every participant of a conversation gets a rendering of it in which that participant speaks as the assistant and all
others as named users. The mask of a rendering is the list of character spans of the assistant's own contents.

A segment is ``<|assistant|>``, ``<|user:NAME|>`` or ``<|system|>``, a line feed, the text, ``<|end|>`` and a line feed;
a span covers the text and its end mark. Within texts and names ``<|`` is written ``< |``, so that no text can forge a
header. The role ``system`` is no participant and stays as it is.

Turns follow ``turn`` (nulls last), equal ones md5(text), role. Defined cases: a null role is the speaker ``unknown``; a
null text is empty; repeated rows are one turn; null conversation ids form one conversation; a conversation of system
turns only has no rendering; an empty table gives none. A rendering is cut into pieces of ``PIECE`` turns (``piece``
counts from 0, offsets start anew in each), so that no conversation has to fit one task. Other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulon.llm.common import table

PIECE = 1024
HEAD, END = "<|assistant|>\n", "<|end|>\n"


def _plain(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, speaker, text, position): distinct turns with their place in the conversation, from 0.

    Places are sums of three levels: turns of a block of 1,024 turn numbers, units within a block, rows within a unit
    (turn and first three hex digits of the text's hash). No window holds a whole conversation's rows.
    """
    t = turns.select(F.col(conv).alias("conv"), F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("ck"),
                     F.col(turn).isNull().alias("tn"), F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("tv"),
                     F.coalesce(F.col(role), F.lit("unknown")).alias("speaker"),
                     F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    t = (t.withColumn("hash", F.md5("text")).withColumn("unit", F.substring("hash", 1, 3))
         .withColumn("block", F.floor(F.col("tv") / 1024)))
    units = t.groupBy("ck", "tn", "block", "tv", "unit").agg(F.count("*").alias("n"))
    blocks = units.groupBy("ck", "tn", "block").agg(F.sum("n").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    units = units.select("ck", "tn", "block", "tv", "unit",
                         before(Window.partitionBy("ck", "tn", "block").orderBy("tv", "unit")).alias("in_block"))
    blocks = blocks.select("ck", "tn", "block", before(Window.partitionBy("ck").orderBy("tn", "block")).alias("in_conv"))
    units = units.join(blocks, ["ck", "tn", "block"]).select("ck", "tn", "tv", "unit", (F.col("in_block") + F.col("in_conv")).alias("base"))
    inside = F.row_number().over(Window.partitionBy("ck", "tn", "tv", "unit").orderBy("hash", "speaker", "text")) - 1
    return (t.withColumn("inside", inside).join(units, ["ck", "tn", "tv", "unit"])
            .select("ck", "conv", "speaker", "text", (F.col("base") + F.col("inside")).cast("long").alias("position")))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, perspective, piece, n_turns, dialogue, spans): one rendering per participant; spans are "start-end"
    character offsets, joined by commas."""
    t = numbered(turns, conv, turn, role, text).withColumn("piece", F.floor(F.col("position") / PIECE))
    people = t.where("speaker <> 'system'").select("ck", F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    head = (F.when(F.col("speaker") == "system", F.lit("<|system|>\n")).when(own, F.lit(HEAD))
            .otherwise(F.concat(F.lit("<|user:"), _plain(F.col("speaker")), F.lit("|>\n"))))
    segments = t.join(people, "ck").select(
        "ck", "conv", "perspective", "piece",
        F.struct("position", own.alias("own"), F.concat(head, _plain(F.col("text")), F.lit(END)).alias("segment")).alias("s"))
    pieces = (segments.groupBy("ck", "perspective", "piece")
              .agg(F.first("conv").alias("conv_id"), F.sort_array(F.collect_list("s")).alias("s")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a, x):
        end = a["at"] + F.length(x["segment"])
        span = F.concat_ws("-", (a["at"] + len(HEAD)).cast("string"), (end - 1).cast("string"))
        return F.struct(end.cast("long").alias("at"), F.when(x["own"], F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    return pieces.select("conv_id", "perspective", F.col("piece").cast("long").alias("piece"), F.size("s").cast("long").alias("n_turns"),
                         F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("dialogue"),
                         F.aggregate("s", start, step, lambda a: F.array_join(a["out"], ",")).alias("spans"))


def op2_chat_rotation(spark, folder):
    return rotate(table(spark, folder, "conversations"))


SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, md5(text), speaker, text) - 1 AS position FROM t),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
s AS (SELECT n.conv_id, perspective, position, position // {PIECE} AS piece, speaker = perspective AS own,
        CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = perspective THEN '<|assistant|>'
             ELSE '<|user:' || replace(speaker, '<|', '< |') || '|>' END || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10) AS segment
      FROM n JOIN people p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective, piece ORDER BY position) AS upto FROM s)
SELECT conv_id, perspective, piece::BIGINT AS piece, count(*) AS n_turns, string_agg(segment, '' ORDER BY position) AS dialogue,
       string_agg((upto - length(segment) + {len(HEAD)})::BIGINT || '-' || (upto - 1)::BIGINT, ',' ORDER BY position) FILTER (own) AS spans
FROM o GROUP BY conv_id, perspective, piece"""
