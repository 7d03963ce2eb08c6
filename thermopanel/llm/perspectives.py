"""Chat formatting: multi-party perspective rotation.

For every participant of a conversation, the dialogue is rendered with that speaker as the assistant and the others
as named users. A turn becomes ``<|role|>`` or ``<|role|name=...|>``, a new line, its text and ``<|end|>``; the
mask covers the text and end mark of the speaker's own turns, nothing else. System turns belong to no one:
they are rendered as system and take no perspective. Offsets are code points of the whole rendering of
one perspective, so the rows joined in order of ``position`` are the training text and ``mask_start`` to
``mask_end`` are what the loss sees.

The result has a row for each (conversation, perspective, turn) and stays that wide, so that a conversation with
very many turns is not gathered into one value. Offsets are running sums: a conversation is cut into chunks of its
turns by a hash of none but the turn number, each chunk is summed alone, and the chunks' totals are
added up, which are few. Built-in functions only.

Defined cases: a null role counts as the name ``unknown``, a null text as empty; null conversations are one
conversation of their own; turns with equal numbers are ordered by role and text, repeated rows stay;
a conversation with system turns alone gives no rows; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Turns in a chunk.
CHUNK = 512
SYSTEM = "system"


def _prepared(turns: DataFrame) -> DataFrame:
    return turns.select(
        F.col("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("chunk", F.floor(F.col("turn") / CHUNK))


def participants(turns: DataFrame) -> DataFrame:
    """conv_id, perspective: the speakers of each conversation."""
    return turns.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()


def _header(role: Column, speaker: Column) -> Column:
    named = F.concat(F.lit("<|user|name="), speaker, F.lit("|>\n"))
    return F.when(role == "user", named).otherwise(F.concat(F.lit("<|"), role, F.lit("|>\n")))


def rotate(conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, position, turn, speaker, role, rendered, start, end, mask_start, mask_end."""
    turns = _prepared(conversations)
    people = participants(turns).withColumnRenamed("conv_id", "c")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user")
    rows = (
        turns.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c").withColumn("role", role)
        .withColumn("header", _header(F.col("role"), F.col("speaker")))
        .withColumn("rendered", F.concat("header", "text", F.lit("<|end|>\n")))
        .withColumn("length", F.length("rendered").cast("long"))
    )
    key = ["conv_id", "perspective", "chunk"]
    order = Window.partitionBy(*key).orderBy("turn", "speaker", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy(*key).agg(F.sum("length").alias("total"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = chunks.select(
        F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("chunk").alias("k"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    placed = rows.withColumn("within", F.coalesce(F.sum("length").over(before), F.lit(0))).withColumn(
        "place", F.row_number().over(order) - 1)
    start = F.col("base") + F.col("within")
    own = F.col("role") == "assistant"
    return (
        placed.join(bases, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & F.col("chunk").eqNullSafe(F.col("k")))
        .select(
            "conv_id", "perspective", (F.col("first") + F.col("place")).alias("position"), "turn", "speaker", "role", "rendered",
            start.alias("start"), (start + F.col("length")).alias("end"),
            F.when(own, start + F.length("header")).alias("mask_start"),
            # the new line after the end mark is not learned
            F.when(own, start + F.col("length") - 1).alias("mask_end"),
        )
    )


ROTATE_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(CAST(turn AS BIGINT), -1) AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> '{SYSTEM}'
), named AS (
  SELECT t.*, perspective,
    CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), headed AS (
  SELECT *, CASE WHEN role = 'user' THEN '<|user|name=' || speaker || '|>' ELSE '<|' || role || '|>' END || chr(10) AS header
  FROM named
), shown AS (
  SELECT *, header || text || '<|end|>' || chr(10) AS rendered FROM headed
), placed AS (
  SELECT *, row_number() OVER w - 1 AS position, CAST(sum(length(rendered)) OVER w - length(rendered) AS BIGINT) AS start
  FROM shown WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn, speaker, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, perspective, position, turn, speaker, role, rendered, start, start + length(rendered) AS "end",
  CASE WHEN role = 'assistant' THEN start + length(header) END AS mask_start,
  CASE WHEN role = 'assistant' THEN start + length(rendered) - 1 END AS mask_end
FROM placed
"""
