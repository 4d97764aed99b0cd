"""Chat formatting with cumulative-snapshot collapse.

A conversation logged again at every turn leaves its own prefixes in the log.
Each turn is hashed with its place; the exclusive-or of the hashes up to a turn
is the hash of that prefix, so prefixes roll along a conversation by a window
sum and need no text. A conversation whose whole hash occurs as a proper prefix
of another one is dropped by an anti-join; equal conversations keep the
smallest conv_id. The maximal ones are then rendered.

No group is gathered whole: turns are folded per (conversation, turn) before
the shuffle, rolled within segments of ``SEGMENT`` turn numbers with a second
roll over the segments, and rendered one row per segment, or per part of
``SEGMENT`` rows where turn numbers repeat in a segment.

Edge cases: turns are ordered by (turn, role, text), nulls first; two turns
with the same number belong to the same prefix step; a turn row repeated in a
conversation counts as often as it occurs; a null role renders as ``unknown``
and a null text as nothing, though both differ from the empty string in the
hashes; a null conv_id is a conversation of its own; an empty table gives no
rows; a very long text is rendered whole, in its one row; only the named columns
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SEGMENT = 512


def _turn_hash(salt: int) -> Column:
    role, text = F.col("role"), F.col("text")
    return F.xxhash64(F.lit(salt), "turn", F.col("turn").isNull(), role, role.isNull(), text, text.isNull())


def _segment() -> Column:
    return F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-(1 << 62))).cast("long")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, turn and the hash (two 64-bit halves) and row count of the
    prefix that ends there, for every turn number of every conversation."""
    rows = turns.select("conv_id", "turn", _turn_hash(1).alias("a"), _turn_hash(2).alias("b"))
    rows = rows.groupBy("conv_id", "turn", "a", "b").agg(F.count("*").alias("m"))
    steps = rows.groupBy("conv_id", "turn").agg(
        F.bit_xor(F.xxhash64("a", "m")).alias("a"), F.bit_xor(F.xxhash64("b", "m")).alias("b"), F.sum("m").alias("n"))
    steps = steps.withColumn("segment", _segment())
    before = W.partitionBy("conv_id").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    carried = steps.groupBy("conv_id", "segment").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    carried = carried.select(
        F.col("conv_id").alias("k"), F.col("segment").alias("s"),
        F.coalesce(F.bit_xor("a").over(before), zero).alias("a0"), F.coalesce(F.bit_xor("b").over(before), zero).alias("b0"),
        F.coalesce(F.sum("n").over(before), zero).alias("n0"))
    steps = steps.join(carried, F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("segment") == F.col("s")))
    up_to = W.partitionBy("conv_id", "segment").orderBy(F.col("turn").asc_nulls_first())
    return steps.select(
        "conv_id", "turn", F.bit_xor("a").over(up_to).bitwiseXOR(F.col("a0")).alias("a"),
        F.bit_xor("b").over(up_to).bitwiseXOR(F.col("b0")).alias("b"), (F.sum("n").over(up_to) + F.col("n0")).alias("n"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and copies (conversations equal to it, itself included)
    of the conversations that no other one continues."""
    rolled = prefixes(turns)
    ends = rolled.groupBy("conv_id").agg(F.max_by(F.struct("turn", "a", "b", "n"), "n").alias("e"))
    whole = ends.groupBy("e.a", "e.b", "e.n").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    # A prefix is proper where its conversation goes on.
    going_on = (rolled.join(ends.select(F.col("conv_id").alias("k"), F.col("e.n").alias("whole_n")),
                            F.col("conv_id").eqNullSafe(F.col("k")))
                .where(F.col("n") < F.col("whole_n")).select("a", "b", "n").distinct())
    return whole.join(going_on, ["a", "b", "n"], "left_anti").select(
        "conv_id", F.col("n").alias("n_turns"), "copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """Every kept conversation, a row per segment (512 turn numbers) and part
    of it (512 rows): conv_id, segment, part (from 0), n_turns (of the
    conversation), copies and the text."""
    own = turns.select("conv_id", "turn", "role", "text", _segment().alias("segment"))
    kept = kept.withColumnRenamed("conv_id", "k")
    own = own.join(kept, F.col("conv_id").eqNullSafe(F.col("k"))).drop("k")
    # Ties are equal rows, so any order of them renders the same.
    place = F.row_number().over(W.partitionBy("conv_id", "segment").orderBy("turn", "role", "text"))
    own = own.withColumn("part", F.floor((place - 1) / SEGMENT).cast("long"))
    said = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"),
                    F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    return (own.groupBy("conv_id", "segment", "part", "n_turns", "copies")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", said.alias("said")))).alias("t"))
            .select("conv_id", "segment", "part", "n_turns", "copies",
                    F.array_join(F.transform("t", lambda t: t["said"]), "").alias("rendered")))


def format_chats(turns: DataFrame) -> DataFrame:
    return render(turns, maximal(turns))


SQL = r"""
WITH t AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role, text) AS ts,
         CAST(count(*) AS BIGINT) AS n_turns FROM conversations GROUP BY 1),
c AS (SELECT min(conv_id) AS conv_id, ts, n_turns, count(*) AS copies FROM t GROUP BY ts, n_turns),
m AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT ts[1:k] AS p FROM (SELECT ts, unnest(range(1, n_turns)) AS k FROM c)) q WHERE q.p = c.ts))
SELECT conv_id, segment, part, n_turns, copies,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10),
                  '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rendered
FROM (
  SELECT conv_id, segment, turn, role, text,
         (row_number() OVER (PARTITION BY conv_id, segment
                             ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1) // 512 AS part
  FROM (SELECT *, CAST(floor(turn / 512) AS BIGINT) AS segment FROM conversations))
JOIN (SELECT conv_id, n_turns, copies FROM m) USING (conv_id)
GROUP BY ALL
"""
