"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold one conversation many times, each time a few turns
longer.  Every turn gets the hash of all turns up to it; a conversation whose
last hash is an inner hash of another one is a snapshot of it and goes, and of
equal conversations one stays.  What remains is rendered.

Prefix hashes are running XORs of hashes that bind each turn to its place, so
they are summed in two levels (blocks of turns, then the blocks before): no
window holds more than a block of one conversation's turns, or one row per
block of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import ranked, written

BLOCK_TURNS = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _position(turns: DataFrame) -> DataFrame:
    """Distinct turns with ``pos``, their 0-based place in the conversation
    (by turn number, NULL last, then role and text).

    Places come from range partitions, so rows without conversation or turn
    number, however many, are no group of one task.
    """
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Repeated rows become one; NULL ids and turn numbers get values that sort.
    known = t.groupBy("conv_id", "turn", "role", "text").agg(F.lit(1).alias("_")).select(
        F.col("conv_id").isNull().alias("no_id"), F.coalesce("conv_id", F.lit(0)).alias("id"),
        F.col("turn").isNull().alias("no_turn"), "turn", "role", "text")
    one = written(known, "chat-turns")
    placed = ranked(one, ["no_id", "id"], ["no_turn", "turn", "role", "text"], "chat-order")
    return placed.select(F.when(~F.col("no_id"), F.col("id")).alias("conv_id"), "role", "text",
                         F.col("place").alias("pos"))


def prefix_hashes(turns: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """``(conv_id, pos, role, text, part, h1, h2)``: per turn the 128-bit hash
    of the conversation up to and including it, and its block ``part``."""
    placed = written(_position(turns).withColumn("part", F.floor(F.col("pos") / block)), "chat-placed")
    own = [F.xxhash64("pos", "role", "text"), F.xxhash64(F.lit(1), "text", "role", "pos")]
    blocks = placed.groupBy("conv_id", "part").agg(*(F.bit_xor(h).alias(f"x{i}") for i, h in enumerate(own)))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(blocks.select(F.col("conv_id").alias("c"), F.col("part").alias("b"), *(
        F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0).cast("long")).alias(f"y{i}") for i in range(2))),
        "chat-blocks")
    upto = Window.partitionBy("conv_id", "part").orderBy("pos")
    rows = placed.select("*", *(F.bit_xor(h).over(upto).alias(f"x{i}") for i, h in enumerate(own)))
    joined = rows.join(bases, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("b")))
    return joined.select("conv_id", "pos", "role", "text", "part",
                         F.col("x0").bitwiseXOR(F.col("y0")).alias("h1"),
                         F.col("x1").bitwiseXOR(F.col("y1")).alias("h2"))


def maximal_conversations(hashes: DataFrame) -> DataFrame:
    """``(conv_id, n_turns)`` of conversations that are no prefix of a longer
    one; of equal ones the smallest conv_id (NULL last).

    Inner hashes are made distinct, and equal conversations folded to one,
    before the exchange of the anti-join, so a turn or a whole conversation
    that a third of all share is one row per task.
    """
    last = written(hashes.groupBy("conv_id").agg(F.max_by(F.struct("pos", "h1", "h2"), "pos").alias("e"))
                   .select("conv_id", "e.*"), "chat-last")
    inner = (hashes.join(last.select(F.col("conv_id").alias("c"), F.col("pos").alias("end")),
                         F.col("conv_id").eqNullSafe(F.col("c")))
             .filter("pos < end").select("pos", "h1", "h2").distinct())
    first = last.groupBy("pos", "h1", "h2").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), "conv_id"))["conv_id"].alias("conv_id"))
    top = first.join(inner, ["pos", "h1", "h2"], "left_anti")
    return top.select("conv_id", (F.col("pos") + 1).cast("long").alias("n_turns"))


def render_turn(role: Column, text: Column) -> Column:
    """A turn in the chat template; marks inside the text are broken up so
    that they cannot end or open a turn."""
    safe = lambda c: F.replace(c, F.lit("<|im_"), F.lit("<| im_"))
    return F.concat(F.lit(OPEN), safe(role), F.lit("\n"), safe(text), F.lit(f"{CLOSE}\n"))


def format_chats(turns: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """Maximal conversations, rendered.

    One row per conversation and ``part`` of ``block`` turns (nearly always
    one part): ``conv_id, n_turns, part, n_parts, rendered``; the texts of
    the parts, in order, are the conversation.  A NULL role counts as
    ``user``, a NULL text as empty, a NULL turn number comes last, rows with
    NULL conv_id are one conversation; repeated rows count once; rows of one
    turn number are ordered by role and text; extra columns are ignored; an
    empty table gives no rows.
    """
    hashes = written(prefix_hashes(turns, block), "chat-hashes")
    top = written(maximal_conversations(hashes), "chat-top")
    kept = hashes.join(top.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
    parts = kept.groupBy("conv_id", "n_turns", "part").agg(
        F.sort_array(F.collect_list(F.struct("pos", render_turn(F.col("role"), F.col("text")).alias("t")))).alias("ts"))
    return parts.select("conv_id", "n_turns", F.col("part").cast("long").alias("part"),
                        F.ceil(F.col("n_turns") / block).cast("long").alias("n_parts"),
                        F.array_join("ts.t", "").alias("rendered"))
