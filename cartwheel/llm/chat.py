"""Chat logs: cumulative snapshots collapsed to maximal conversations, then rendered.

A logger that saves a conversation after every turn leaves snapshots that are prefixes of a
longer one.  A conversation is its set of turns (turn number, role, text, copies).  Each turn has a
128-bit hash; the hash of a prefix is the XOR of its turns' hashes, so whole conversations come from
one aggregate with map-side combining and prefixes from a running XOR in blocks of turns: a
conversation of any length is summed in parts.  Conversations whose hash is a proper prefix hash of
another are removed by an anti-join; of equal conversations the smallest id stays.

The result has one row per turn of the kept conversations, ``rendered`` ready to be joined in turn
order, so a conversation of any length is never gathered in one cell.

Defined cases: rows with a null conversation id are dropped from the log (they belong to none); null
turns come first; null role or text render as empty, and differ from empty ones in comparison; exact
copies of a turn count as copies and render once each; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256


def _hash(salt: int) -> Column:
    null = [F.col(c).isNull() for c in ("turn", "role", "text")]
    return F.xxhash64(F.lit(salt), "turn", "role", "text", "copies", *null)


def maximal_turns(log: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns (conv_id, turn, role, text, copies) of the conversations that prefix no other."""
    rows = log.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    rows = rows.where("conv_id IS NOT NULL").groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    at = F.coalesce("turn", F.lit(-(2**62))).alias("at")
    turns = rows.select("conv_id", at, _hash(1).alias("a"), _hash(2).alias("b"), "copies")
    # One row per turn number: its rows stand or fall together.
    steps = turns.groupBy("conv_id", "at").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("copies").alias("n"))
    steps = steps.withColumn("block", F.floor(F.col("at") / BLOCK))
    blocks = steps.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    whole = steps.groupBy("conv_id").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("n").alias("n"))
    before = blocks.select(
        "conv_id", "block", *(F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in "ab"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0")
    )
    inside = steps.select("conv_id", "block", *(F.bit_xor(c).over(upto).alias(f"{c}1") for c in "ab"), F.sum("n").over(upto).alias("n1"))
    prefixes = inside.join(before, ["conv_id", "block"]).select(
        "conv_id", F.expr("a0 ^ a1").alias("a"), F.expr("b0 ^ b1").alias("b"), F.expr("n0 + n1").alias("n")
    )
    sizes = whole.select("conv_id", F.col("n").alias("total"))
    proper = prefixes.join(sizes, "conv_id").where("n < total").select("a", "b", "n").distinct()
    one = whole.groupBy("a", "b", "n").agg(F.min("conv_id").alias("conv_id"))
    kept = one.join(proper, ["a", "b", "n"], "left_anti").select("conv_id")
    return rows.join(kept, "conv_id", "left_semi")


def rendered_turns(log: DataFrame, start: str = "<|im_start|>", end: str = "<|im_end|>", **columns: str) -> DataFrame:
    """conv_id, turn, copies and ``rendered`` (one chat-template turn, repeated for copies)."""
    one = F.concat(F.lit(start), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(f"{end}\n"))
    return maximal_turns(log, **columns).select("conv_id", "turn", "copies", F.repeat(one, F.col("copies").cast("int")).alias("rendered"))
