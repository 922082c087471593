"""Collapse of cumulative conversation snapshots, and chat rendering.

A chat log often holds a conversation several times, each time a few turns
longer. Every turn gets a hash of all turns up to it; a conversation whose last
such hash is that of a turn of a longer conversation is a prefix of it. An
anti-join keeps the conversations that are no one's prefix, and their turns are
rendered.

Only DataFrame functions. The prefix hash is a running sum of hashes of
(position, role, text), modulo 2 ** 61 - 1 by two independent hashes, so it
needs no list of turns: a long conversation is cut into chunks of its turn
numbers, chunks are counted and summed in parallel, and what the chunks before
add up to is added to each turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import written

CHUNK = 1024  # turn numbers in a chunk
MODULUS = (1 << 61) - 1


def positions(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, position``: places from 0 by turn (nulls first), role and text.

    Rows without a ``conv_id`` are left out: they belong to no conversation.
    Equal rows each have a place of their own.
    """
    rows = turns.where("conv_id is not null").select("conv_id", "turn", "role", "text")
    rows = rows.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62))))
    in_order = Window.partitionBy("conv_id").orderBy("chunk")
    before = (
        rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
        .select("conv_id", "chunk", (F.sum("n").over(in_order) - F.col("n")).alias("before"))
    )
    here = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    placed = rows.withColumn("here", F.row_number().over(here) - 1).join(before, ["conv_id", "chunk"])
    return placed.select("conv_id", "turn", "role", "text", (F.col("before") + F.col("here")).alias("position"))


def _digest(seed: int) -> Column:
    # A null role or text differs from an empty one: its marker is hashed with it.
    parts = [F.lit(seed), F.col("position")]
    for c in ("role", "text"):
        parts += [F.col(c).isNull(), F.coalesce(F.col(c), F.lit(""))]
    return F.pmod(F.xxhash64(*parts), F.lit(MODULUS)).cast("decimal(38,0)")


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """``placed`` with ``prefix``: a hash of the turns up to and with this one, as two numbers."""
    rows = placed.withColumns({"chunk": F.floor(F.col("position") / CHUNK), "x": _digest(1), "y": _digest(2)})
    in_order = Window.partitionBy("conv_id").orderBy("chunk")
    before = rows.groupBy("conv_id", "chunk").agg(F.sum("x").alias("sx"), F.sum("y").alias("sy"))
    before = before.select(
        "conv_id", "chunk", (F.sum("sx").over(in_order) - F.col("sx")).alias("bx"), (F.sum("sy").over(in_order) - F.col("sy")).alias("by")
    )
    here = Window.partitionBy("conv_id", "chunk").orderBy("position")
    summed = rows.withColumns({"x": F.sum("x").over(here), "y": F.sum("y").over(here)}).join(before, ["conv_id", "chunk"])
    total = lambda own, earlier: F.pmod(F.col(own) + F.col(earlier), F.lit(MODULUS)).cast("long")
    return summed.withColumn("prefix", F.struct(total("x", "bx").alias("x"), total("y", "by").alias("y"))).drop(
        "chunk", "x", "y", "bx", "by"
    )


def maximal(turns: DataFrame) -> DataFrame:
    """Turns, with their positions, of the conversations that are no prefix of another.

    Of equal conversations the one with the smallest ``conv_id`` stays.
    """
    placed = written(positions(turns), "chat-positions")
    hashed = written(prefix_hashes(placed).select("conv_id", "position", "prefix"), "chat-prefixes")
    ends = hashed.groupBy("conv_id").agg(F.max_by("prefix", "position").alias("prefix"), F.max("position").alias("position"))
    # For a length and a hash: whether a conversation goes on from there, and the smallest that ends there.
    longer = hashed.join(ends.select("conv_id", F.col("position").alias("last")), "conv_id").where("position < last")
    longer = longer.select("prefix", "position").distinct()
    kept = ends.join(longer, ["prefix", "position"], "left_anti").groupBy("prefix", "position").agg(F.min("conv_id").alias("conv_id"))
    return placed.join(kept.select("conv_id", (F.col("position") + 1).alias("n_turns")), "conv_id")


def rendered(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, position, role, rendered`` of the maximal conversations, a row per turn.

    A turn reads ``<|role|>``, its text and ``<|end|>``, on lines of their
    own; concatenated by position they are the conversation. A null role is
    ``unknown``, a null text is empty. Other columns are not read.
    """
    role = F.coalesce("role", F.lit("unknown"))
    text = F.concat(F.lit("<|"), role, F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    return maximal(turns).select("conv_id", "n_turns", "position", role.alias("role"), text.alias("rendered"))
