"""Chat formatting: collapse logged snapshots of conversations, then render the maximal ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: Turns in one piece of the work and in one rendered part.
PIECE = 1024


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(
        F.lit(seed), F.col("position"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")
    )


def prefixes(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """Turns with their position, the conversation's length and rolling hashes of the prefix they end.

    Input: conv_id, turn, role, text. Turns are in the order (turn, role, text), nulls first; equal rows
    are separate turns, a null conv_id is a conversation. The prefix hash is the running XOR of hashes
    of (position, role, text), in two 64-bit lanes; positions run from 1 without gaps, so equal hashes
    of equal length mean equal prefixes. XOR can be summed in pieces: a conversation is cut into pieces
    of ``piece`` turn numbers and small tables of piece totals carry counts and hashes over, so a
    conversation with a large share of all rows is worked on in many tasks.
    """
    turns = conversations.select(
        "conv_id", "turn", "role", "text", F.coalesce(F.floor(F.col("turn") / piece), F.lit(-(1 << 62))).cast("long").alias("piece"),
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
    )
    by_piece = Window.partitionBy("conv").orderBy("piece")
    earlier = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        turns.groupBy("conv", "piece")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("n_turns", F.sum("_n").over(Window.partitionBy("conv")))
        .drop("_n")
    )
    within = Window.partitionBy("conv", "piece").orderBy("turn", "role", "text")
    placed = (
        turns.withColumn("_local", F.row_number().over(within))
        .join(counts, ["conv", "piece"])
        .withColumn("position", (F.col("_before") + F.col("_local")).cast("long"))
        .drop("_before", "_local")
        .withColumns({"_h1": _turn_hash(1), "_h2": _turn_hash(2)})
    )
    carried = (
        placed.groupBy("conv", "piece")
        .agg(F.bit_xor("_h1").alias("_t1"), F.bit_xor("_h2").alias("_t2"))
        .select(
            "conv", "piece", F.coalesce(F.bit_xor("_t1").over(earlier), F.lit(0)).alias("_c1"), F.coalesce(F.bit_xor("_t2").over(earlier), F.lit(0)).alias("_c2")
        )
    )
    running = Window.partitionBy("conv", "piece").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({"_r1": F.bit_xor("_h1").over(running), "_r2": F.bit_xor("_h2").over(running)})
        .join(carried, ["conv", "piece"])
        .withColumns({"prefix_1": F.col("_r1").bitwiseXOR(F.col("_c1")), "prefix_2": F.col("_r2").bitwiseXOR(F.col("_c2"))})
        .select("conv", "conv_id", "turn", "role", "text", "position", "n_turns", "prefix_1", "prefix_2")
    )


def maximal(hashed: DataFrame) -> DataFrame:
    """Conversations that are no prefix of another: conv, n_turns, n_logged.

    Of equal conversations the one with the smallest conv_id stays (a null only where there is no other);
    ``n_logged`` is their number. Equal ends and equal inner prefixes are each reduced to one row per hash before
    the anti-join, so a first turn that most conversations share is a single row there.
    """
    key = ["position", "prefix_1", "prefix_2"]
    ends = (
        hashed.filter("position = n_turns")
        .groupBy(*key)
        .agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id", "conv")).alias("_first"), F.count("*").alias("n_logged"))
    )
    inner = hashed.filter("position < n_turns").select(*key).distinct()
    return ends.join(inner, key, "left_anti").select(F.col("_first.conv").alias("conv"), F.col("position").alias("n_turns"), "n_logged")


def rendered_turn() -> Column:
    """One turn in chat markup; a marker inside a text is broken up so that it can't end the turn."""
    safe = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("< |"))
    role = F.replace(F.coalesce(F.col("role"), F.lit("unknown")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), safe, F.lit("<|im_end|>\n"))


def chat_documents(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """Rendered maximal conversations: conv_id, part, n_turns, n_logged, text.

    A conversation of up to ``piece`` turns is one row with part 0; longer ones go on in further parts, which
    joined in order are the whole text. Null text renders as empty, null role as ``unknown``. Empty
    input, empty result.
    A very long text is a value of one row; a conversation of many turns is rendered in parts. Other columns are not read, whatever their names.
    """
    hashed = stored(prefixes(conversations, piece), "prefixes")
    kept = maximal(hashed).withColumnRenamed("conv", "_conv").drop("n_turns")
    return (
        hashed.join(kept, F.col("conv") == F.col("_conv"))
        .withColumn("part", F.floor((F.col("position") - 1) / piece).cast("long"))
        .groupBy("conv", "conv_id", "part", "n_turns", "n_logged")
        .agg(F.sort_array(F.collect_list(F.struct("position", rendered_turn().alias("t")))).alias("_turns"))
        .select("conv_id", "part", "n_turns", "n_logged", F.array_join(F.col("_turns.t"), "").alias("text"))
    )
