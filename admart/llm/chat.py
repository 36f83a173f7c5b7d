"""Chat formatting after cumulative-snapshot collapse, in DataFrame functions only.

A chat log often holds a conversation again and again as it grows. Each turn gets the rolling hash of the
turns up to it (two 64-bit hashes, xor-ed turn by turn with the turn's place); a conversation whose hash is
that of a proper prefix of another one is dropped by an anti-join, equal ones leave the smallest conv_id, and
what remains is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def maximal_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(numbered turns: conv_id, n, role, text; maximal conversations: conv_id, n_turns, n_copies).

    Turns stand by turn, role and text (nulls first); exact repetitions of a row count once. Rows with a
    null conv_id are one conversation. Null and empty texts differ from each other as turns.
    """
    logged = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).distinct()
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    content = [F.col("n"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    whole = Window.partitionBy("conv_id")
    numbered = materialize(
        logged.withColumn("n", F.row_number().over(in_order))
        .withColumns({"h1": F.bit_xor(F.xxhash64(*content)).over(in_order), "h2": F.bit_xor(F.xxhash64(F.lit("second"), *content)).over(in_order),
                      "n_turns": F.count("*").over(whole)}), "turns")
    ends = (numbered.where("n = n_turns").groupBy("h1", "h2", "n")
            .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")))
    prefixes = numbered.where("n < n_turns").select("h1", "h2", "n").distinct()
    maximal = ends.join(prefixes, ["h1", "h2", "n"], "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"), "n_copies")
    return numbered.select("conv_id", "n", "role", "text"), maximal


def format_chats(turns: DataFrame, start: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """A row per maximal conversation: conv_id, n_turns, n_copies (equal logged conversations, itself
    included), rendered.

    A turn is ``start`` role newline text ``end`` newline; a null role is ``unknown``, a null text is empty.
    The markers are taken out of roles and texts first, so that no text can open or close a turn.
    """
    numbered, maximal = maximal_conversations(turns)

    def clean(c: str, other: str):
        out = F.coalesce(F.col(c), F.lit(other))
        for mark in (start, end):
            out = F.replace(out, F.lit(mark), F.lit(""))
        return out

    turn = F.concat(F.lit(start), clean("role", "unknown"), F.lit("\n"), clean("text", ""), F.lit(end), F.lit("\n"))
    kept = numbered.join(maximal.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")))
    made = kept.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("n_copies").alias("n_copies"),
        F.sort_array(F.collect_list(F.struct("n", turn.alias("turn")))).alias("turns"))
    return made.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("rendered"))
