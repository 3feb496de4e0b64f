"""Preference formatting for chat models, in DataFrame functions only.

A pair is two conversations, chosen and rejected, as rows (pair_id, turn, role,
text).  Their longest common prefix of equal turns is rendered once as the
prompt; what follows in each becomes a completion with its loss mask: the
assistant's turns are learned, all else is masked.

Turns are matched by position, not by gathering a conversation: each side is
numbered per pair, the two are joined on (pair, position), and the prefix ends
at the smallest position where they differ -- one aggregation with a partial
minimum.  Only the rendered strings, which are the result, are put together
per pair.

Defined results: a side is ordered by (turn, role, text), nulls first, so
repeated or null turn numbers have a defined place; a null role renders as
``user`` and a null text as an empty turn, and nulls equal nulls when turns are
compared; where one side is a prefix of the other (or equal) its completion is
empty; a pair with one side only has an empty prompt and one null completion; a
null pair_id is left out; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Chat template: what stands before and after a turn's text.
TURN_START, ROLE_END, TURN_END = "<|", "|>\n", "\n<|end|>\n"
LEARNED_ROLE = "assistant"


def _side(turns: DataFrame, name: str) -> DataFrame:
    by_place = Window.partitionBy("pair_id").orderBy("turn", "role", "text")
    return turns.where("pair_id is not null").select(
        F.col("pair_id").alias(f"{name}_pair"), (F.row_number().over(by_place) - 1).alias(f"{name}_pos"),
        F.coalesce(F.col("role").cast("string"), F.lit("user")).alias(f"{name}_role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias(f"{name}_text"))


def _head(role: Column) -> Column:
    return F.concat(F.lit(TURN_START), role, F.lit(ROLE_END))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t["role"]), t["text"], F.lit(TURN_END))), "")


def _mask(turns: Column) -> Column:
    """Spans [start, end) of the rendered text that are learned: the assistant's words and turn ends."""
    def add(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(_head(t["role"]))
        end = start + F.length(t["text"]) + len(TURN_END)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == LEARNED_ROLE, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")),
                       add, lambda acc: acc["out"])


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, n_common, prompt, chosen, chosen_mask, rejected, rejected_mask): masks are
    arrays of (start, end) code points of the completion that carry loss."""
    a, b = _side(chosen, "c"), _side(rejected, "r")
    both = a.join(b, (F.col("c_pair") == F.col("r_pair")) & (F.col("c_pos") == F.col("r_pos")), "full").select(
        F.coalesce("c_pair", "r_pair").alias("pair_id"), F.coalesce("c_pos", "r_pos").alias("pos"),
        F.when(F.col("c_pos").isNotNull(), F.struct(F.col("c_pos").alias("pos"), F.col("c_role").alias("role"), F.col("c_text").alias("text"))).alias("c"),
        F.when(F.col("r_pos").isNotNull(), F.struct(F.col("r_pos").alias("pos"), F.col("r_role").alias("role"), F.col("r_text").alias("text"))).alias("r"))
    differs = ~(F.col("c.role").eqNullSafe(F.col("r.role")) & F.col("c.text").eqNullSafe(F.col("r.text")))
    sides = both.groupBy("pair_id").agg(
        F.coalesce(F.min(F.when(differs, F.col("pos"))), F.max("pos") + 1).alias("n_common"),
        F.array_sort(F.collect_list("c")).alias("c"), F.array_sort(F.collect_list("r")).alias("r"))

    def rest(side: str) -> Column:
        return F.filter(side, lambda t: t["pos"] >= F.col("n_common"))

    def completion(side: str, value: Column) -> Column:
        return F.when(F.size(side) > 0, value)

    return sides.select("pair_id", F.col("n_common").cast("long").alias("n_common"),
                        _rendered(F.filter("c", lambda t: t["pos"] < F.col("n_common"))).alias("prompt"),
                        completion("c", _rendered(rest("c"))).alias("chosen"), completion("c", _mask(rest("c"))).alias("chosen_mask"),
                        completion("r", _rendered(rest("r"))).alias("rejected"), completion("r", _mask(rest("r"))).alias("rejected_mask"))


def neighbour_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations: a conversation is chosen, and rejected is the
    same conversation with every assistant turn from its second on (its only one, if there is
    one) taken from the conversation with the next id; assistant turns that the next one lacks
    at that turn stay as they are."""
    rows = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text").where("pair_id is not null")
    kept = rows.groupBy("pair_id").agg(F.sort_array(F.collect_set(F.when(F.col("role") == LEARNED_ROLE, F.col("turn")))).alias("t")).select(
        F.col("pair_id").alias("k_pair"), F.coalesce(F.get("t", F.lit(1)), F.get("t", F.lit(0))).alias("since"))
    other = rows.where(F.col("role") == LEARNED_ROLE).groupBy(
        (F.col("pair_id") - 1).alias("o_pair"), F.col("turn").alias("o_turn")).agg(F.min("text").alias("o_text"))
    rejected = (rows.join(kept, F.col("pair_id") == F.col("k_pair"))
                .join(other, (F.col("pair_id") == F.col("o_pair")) & (F.col("turn") == F.col("o_turn")) & (F.col("role") == LEARNED_ROLE), "left")
                .select("pair_id", "turn", "role", F.when(F.col("turn") >= F.col("since"), F.coalesce("o_text", "text"))
                        .otherwise(F.col("text")).alias("text")))
    return rows, rejected
