"""Preference formatting: paired conversations to prompt, chosen and rejected (DataFrame only).

A pair's two conversations are compared turn by turn; the longest common prefix of (role, text)
turns is rendered once as the prompt, the rest of either side as its completion.  Completions
carry a loss mask: character spans of assistant text (with its end mark); headers and other
roles' turns are masked out.  A common prefix ends early so that each side that has turns keeps
at least one (a conversation that is a prefix of the other would otherwise have no completion).

Rendering of a turn: ``<|role|>\\n`` + text + ``<|end|>\\n``.

Edge cases: null role renders as ``unknown``, null text as empty; turns sort by (turn, role, text)
with nulls first, so ties and repeated rows have a fixed order; a side without turns gives an
empty completion and ``complete`` false; rows with a null pair id are not paired and left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"
TURN = "array<struct<turn:bigint,role:string,text:string>>"


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit(END))), "")


def loss_spans(turns: Column, roles: tuple[str, ...]) -> Column:
    """Half-open code-point spans of the trained text inside the rendered completion."""
    def step(acc: Column, t: Column) -> Column:
        head = F.length(t["role"]) + 5
        body = F.length(t["text"]) + len(END)
        start = acc["at"] + head
        span = F.struct(start.alias("start"), (start + body).alias("end"))
        return F.struct((start + body).alias("at"),
                        F.when(t["role"].isin(*roles), F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(turns, zero, step, lambda acc: acc["out"])


def pairs_of(turns: DataFrame, pair: Column, chosen: Column,
             turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``pair_id, chosen, rejected``: sorted turn arrays; ``chosen`` tells the side of a row.
    A pair is two conversations, so its rows are bounded by their length."""
    t = turns.select(pair.alias("pair_id"), chosen.alias("side"),
                     F.struct(F.col(turn_col).cast("long").alias("turn"),
                              F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
                              F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    empty = F.array().cast(TURN)
    return (t.where(F.col("pair_id").isNotNull()).groupBy("pair_id")
            .agg(F.sort_array(F.collect_list(F.when(F.col("side"), F.col("t")))).alias("chosen"),
                 F.sort_array(F.collect_list(F.when(~F.col("side"), F.col("t")))).alias("rejected"))
            .select("pair_id", F.coalesce("chosen", empty).alias("chosen"),
                    F.coalesce("rejected", empty).alias("rejected")))


def pairs_with_next_answer(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``pair_id, chosen, rejected`` from single conversations: chosen is the whole conversation, rejected
    the same turns with the text of its last assistant turn taken from conversation ``conv_id + 1``.
    Where either has no assistant turn, the rejected side is empty."""
    conv = (pairs_of(turns, F.col(conv_col), F.lit(True), turn_col, role_col, text_col)
            .select("pair_id", F.col("chosen").alias("turns")))
    is_answer = F.transform("turns", lambda t: t["role"] == "assistant")
    from_end = F.array_position(F.reverse(is_answer), True).cast("int")
    conv = conv.select("pair_id", "turns", F.when(from_end > 0, F.size("turns") - from_end).alias("at"))
    other = conv.where(F.col("at").isNotNull()).select(
        (F.col("pair_id") - 1).alias("pair_id"), F.get("turns", F.col("at"))["text"].alias("other"))
    swapped = F.transform("turns", lambda t, i: F.struct(
        t["turn"].alias("turn"), t["role"].alias("role"),
        F.when(i == F.col("at"), F.col("other")).otherwise(t["text"]).alias("text")))
    return conv.join(other, "pair_id", "left").select(
        "pair_id", F.col("turns").alias("chosen"),
        F.when(F.col("at").isNotNull() & F.col("other").isNotNull(), swapped)
        .otherwise(F.array().cast(TURN)).alias("rejected"))


def format_pairs(pairs: DataFrame, trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``pair_id, n_prefix, prompt, chosen, rejected, chosen_loss, rejected_loss, complete``."""
    a, b = F.col("chosen"), F.col("rejected")
    same = F.zip_with(a, b, lambda x, y: F.coalesce(
        (x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first_diff = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(same))
    room = F.least(F.size(a), F.size(b)) - 1
    n = F.greatest(F.least(first_diff, room), F.lit(0)).cast("int")
    p = pairs.select("pair_id", n.alias("n_prefix"), "chosen", "rejected")
    big = F.lit(2 ** 31 - 1)
    p = p.select("pair_id", "n_prefix", F.slice("chosen", 1, F.col("n_prefix")).alias("p"),
                 F.slice("chosen", F.col("n_prefix") + 1, big).alias("c"),
                 F.slice("rejected", F.col("n_prefix") + 1, big).alias("r"))
    return p.select("pair_id", F.col("n_prefix").cast("long").alias("n_prefix"),
                    render(F.col("p")).alias("prompt"), render(F.col("c")).alias("chosen"),
                    render(F.col("r")).alias("rejected"),
                    loss_spans(F.col("c"), trained_roles).alias("chosen_loss"),
                    loss_spans(F.col("r"), trained_roles).alias("rejected_loss"),
                    ((F.size("c") > 0) & (F.size("r") > 0)).alias("complete"))
