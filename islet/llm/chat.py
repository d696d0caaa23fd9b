"""Preference formatting of conversations, in built-in functions only.

A pair's longest common run of first turns is rendered once as the prompt;
the remaining turns of each side are rendered as its completion.  A mask of
run lengths says which code points of the completion are trained on: an
assistant's words and their end mark, never the other roles or headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from islet.llm.order_minhash import with_next

END = "<|end|>\n"


def head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def body(turn: Column) -> Column:
    """A turn's text, its marks made harmless, and the end mark."""
    return F.concat(F.replace(turn["text"], F.lit("<|"), F.lit("< |")), F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), body(t))), "")


def mask(turns: Column, trained: str = "assistant") -> Column:
    """Run lengths of the rendered turns: ``length:0`` and ``length:1``, by
    commas, where 1 is trained on."""
    def run(t):
        return F.concat(F.length(head(t)).cast("string"), F.lit(":0,"), F.length(body(t)).cast("string"), F.when(t["role"] == trained, ":1").otherwise(":0"))

    return F.array_join(F.transform(turns, run), ",")


def gather(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) -> (conv_id, turns), sorted by turn.
    Turns without a conv_id are in no conversation; null texts are empty, a
    null role is ``unknown``; repeated rows stay.  A row holds a conversation,
    as the rendered result has to."""
    row = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    got = turns.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    return got.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def with_rejected(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) -> (conv_id, chosen, rejected).

    chosen ends at the last assistant turn; rejected has in its place that of
    the next conversation by descending conv_id (after the last: the first).
    Conversations without an assistant turn give no pair.
    """
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == "assistant"), F.lit(True)).cast("int")
    convs = convs.filter(F.exists("turns", lambda t: t["role"] == "assistant")).withColumn("last", last)
    convs = convs.withColumn("reply", F.get("turns", F.col("last"))["text"])
    convs = with_next(convs, "conv_id", ["reply"])
    before = F.slice("turns", F.lit(1), F.col("last"))
    turn = lambda text: F.array(F.struct(F.lit("assistant").alias("role"), F.col(text).alias("text")))
    return convs.select("conv_id", F.concat(before, turn("reply")).alias("chosen"), F.concat(before, turn("next_reply")).alias("rejected"))


def preference(pairs: DataFrame) -> DataFrame:
    """pairs(.., chosen, rejected: arrays of (role, text)) -> also n_common,
    prompt, chosen_completion, rejected_completion, chosen_mask, rejected_mask.

    Equal conversations are all prompt, with empty completions and masks; pairs
    with different first turns have an empty prompt.
    """
    same = F.zip_with("chosen", "rejected", lambda x, y: x.eqNullSafe(y))
    differ = F.array_position(same, F.lit(False))
    pairs = pairs.withColumn("n_common", F.when(differ > 0, differ - 1).otherwise(F.size("chosen")).cast("long"))

    def rest(side):
        n = F.col("n_common").cast("int")
        return F.slice(side, n + 1, F.size(side))

    return pairs.withColumns({
        "prompt": render(F.slice("chosen", F.lit(1), F.col("n_common").cast("int"))),
        "chosen_completion": render(rest("chosen")), "rejected_completion": render(rest("rejected")),
        "chosen_mask": mask(rest("chosen")), "rejected_mask": mask(rest("rejected")),
    })
