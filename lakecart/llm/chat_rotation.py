"""Chat formatting by multi-party perspective rotation.

For every participant of a dialogue the whole dialogue is rendered once with
that speaker as the assistant and every other participant as a user with a
name; only the assistant's words (and their end marker) are marked for the
loss.  Spans are half-open character ranges of the rendered text.

    <|im_start|>user name=bob          other participants
    <|im_start|>assistant              the participant whose perspective it is
    <|im_start|>system                 system turns (no participant)
    <|im_start|>user                   turns without a known speaker

Turns are ordered by turn, speaker and text.  A dialogue is rendered in parts
of at most ``part_turns`` turns: nearly every dialogue is one part, and a
dialogue of any length (one may hold a third of all rows) is spread over as
many rows as it needs, so no task gathers an unbounded dialogue.  The
concatenation of the parts in order is the whole rendering.

Defined results: a null or empty speaker is no participant and its turns are
unnamed users; a null text is an empty turn; rows without a dialogue id form
the dialogue of the null id; repeated turns are rendered as often as they
occur; a dialogue without participants (only system turns) has no perspective,
hence no rows; markers inside texts are broken by a blank so that they can't
forge turns; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.functions.ids import dense_row_id

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = ("system",)
PART_TURNS = 512


def _clean(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for marker in (START, END):
        text = F.replace(text, F.lit(marker), F.lit(marker[:2] + " " + marker[2:]))
    return text


def dialogue_parts(turns: DataFrame, conv: str, turn: str, speaker: str, text: str, part_turns: int) -> DataFrame:
    """(conv, part, turns): the ordered turns of each dialogue in arrays of at most ``part_turns``."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                        F.nullif(F.col(speaker), F.lit("")).alias("speaker"), _clean(F.col(text)).alias("text"))
    rows = dense_row_id(rows, ["conv", "turn", "speaker", "text"], "n")
    first = rows.groupBy("conv").agg(F.min("n").alias("first")).withColumnRenamed("conv", "c")
    at = F.col("n") - F.col("first")
    return (rows.join(first, F.col("conv").eqNullSafe(F.col("c")))
            .groupBy("conv", F.floor(at / part_turns).cast("int").alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct("n", "speaker", "text"))).alias("turns")))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
           system: tuple[str, ...] = SYSTEM, part_turns: int = PART_TURNS) -> DataFrame:
    """One row per dialogue, participant and part: rendered text, loss spans and counts."""
    parts = dialogue_parts(turns, conv, turn, speaker, text, part_turns)
    people = (turns.filter(F.col(speaker).isNotNull() & (F.col(speaker) != "") & ~F.col(speaker).isin(*system))
              .select(F.col(conv).alias("c"), F.col(speaker).alias("perspective")).distinct())

    def head(who: Column) -> Column:
        role = (F.when(who.isNull(), F.lit("user")).when(who.isin(*system), F.lit("system"))
                .when(who == F.col("perspective"), F.lit("assistant"))
                .otherwise(F.concat(F.lit("user name="), _clean(F.regexp_replace(who, r"\s+", "_")))))
        return F.concat(F.lit(START), role, F.lit("\n"))

    pieces = F.transform("turns", lambda t: F.struct(
        head(t["speaker"]).alias("head"), t["text"].alias("body"),
        (t["speaker"] == F.col("perspective")).alias("mine")))
    close = END + "\n"
    # The end of each turn is the running sum of its lengths; the spans follow from it.
    spans = F.aggregate(
        "pieces", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(close)).alias("at"),
            F.when(p["mine"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(p["head"])).alias("start"),
                (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(END)).alias("end")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    shown = (parts.join(people, F.col("conv").eqNullSafe(F.col("c")))
             .select("conv", "perspective", "part", pieces.alias("pieces"))
             .withColumn("spans", spans))
    return shown.select(
        F.col("conv").alias(conv), "perspective", "part",
        F.size("pieces").alias("n_turns"), F.size("spans").alias("n_masked"),
        F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(close)))).alias("rendered"),
        "spans")
