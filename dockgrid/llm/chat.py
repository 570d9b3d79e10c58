"""Chat formatting: multi-party dialogues rendered once from the perspective of every participant.

A participant is a role of the conversation other than system. In a participant's rendering their turns are the assistant's, all
other turns are users' with names, system turns stay. The mask marks what the assistant says (with the closing mark), which is
what training would learn. A rendering is stored in parts of part_turns turn numbers, so no group grows with a
conversation; each part says where in the whole dialogue it begins, and masks count characters of the whole, so the parts of a
rendering joined in order are the dialogue. Marks inside turns and names are broken, so no text opens a turn of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

C = F.col
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def perspectives(turns: DataFrame, part_turns: int = 256, unnamed: str = "unknown") -> DataFrame:
    """conv_id, perspective, part long, turn_start long, text_start long, n_turns long, text, mask array<struct<s long, e long>>.

    text_start and turn_start: characters and turns of the rendering before this part; mask: character ranges of the whole rendering.
    turns: conv_id, turn, role, text; other columns are left out. Turns go by (turn, role, text), nulls first; repeated rows are
    repeated turns. Null text is '', a null role is `unnamed`, null turns are part -1. Rows with null conv_id belong to no
    conversation and are left out. A conversation with system turns only has no participant and gives no row.
    """
    broken = lambda x: F.replace(x, F.lit("<|im_"), F.lit("< |im_"))
    t = turns.filter(C("conv_id").isNotNull()).select(
        "conv_id", F.coalesce(F.floor(C("turn") / part_turns), F.lit(-1)).cast("long").alias("part"), "turn", F.coalesce("role", F.lit(unnamed)).alias("role"), broken(F.coalesce("text", F.lit(""))).alias("text")
    )
    parts = t.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    who = t.filter("role <> 'system'").select("conv_id", C("role").alias("perspective")).distinct()
    named = lambda role: F.concat(F.lit("user name="), F.replace(broken(role), F.lit("\n"), F.lit(" ")))

    def head(role: Column, mine: Column | None = None) -> Column:
        shown = F.when(role == "system", "system")
        if mine is not None:
            shown = shown.when(mine, "assistant")
        return F.concat(F.lit(OPEN), shown.otherwise(named(role)), F.lit("\n"))

    # Lengths of the parts as others see them, and what a participant's own heads differ in: small rows that give the running positions.
    length = F.char_length(head(C("role"))) + F.char_length("text") + len(CLOSE)
    seen = t.groupBy("conv_id", "part").agg(F.sum(length).alias("chars"), F.count("*").alias("n_turns"))
    own = t.filter("role <> 'system'").groupBy("conv_id", "part", C("role").alias("perspective")).agg(F.sum(F.lit(len("assistant")) - F.char_length(named(C("role")))).alias("own"))
    grid = seen.join(who, "conv_id").join(own, ["conv_id", "part", "perspective"], "left")
    before = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = [F.coalesce(F.sum(x).over(before), F.lit(0)).cast("long").alias(name) for x, name in ((C("chars") + F.coalesce("own", F.lit(0)), "text_start"), (C("n_turns"), "turn_start"))]
    grid = grid.select("conv_id", "part", "perspective", "n_turns", *starts)

    pieces = F.transform("turns", lambda x: F.struct(head(x["role"], x["role"] == C("perspective")).alias("head"), F.concat(x["text"], F.lit(CLOSE)).alias("body"), (x["role"] == C("perspective")).alias("mine")))
    start = F.struct(C("text_start").alias("at"), F.expr("cast(array() AS array<struct<s:bigint,e:bigint>>)").alias("spans"))

    def mark(state: Column, x: Column) -> Column:
        begin = state["at"] + F.char_length(x["head"])
        end = begin + F.char_length(x["body"])
        return F.struct(end.alias("at"), F.when(x["mine"], F.concat(state["spans"], F.array(F.struct(begin.alias("s"), end.alias("e"))))).otherwise(state["spans"]).alias("spans"))

    both = parts.join(grid, ["conv_id", "part"]).withColumn("pieces", pieces)
    text = F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"])), "")
    return both.select("conv_id", "perspective", "part", "turn_start", "text_start", "n_turns", text.alias("text"), F.aggregate("pieces", start, mark)["spans"].alias("mask"))
