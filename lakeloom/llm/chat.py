"""Multi-party chat formatting by perspective rotation, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import has_columns

#: Fixed values of the rendered form.
SYSTEM, ASSISTANT, USER, BODY, END = "<|system|>", "<|assistant|>", "<|user:", "\n", "<|end|>\n"


def _head(role: Column, speaker: Column, system_roles: tuple[str, ...]) -> Column:
    return (
        F.when(role.isin(*system_roles), SYSTEM)
        .when(role == speaker, ASSISTANT)
        .otherwise(F.concat(F.lit(USER), role, F.lit("|>")))
    )


def rotate_perspectives(turns: DataFrame, system_roles: tuple[str, ...] = ("system",)) -> DataFrame:
    """One dialogue for each conversation and each participant in it, told with that participant as the assistant.

    Every turn is `head`, line feed, text, end mark. The speaker's own turns get the assistant's head, system turns the
    system head, all others a user head with their name. `mask` lists the (start, end) code point intervals to learn
    from: text and end mark of the speaker's turns. Returns conv_id, speaker, n_turns, n_own, text, mask.

    Turns are ordered by turn, role, text (nulls first). A null role is named "unknown", a null text is empty. Each row
    with a null conv_id is a conversation of its own. Repeated rows are turns of their own. A conversation of system
    turns alone has no participant, so no dialogue. Extra columns are left out; an empty table gives no dialogues. A
    dialogue is one row of the result, and only its own turns are gathered for it.
    """
    rows = has_columns(turns, conv_id="long", turn="long", role="string", text="string")
    rows = rows.withColumn("own_key", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    rows = rows.withColumns({"role": F.coalesce("role", F.lit("unknown")), "text": F.coalesce("text", F.lit(""))})
    # Where a turn lies when its speaker is the assistant: all turns before it as others', and each own one with the
    # assistant's head in place of the user's. So the masks of all participants come from running sums over the turns.
    is_system = F.col("role").isin(*system_roles)
    other = F.when(is_system, len(SYSTEM)).otherwise(F.char_length("role") + len(USER) + len("|>"))
    length = other + len(BODY) + F.char_length("text") + len(END)
    talk = W.partitionBy("conv_id", "own_key").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, -1)
    own = W.partitionBy("conv_id", "own_key", "role").orderBy("turn", "text")
    before = F.coalesce(F.sum(length).over(talk), F.lit(0))
    shift = (F.row_number().over(own) - 1) * (len(ASSISTANT) - other)
    start = (before + shift + len(ASSISTANT) + len(BODY)).cast("long")
    rows = rows.withColumn("start", start).withColumn("end", F.col("start") + F.char_length("text") + len(END))
    turn = F.struct("turn", "role", "text", "start", "end")
    talks = rows.groupBy("conv_id", "own_key").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    names = F.array_distinct(F.filter(F.transform("turns", lambda t: t["role"]), lambda r: ~r.isin(*system_roles)))
    told = talks.select("conv_id", "turns", F.explode(names).alias("speaker"))

    head = lambda t: _head(t["role"], F.col("speaker"), system_roles)
    text = F.array_join(F.transform("turns", lambda t: F.concat(head(t), F.lit(BODY), t["text"], F.lit(END))), "")
    told = told.withColumn("own", F.filter("turns", lambda t: t["role"] == F.col("speaker")))
    mask = F.transform("own", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    n_turns, n_own = (F.size(c).cast("long").alias(n) for c, n in (("turns", "n_turns"), ("own", "n_own")))
    return told.select("conv_id", "speaker", n_turns, n_own, text.alias("text"), mask.alias("mask"))
