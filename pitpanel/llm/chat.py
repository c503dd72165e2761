"""Chat formatting with Spark expressions only: sorted turn structs, merged turns, one string per conversation.

Template: <s> then, for each run of turns of one role, [INST]role[TEXT]text[SEP]text...</s>. Control strings in roles and
texts get a backslash after their first character, and each backslash is doubled before, so that reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, TURN, TEXT, SEP, END = "<s>", "[INST]", "[TEXT]", "[SEP]", "</s>"
CONTROLS = (BEGIN, END, TURN, "[/INST]", TEXT, SEP)


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    for c in CONTROLS:
        text = F.replace(text, F.lit(c[0] + "\\" + c[1:]), F.lit(c))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, formatted, loss_spans array<struct<start,end>> in code points of formatted.

    Turns are ordered by turn (null first), then role and text, so that ties and repeated rows have one result; adjacent
    turns of a role are merged into one block, their borders kept as [SEP]. A null role or text counts as empty, rows with
    a null conv_id form one conversation, other columns are ignored, an empty table gives no rows. The loss spans hold the
    texts of `loss_role`, without markers. A conversation is one string, so it must fit a task; conversations do not meet.
    """
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    chats = chats.withColumn("turns", F.transform("turns", lambda t: F.struct(t.role.alias("role"), escape(t.text).alias("text"))))

    # merge: what stands before each text is the border to the previous one
    before = lambda t, i: F.when(i == 0, F.concat(F.lit(BEGIN + TURN), escape(t.role), F.lit(TEXT))).when(
        t.role == F.get(F.col("turns"), i - 1)["role"], F.lit(SEP)
    ).otherwise(F.concat(F.lit(END + TURN), escape(t.role), F.lit(TEXT)))
    chats = chats.withColumn("pieces", F.transform("turns", lambda t, i: F.struct(before(t, i).alias("head"), t.text.alias("text"), (t.role == loss_role).alias("loss"))))
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["text"])).alias("at"),
            F.when(p["loss"], F.concat(a["spans"], F.array(F.struct(
                (a["at"] + F.length(p["head"])).alias("start"), (a["at"] + F.length(p["head"]) + F.length(p["text"])).alias("end")
            )))).otherwise(a["spans"]).alias("spans"),
        ),
    )["spans"]
    text = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"])), ""), F.lit(END))
    return chats.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """formatted -> its columns and `turns` array<struct<role,text>>, `loss_text`: what the template holds, unescaped."""
    body = F.expr(f"substring(formatted, {len(BEGIN) + len(TURN) + 1}, length(formatted) - {len(BEGIN) + len(TURN) + len(END)})")
    blocks = F.split(body, r"\Q" + END + TURN + r"\E", -1)
    turns = F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring_index(b, TEXT, -1), r"\Q" + SEP + r"\E", -1),
        lambda x: F.struct(unescape(F.substring_index(b, TEXT, 1)).alias("role"), unescape(x).alias("text")),
    )))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")
    ))), "")
    return formatted.withColumn("turns", turns).withColumn("loss_text", loss)
