"""Chat examples by prefix and target: one per assistant turn.

Every assistant turn becomes an example of its own: all turns up to it are
rendered, and only its text is trainable. Turns after the last assistant turn
(or a conversation without one) make a last example that trains nothing, so
that the output holds every turn. A backslash and the opening of a control
string inside a text or role are escaped, so no text can end a turn, and
unescaping gives the text back.

Null texts and roles are empty. Turns are ordered by turn, role and text;
repeated rows are turns of their own. Rows without a conversation id make one
conversation. A conversation is one row while it is rendered, as its examples
hold it whole; its examples are made one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, SLASH = "<|im_start|>", "<|im_end|>\n", "\\"


def escaped(text: Column, line: bool = False) -> Column:
    """Reversible; the result holds no ``<|``, with ``line`` also no line break."""
    out = F.replace(F.replace(text, F.lit(SLASH), F.lit(SLASH * 2)), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if line else out


def unescaped(text: Column) -> Column:
    part = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))
    return F.array_join(F.transform(F.split(text, "\\\\\\\\", -1), part), SLASH)


def examples(df: DataFrame) -> DataFrame:
    """``conv_id, example, text, loss_start, loss_chars``; the loss span counts code points from 0."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = df.select("conv_id", F.struct("turn", empty("role").alias("role"), empty("text").alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(START), escaped(t["role"], line=True), F.lit("\n"))
    rendered = whole.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(head(t), escaped(t["text"]), F.lit(END))).alias("parts"),
        F.transform("turns", lambda t: F.struct(
            (t["role"] == "assistant").alias("trains"), F.length(escaped(t["text"])).alias("chars"))).alias("spans"))
    last = F.size("spans")
    wanted = F.filter(F.sequence(F.lit(1), last), lambda i: F.element_at("spans", i)["trains"] | (i == last))
    one = rendered.select("conv_id", "parts", "spans", F.explode(wanted).alias("example"))
    one = one.select(
        "conv_id", "example", F.array_join(F.slice("parts", F.lit(1), F.col("example")), "").alias("text"),
        F.element_at("spans", F.col("example")).alias("span"))
    chars = F.when(F.col("span.trains"), F.col("span.chars"))
    return one.select(
        "conv_id", "example", "text",
        F.when(F.col("span.trains"), F.length("text") - F.length(F.lit(END)) - F.col("span.chars")).alias("loss_start"),
        F.coalesce(chars, F.lit(0)).alias("loss_chars"))


def parsed(text: Column) -> Column:
    """The turns of an example: an array of role and text."""
    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - F.length(F.lit(END)))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(F.filter(F.split(text, r"<\|im_start\|>", -1), lambda p: p != ""), turn)


def read_back(made: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: turns, all trainable text in order, and the size."""
    loss = F.when(F.col("loss_start").isNotNull(),
                  unescaped(F.substring("text", F.col("loss_start") + 1, F.col("loss_chars"))))
    rows = made.select("conv_id", "example", loss.alias("loss"), F.length("text").cast("long").alias("chars"), "text")
    per = rows.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("chars").alias("formatted_chars"))
    return per.select(
        "conv_id", parsed(F.col("longest")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"), "formatted_chars")
