"""Chat formatting with Spark expressions only (operator 10).

A formatted conversation is one string: every run of turns of one role is
`<turn>` role `<says>` text `<and>` text ... `</turn>` and a line feed.  Inside roles and texts a backslash is written
`\\b` and a less-than sign `\\l`, so an unescaped less-than sign only ever begins a control string and the conversation
can be read back.  The loss mask is the list of spans (code points, end exclusive) of the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.shared import let, sums_before

TURN, SAYS, AND, END = "<turn>", "<says>", "<and>", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undoes `escape`: a written backslash is never followed by an l, so the order of the two is free of clashes."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def formatted(turns: DataFrame, learner: str = "assistant") -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): conv_id, formatted, and loss_spans, the array of
    (start, end) of the texts of the role `learner`.

    Turns go by turn number (null first), ties by role and text; repeated rows are turns each.  Null roles and texts
    are empty.  Rows with a null conv_id make up one conversation.  A conversation is one string and so one row; its
    length is bounded by what a string may hold.  An empty table gives an empty result.
    """
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))

    def changes(t: Column) -> Column:
        """Where a turn's role is not that of the one before."""
        return F.filter(F.sequence(F.lit(0), F.size(t) - 1),
                        lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]))

    def runs(t: Column, at: Column) -> Column:
        """Adjacent turns of one role, merged: role and texts."""
        return F.transform(at, lambda first, j: F.struct(
            F.get(t, first)["role"].alias("role"),
            F.transform(F.slice(t, first + 1, F.coalesce(F.get(at, j + 1), F.size(t)) - first),
                        lambda x: x["text"]).alias("texts")))

    def head(role: Column, j: Column, k: Column) -> Column:
        """What stands before text k of run j."""
        opened = F.concat(F.when(j == 0, "").otherwise(END), F.lit(TURN), escape(role), F.lit(SAYS))
        return F.when(k == 0, opened).otherwise(AND)

    merged = rows.select("conv_id", let(F.col("turns"), lambda t: let(changes(t), lambda at: runs(t, at))).alias("runs"))
    parts = merged.select("conv_id", F.flatten(F.transform("runs", lambda run, j: F.transform(
        run["texts"], lambda text, k: F.struct(
            head(run["role"], j, k).alias("head"), escape(text).alias("body"),
            (run["role"] == learner).alias("learned"))))).alias("parts"))
    placed = parts.withColumn("before", sums_before(F.transform(
        "parts", lambda p: (F.length(p["head"]) + F.length(p["body"])).cast("long"))))
    spans = F.transform(F.filter(F.arrays_zip("parts", "before"), lambda z: z["parts"]["learned"]), lambda z: F.struct(
        (z["before"] + F.length(z["parts"]["head"])).alias("start"),
        (z["before"] + F.length(z["parts"]["head"]) + F.length(z["parts"]["body"])).alias("end")))
    text = F.concat(F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"])), ""), F.lit(END))
    return placed.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(text: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    def turns(run: Column) -> Column:
        return let(F.split(run, SAYS, 2), lambda two: F.transform(
            F.split(F.get(two, 1), AND, -1),
            lambda x: F.struct(unescape(F.substring(F.get(two, 0), len(TURN) + 1, 2 ** 31 - 1)).alias("role"),
                               unescape(x).alias("text"))))

    return F.flatten(F.transform(F.filter(F.split(text, END, -1), lambda r: r != ""), turns))


def learned_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
