"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context and
only its reply is trainable.  Turns after the last reply stand in one more row without a
trainable part, so nothing of a conversation is lost.

Template: `<|im_start|>role\\ntext<|im_end|>\\n`.  In texts and roles a backslash is
doubled and `<|` becomes `<\\|`, so no text can hold a control string; in roles a line
feed becomes `<|nl|>`.  `unescaped` undoes both exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_examples(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trainable: str = "assistant") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_length): one row for each reply.

    example is the place of the example's last turn in its conversation (from 1);
    loss_start and loss_length are code points of the reply inside text, null in the row
    of trailing turns.  Turns are ordered by turn, then role, then text, nulls first, so
    ties and repeated rows (all kept) have one order.  Null texts and roles count as
    empty.  A row without a conv_id is a conversation of its own, as nothing tells which
    of them belong together; they are not grouped.  A conversation of n turns gives n
    prefixes, so its output grows with the square of its length.
    """
    col = lambda c: rows[f"`{c}`"]
    turns = rows.select(col(conv_id).alias("conv_id"), F.struct(col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text")).alias("t"))
    whole = turns.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.unionByName(turns.where("conv_id is null").select("conv_id", F.array("t").alias("turns")))
    segment = lambda t: F.concat(F.lit(START), F.replace(escaped(t["role"]), F.lit("\n"), F.lit(LINE)), F.lit("\n"), escaped(t["text"]), F.lit(END))
    parts = whole.select(
        "conv_id",
        F.transform("turns", segment).alias("segments"),
        F.transform("turns", lambda t: F.when(t["role"] == trainable, F.length(escaped(t["text"])))).alias("replies"),
    )
    ends = F.filter(F.sequence(F.lit(1), F.size("segments")), lambda k: F.element_at("replies", k).isNotNull() | (k == F.size("segments")))
    each = parts.select("conv_id", "segments", "replies", F.explode(ends).alias("example"))
    return each.select(
        "conv_id", "example",
        F.array_join(F.slice("segments", F.lit(1), F.col("example")), "").alias("text"),
        F.element_at("replies", F.col("example")).cast("long").alias("loss_length"),
    ).select("conv_id", "example", "text", F.when(F.col("loss_length").isNotNull(), F.length("text") - len(END) - F.col("loss_length")).cast("long").alias("loss_start"), "loss_length")


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted examples alone: its turns, and all text under the loss mask."""
    row = examples.select("conv_id", "example", "text", F.when(F.col("loss_length").isNotNull(), unescaped(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_length").cast("int")))).alias("loss"))
    # A row without a conversation is its only example, and the only one for its digest.
    said_in = F.when(F.col("loss").isNotNull(), F.struct("example", "loss"))
    got = row.where("conv_id is not null").groupBy("conv_id").agg(F.max_by("text", "example").alias("text"), F.sort_array(F.collect_list(said_in)).alias("losses"), F.sum(F.length("text")).alias("formatted_chars"))
    got = got.unionByName(row.where("conv_id is null").select("conv_id", "text", F.array_compact(F.array(said_in)).alias("losses"), F.length("text").cast("long").alias("formatted_chars")))
    pieces = F.filter(F.split("text", r"<\|im_start\|>"), lambda x: x != "")
    body = lambda p: F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END))
    said = lambda p: F.concat(unescaped(F.replace(F.substring_index(p, "\n", 1), F.lit(LINE), F.lit("\n"))), F.lit("\n"), unescaped(body(p)), F.lit("\n"))
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return got.select(
        "conv_id",
        F.size(pieces).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(pieces, said), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
