"""Chat formatting by prefix-target expansion (operator 8), in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only
its text is trainable.  A turn is written as

    <|im_start|>role
    text<|im_end|>

Control strings inside texts and roles are escaped, reversibly: backslashes are doubled and
``<|`` becomes ``<\\|``; a line break in a role becomes ``<\\/``.  A conversation that does not end
with an assistant turn also gives one example without a trainable part, so that no turn is lost.

An example holds its conversation up to its turn, so a conversation is one group by nature; its
size is that of one conversation, not of the table.

Defined cases: null texts and roles are empty; turns of equal number are ordered by role and
text; a null turn comes first; rows with a null conv_id form one conversation; repeated rows are
turns of their own.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The template.
START, END, BREAK = "<|im_start|>", "<|im_end|>", "\n"
ASSISTANT = "assistant"


def _replace(column: Column, old: str, new: str) -> Column:
    return F.replace(column, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    return _replace(_replace(text, "\\", "\\\\"), "<|", "<\\|")


def unescape(text: Column) -> Column:
    # After doubling, an odd run of backslashes behind "<" can only come from escaping.
    return _replace(_replace(text, "<\\|", "<|"), "\\\\", "\\")


def _escape_role(role: Column) -> Column:
    return _replace(escape(role), BREAK, "<\\/")


def _unescape_role(role: Column) -> Column:
    return unescape(_replace(role, "<\\/", BREAK))


def chat_examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, n_turns, formatted, loss_start, loss_end``: the trainable part is
    ``[loss_start, loss_end)``, in code points; it is empty in an example without a target."""
    rows = conversations.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t")
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    written = turns.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == ASSISTANT).alias("target"),
        F.transform("turns", lambda t: F.concat(F.lit(START), _escape_role(t["role"]), F.lit(BREAK))).alias("heads"),
        F.transform("turns", lambda t: escape(t["text"])).alias("bodies"),
    )
    wanted = F.filter(F.sequence(F.lit(1), F.size("target")), lambda i: F.get("target", i - 1) | (i == F.size("target")))
    one = written.select("*", F.explode(wanted).alias("example"))
    before = F.transform(
        F.slice("heads", 1, F.col("example") - 1),
        lambda h, i: F.concat(h, F.get("bodies", i), F.lit(END + BREAK)),
    )
    body = F.get("bodies", F.col("example") - 1)
    parts = one.select(
        "conv_id", "example", F.concat(F.array_join(before, ""), F.get("heads", F.col("example") - 1)).alias("context"),
        body.alias("body"), F.get("target", F.col("example") - 1).alias("trained"),
    )
    start = F.length("context").cast("long")
    return parts.select(
        "conv_id", "example", F.col("example").cast("long").alias("n_turns"),
        F.concat("context", "body", F.lit(END + BREAK)).alias("formatted"), start.alias("loss_start"),
        (start + F.when(F.col("trained"), F.length("body")).otherwise(0)).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example, as an array of ``(role, text)``."""
    parts = F.slice(F.split(formatted, "<\\|im_start\\|>"), 2, 1 << 30)
    tail = len(END + BREAK)

    def turn(part: Column) -> Column:
        head = F.substring_index(part, BREAK, 1)
        size = F.length(part) - F.length(head) - 1 - tail
        return F.struct(_unescape_role(head).alias("role"), unescape(F.substring(part, F.length(head) + 2, size)).alias("text"))

    return F.transform(parts, turn)


def trained_text(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int")))


def chat_digest(examples: DataFrame) -> DataFrame:
    """What the examples hold, read back from them, by conversation."""
    read = examples.select(
        "conv_id", "example", "formatted", trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss")
    )
    whole = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    ).withColumn("turns", read_turns(F.col("longest")))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(BREAK), t["text"], F.lit(BREAK))), "")
    return whole.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
