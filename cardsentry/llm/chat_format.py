"""Chat formatting with prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it as context, and only that reply under the
loss mask. A conversation that does not end in an assistant turn gets one more example without a trainable part,
so that the last example of every conversation holds all its turns and can be read back.

Template: `[INST]` user `[/INST]`, `[SYS]` system `[/SYS]`, `<s>` assistant `</s>`, and for any other role
`[ROLE]` role `[TEXT]` text `[/ROLE]`. A control string inside a role or text gets a backslash after its first
character (one more, if it has some), which `unescape` takes away again.

Defined cases: null text or role counts as empty; rows of a conversation go by turn (nulls first), then role,
then text, so ties and repeated rows have one order and all are kept; a null conv_id is a conversation of its
own; an empty table gives no rows; only conv_id, turn, role and text are read. A conversation's digest needs its
turns together, so a conversation is one row, grouped after a hash of conv_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening and closing control strings by role.
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
_NAMES = r"/?(?:s>|INST\]|SYS\]|ROLE\]|TEXT\])"
ESCAPE, ESCAPED_AS = rf"([<\[])(\\*)({_NAMES})", r"$1$2\\$3"
UNESCAPE, UNESCAPED_AS = rf"([<\[])\\(\\*)({_NAMES})", "$1$2$3"
TURN = r"(?s)(?:\[INST\]|\[SYS\]|<s>|\[ROLE\]).*?(?:\[/INST\]|\[/SYS\]|</s>|\[/ROLE\])"


def escape(text: Column) -> Column:
    """`text` without any control string; `unescape` gives it back."""
    return F.regexp_replace(text, ESCAPE, ESCAPED_AS)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, UNESCAPED_AS)


def _before_and_after(role: Column) -> tuple[Column, Column]:
    before = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    after = F.lit(OTHER[2])
    for name, (opening, closing) in MARKS.items():
        before = F.when(role == name, F.lit(opening)).otherwise(before)
        after = F.when(role == name, F.lit(closing)).otherwise(after)
    return before, after


def expand(conversations: DataFrame) -> DataFrame:
    """Examples: conv_id, example (from 0), formatted, loss_start and loss_end (code points; null: no target).

    The loss mask covers the escaped text of the last assistant turn of `formatted`, without its marks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    before, after = _before_and_after(role)
    turns = conversations.select("conv_id", F.struct(
        F.col("turn"), role.alias("role"), text.alias("raw"), before.alias("before"), escape(text).alias("body"), after.alias("after")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    pieces = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), F.length(t["before"]).alias("b"), F.length(t["body"]).alias("n"), F.length(t["after"]).alias("a")))
    whole = whole.select("conv_id", F.concat_ws("", F.transform("turns", lambda t: F.concat(t["before"], t["body"], t["after"]))).alias("full"),
                         pieces.alias("pieces"))

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + p["b"]
        end = start + p["n"] + p["a"]
        target = F.struct(start.alias("start"), (start + p["n"]).alias("stop"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(p["role"] == "assistant", F.concat(state["targets"], F.array(target)))
                        .otherwise(state["targets"]).alias("targets"))

    kind = "array<struct<start:int,stop:int,end:int>>"
    first = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("targets"))
    walked = whole.withColumn("walk", F.aggregate("pieces", first, step))
    rest = F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("stop"), F.length("full").alias("end"))
    targets = F.when(F.element_at("pieces", -1)["role"] == "assistant", F.col("walk.targets")).otherwise(
        F.concat("walk.targets", F.array(rest)))
    spread = walked.select("conv_id", "full", F.posexplode(targets).alias("example", "target"))
    return spread.select("conv_id", F.col("example").cast("long").alias("example"), F.substring("full", F.lit(1), F.col("target.end")).alias("formatted"),
                         F.col("target.start").cast("long").alias("loss_start"), F.col("target.stop").cast("long").alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example: array<struct<role, text>>, unescaped."""

    def back(t: Column) -> Column:
        inner = F.substring(t, F.lit(len(OTHER[0]) + 1), F.length(t) - len(OTHER[0]) - len(OTHER[2]))
        at = F.instr(inner, OTHER[1])
        out = F.struct(unescape(F.substring(inner, F.lit(1), at - 1)).alias("role"),
                       unescape(F.substring(inner, at + len(OTHER[1]), F.length(inner))).alias("text"))
        for name, (opening, closing) in MARKS.items():
            body = F.substring(t, F.lit(len(opening) + 1), F.length(t) - len(opening) - len(closing))
            out = F.when(F.startswith(t, F.lit(opening)), F.struct(F.lit(name).alias("role"), unescape(body).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), back)


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped; empty if there is no target."""
    inside = F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int"))
    return F.coalesce(unescape(inside), F.lit(""))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: n_turns, hashes and lengths (see the module queries)."""
    rows = examples.select("conv_id", "example", "formatted", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    whole = rows.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("last"), F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"), F.count("*").alias("n_examples"))
    whole = whole.select("conv_id", "formatted_chars", "n_examples", read_turns(F.col("last")).alias("turns"),
                         F.concat_ws("", F.transform("losses", lambda x: x["loss"])).alias("loss"))
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return whole.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples")
