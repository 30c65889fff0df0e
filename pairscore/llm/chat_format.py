"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every turn is rendered once, ``<s>[role]\\n`` + escaped text + ``</s>\\n``, and the turns of a conversation are joined
in order. Every assistant turn then becomes an example of its own: the prefix of the rendered conversation up to the
end of that reply, of which only the reply is trainable. What is stored of a conversation is the rendered text and the examples' spans, so it
grows with the conversation and not with its square; ``examples`` builds the examples from them, row by row.

Escaping is reversible: ``~ < [`` in a text become ``~0 ~1 ~2`` (in a role ``]`` and line ends too), so no control
string, of this template or of another with marks in such brackets, can stand in a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_TEXT = (("~", "~0"), ("<", "~1"), ("[", "~2"))
_ROLE = _TEXT + (("]", "~3"), ("\n", "~4"))
_END = "</s>\n"


def escape(text: Column, role: bool = False) -> Column:
    for plain, coded in _ROLE if role else _TEXT:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for plain, coded in reversed(_ROLE if role else _TEXT):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_conversations(rows: DataFrame, target_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, targets``: the rendered conversation and, for each turn of ``target_role`` in order, a
    struct (turn_no, start, length, end) of 0-based code-point offsets: the reply is ``length`` characters from
    ``start``, its example is the first ``end`` characters.

    Turns are ordered by ``turn`` (null first), then role and text, so repeated rows and ties have a fixed order and
    each stays. Null role and text count as empty; rows with a null conv_id form one conversation. Other columns are
    ignored; an empty table gives an empty result. A conversation is rendered as one value, hence one row must hold it.
    """
    made = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit("<s>["), escape(F.col("role"), True), F.lit("]\n"))
    parts = made.select("*", (F.col("role") == target_role).alias("is_target"), escape(F.col("text")).alias("body"), head.alias("head"))
    # a turn's end is a running sum, by a window over the turns: linear in the conversation, and sorted on disk if need be
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.length("head") + F.length("body") + len(_END)
    placed = parts.withColumn("turn_no", F.row_number().over(order) - 1).withColumn("end", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.struct("is_target", "turn_no", (F.col("end") - F.length("body") - len(_END)).alias("start"), F.length("body").cast("long").alias("length"), "end")
    turn = F.struct("turn_no", F.concat("head", "body", F.lit(_END)).alias("part"), target.alias("target"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select("conv_id", F.array_join("turns.part", "").alias("formatted"), F.filter("turns.target", lambda x: x["is_target"]).alias("targets"))


def examples(formatted: DataFrame, with_text: bool = True) -> DataFrame:
    """The expansion: one row per target turn, ``conv_id, example_no, turn_no, start, length, end`` and the example's whole
    ``text``: all turns before it as context, and the reply, of which only the ``length`` characters from ``start`` are
    trainable. Without ``with_text`` the spans only, whose size is linear in the conversation."""
    one = formatted.select("conv_id", "formatted", F.posexplode("targets").alias("example_no", "t"))
    cols = ["conv_id", "example_no", "t.turn_no", "t.start", "t.length", "t.end"]
    return one.select(*cols, *([F.substring("formatted", F.lit(1), F.col("t.end").cast("int")).alias("text")] if with_text else []))


def reply(text: Column, start: Column, length: Column) -> Column:
    """What the loss mask of an example covers, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), length.cast("int")))


def read_turns(formatted: Column) -> Column:
    """The turns back from a formatted conversation: array of (role, text), unescaped."""
    marks = F.filter(F.split(formatted, r"<s>\["), lambda x: x != "")
    body = lambda x: F.substring(x, F.instr(x, "]\n") + 2, F.length(x))
    return F.transform(marks, lambda x: F.struct(unescape(F.substring_index(x, "]\n", 1), True).alias("role"), unescape(F.substring_index(body(x), "</s>", 1)).alias("text")))
