"""Chat formatting by prefix-target expansion. DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are its context, and only that reply is
trainable. Each turn is rendered as ``<|im_start|>role``, a line break, the text and ``<|im_end|>``; inside texts
``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (in roles a line break becomes ``&#10;``), so that no text can
hold a control string and reading back is exact. A conversation that does not end with an assistant turn also gives
one example without loss, which holds all turns, so that no turn is lost.

The conversation is the unit: its turns are gathered in one row, and by the method its examples take space with the
square of its turns.

Defined cases: a null text or role counts as empty; turns are ordered by turn, nulls first, ties by role, then text;
repeated rows are repeated turns; the null conversation id is one conversation; texts are kept whole,
whatever their length; an empty table gives no examples.
Columns beyond the four named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _role_out(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def chat_examples(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """One row an example: id, example_no, n_turns, formatted, loss_start and loss_chars.

    ``formatted`` is the whole training text; the ``loss_chars`` code points from ``loss_start`` (from 0) are trainable.
    """
    role, text = (F.coalesce(turns[c], F.lit("")) for c in (role_col, text_col))
    told = turns.select(turns[id_col].alias("id"), F.struct(
        turns[turn_col].alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    told = told.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    rendered = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), _role_out(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == TRAINED_ROLE).alias("trained")))
    told = told.select("id", rendered.alias("turns"))
    # The places of trained turns, and the last place if it isn't one.
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (
        F.element_at("turns", i)["trained"] | (i == F.size("turns"))))
    examples = told.select("id", "turns", F.posexplode(places).alias("example_no", "place"))
    target = F.element_at("turns", F.col("place"))
    context = F.array_join(F.transform(F.slice("turns", 1, F.col("place") - 1), lambda t: F.concat(
        t["head"], t["body"], F.lit(END))), "")
    examples = examples.select("id", "example_no", "place", F.concat(context, target["head"]).alias("before"),
                               target["body"].alias("body"), target["trained"].alias("trained"))
    return examples.select(
        F.col("id").alias(id_col), "example_no", F.col("place").cast("long").alias("n_turns"),
        F.concat("before", "body", F.lit(END)).alias("formatted"),
        F.length("before").cast("long").alias("loss_start"),
        F.when(F.col("trained"), F.length("body")).otherwise(0).cast("long").alias("loss_chars"))


def loss_text(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The trainable text of an example, as it was before escaping."""
    return unescape(F.substring(formatted, loss_start.cast("int") + 1, loss_chars.cast("int")))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    bodies = F.transform(parts, lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    return F.transform(bodies, lambda b: F.struct(
        _role_in(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substring(b, F.instr(b, "\n") + 1, F.length(b))).alias("text")))


def conversation_digest(examples: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation, what reading its examples back gives: turns, loss text and their digests."""
    last = F.max_by("formatted", "n_turns")
    losses = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example_no", loss_text(
        F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("loss")))), lambda e: e["loss"]), "")
    read = examples.groupBy(id_col).agg(
        read_turns(last).alias("turns"), losses.alias("loss"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"), F.count(F.lit(1)).alias("n_examples"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        id_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")
