"""Chat formatting with Spark expressions only: rows by turn in, one training text a conversation out.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are
merged under one header, with a marker between them; the texts are joined. A text cannot hold a
marker: escaping doubles each backslash and puts one inside each control string, after its first
character, so that reading back is exact for every text. The loss mask is kept as runs of characters
to skip and to take, and takes what assistants say, without any marker.

Defined cases: a null text or role is empty; turns sort by number, then role, then text, so ties and
repeated rows are all kept in a fixed order, and a null turn comes first; rows without a ``conv_id``
are one conversation with a null id; an empty table gives no rows. Other columns are left aside. One
conversation is one value of the result, so it must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>"
LOSS_ROLE = "assistant"

#: First characters of control strings, each with what must follow: this template's own markers and
#: those of other common templates, which a tokenizer may know.
_CONTROL = r"<(?=\||/?s>)|\[(?=/?INST\])|<(?=<SYS>>|</SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({_CONTROL})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _once(value: Column) -> Column:
    """The value behind a generator, so that it is not worked out anew wherever it is named."""
    return F.explode(F.array(value))


def _merge(turns: Column) -> Column:
    """Adjacent turns of a role as one struct with its texts, already escaped.

    The places at which a role begins are found first; each group is then one slice.
    """
    size = F.size(turns)
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(size))
    return F.zip_with(
        starts,
        ends,
        lambda start, end: F.struct(
            F.get(turns, start)["role"].alias("role"),
            F.transform(F.slice(turns, start + 1, F.greatest(end - start, F.lit(0))), lambda t: t["text"]).alias("texts"),
        ),
    )


def _lengths(groups: Column) -> Column:
    """Per group: characters before its first text, of all of it, and whether it is under the mask."""

    def measured(group: Column) -> Column:
        head = len(START + TEXT) + F.char_length(group["role"])
        whole = head + F.char_length(F.array_join(group["texts"], NEXT)) + len(END)
        return F.struct(head.alias("head"), whole.alias("whole"), (group["role"] == LOSS_ROLE).alias("loss"))

    return F.transform(groups, measured)


def _loss_runs(groups: Column, lengths: Column) -> Column:
    """Characters to skip, then to take, for each text under the loss mask.

    Between two groups under the mask lie others; each of them is added up once, for the one after it.
    """
    places = F.when(F.size(groups) > 0, F.sequence(F.lit(0), F.size(groups) - 1)).otherwise(F.array().cast("array<int>"))
    masked = F.filter(places, lambda i: F.get(lengths, i)["loss"])
    before = F.slice(F.concat(F.array(F.lit(-1)), masked), F.lit(1), F.size(masked))

    def runs(at: Column, last: Column) -> Column:
        between = F.slice(lengths, last + 2, at - last - 1)
        skipped = F.aggregate(between, F.when(last >= 0, len(END)).otherwise(0), lambda total, n: total + n["whole"])
        return F.transform(
            F.get(groups, at)["texts"],
            lambda text, i: F.struct(
                F.when(i == 0, skipped + F.get(lengths, at)["head"]).otherwise(len(NEXT)).alias("skip"),
                F.char_length(text).alias("take"),
            ),
        )

    return F.flatten(F.zip_with(masked, before, runs))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Per conversation: ``formatted``, the training text, and ``loss``, the runs of its mask.

    One shuffle by conversation, of rows that are already escaped; everything else is expressions.
    """
    empty = F.lit("")
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        escape(F.coalesce(F.col("role").cast("string"), empty)).alias("role"),
        escape(F.coalesce(F.col("text").cast("string"), empty)).alias("text"),
    )
    turns = rows.select(F.col("conv_id").cast("long"), turn.alias("turn")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("turn")).alias("turns")
    )
    sorted_turns = turns.select("conv_id", _once(F.col("turns")).alias("turns"))
    groups = sorted_turns.select("conv_id", _once(_merge(F.col("turns"))).alias("groups"))
    merged = groups.select("*", _once(_lengths(F.col("groups"))).alias("lengths"))
    pieces = F.transform(
        "groups",
        lambda g: F.concat(F.lit(START), g["role"], F.lit(TEXT), F.array_join(g["texts"], NEXT), F.lit(END)),
    )
    return merged.select(
        "conv_id", F.array_join(pieces, "").alias("formatted"), _loss_runs(F.col("groups"), F.col("lengths")).alias("loss")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as structs of role and text."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        parts = F.split(F.substring(block, len(START) + 1, 2**31 - 1), r"<\|text\|>")
        return F.transform(
            F.split(parts[1], r"<\|next\|>"),
            lambda text: F.struct(unescape(parts[0]).alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    start = F.struct(formatted.alias("rest"), F.array().cast("array<string>").alias("texts"))

    def add(state: Column, run: Column) -> Column:
        """What is left after a run; each step looks at the run's characters only."""
        taken = unescape(F.substring(state["rest"], run["skip"] + 1, run["take"]))
        return F.struct(
            F.substring(state["rest"], run["skip"] + run["take"] + 1, F.lit(2**31 - 1)).alias("rest"),
            F.concat(state["texts"], F.array(taken)).alias("texts"),
        )

    return F.aggregate(loss, start, add, lambda state: state["texts"])


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what can be read back from formatted conversations."""
    read = formatted.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("taken"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("taken").cast("long").alias("loss_chars"),
        F.sha2("taken", 256).alias("loss_sha256"),
        "formatted_chars",
    )
