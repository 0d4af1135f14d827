r"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and
its text alone is trainable. A turn is written as ``<|turn|>role\ntext<|end|>\n``. In roles
and texts a backslash goes before every backslash and before every ``|`` that follows
``<``, so a text never holds a mark; in roles a line break is written as ``\n``. Removing
the escapes gives the text back.

An example is ``context, target, tail``: the target is the escaped assistant text, from
which the trainable span follows; the tail closes the turn. A conversation that does not
end with an assistant turn has one more row, without target, so that the output holds every
turn. Contexts of a conversation are prefixes of one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import space

TURN = "<|turn|>"
END = "<|end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\\|(?<=<)\|", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # An escaped backslash is matched first, so that only an escape of its own is a line break.
    marked = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(marked)


def expand(turns: DataFrame) -> DataFrame:
    """``conv_id, example, context, target, tail`` from ``conv_id, turn, role, text``.

    ``example`` counts a conversation's turns up to the target. Null roles and texts count as
    empty; turns are ordered by ``turn`` (null first), then role, then text; rows without
    ``conv_id`` form one conversation. Other columns are ignored.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    heads = F.transform("turns", lambda t: F.concat(F.lit(TURN), escape_role(t["role"]), F.lit("\n")))
    texts = F.transform("turns", lambda t: escape(t["text"]))
    laid = convs.select(
        "conv_id", F.col("turns.role").alias("roles"), heads.alias("heads"), texts.alias("texts")
    ).withColumn("whole", F.array_join(F.transform(F.arrays_zip("heads", "texts"), lambda t: F.concat(t["heads"], t["texts"], F.lit(END))), ""))
    lengths = F.transform(F.arrays_zip("heads", "texts"), lambda t: F.length(t["heads"]) + F.length(t["texts"]) + len(END))
    ends = F.aggregate(
        lengths, F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))
    )
    placed = laid.withColumn("ends", ends)
    rows = placed.select(
        "conv_id", "whole", "ends", "heads", "texts", F.size("roles").alias("n"), F.posexplode("roles").alias("at", "role")
    ).filter((F.col("role") == ASSISTANT) | (F.col("at") == F.col("n") - 1))
    trained = F.col("role") == ASSISTANT
    start = F.col("ends")[F.col("at")] + F.length(F.col("heads")[F.col("at")])
    stop = F.when(trained, start).otherwise(F.length("whole"))
    return rows.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        F.expr("whole").substr(F.lit(1), stop).alias("context"),
        F.when(trained, F.col("texts")[F.col("at")]).alias("target"),
        F.when(trained, F.lit(END)).otherwise(F.lit("")).alias("tail"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of each conversation, worked out from the formatted examples alone.

    Turns are parsed from the longest example; trainable text is every target, in order.
    """
    formatted = F.concat("context", F.coalesce("target", F.lit("")), "tail")
    convs = examples.groupBy("conv_id").agg(
        F.max_by(formatted, "example").alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("example", "target")))).alias("targets"),
        F.sum(F.length(formatted)).alias("formatted_chars"),
    )
    parts = F.slice(F.split("whole", r"<\|turn\|>"), 2, 2_000_000_000)
    turns = F.transform(
        parts,
        lambda p: F.concat(
            unescape_role(F.substring_index(p, "\n", 1)),
            F.lit("\n"),
            unescape(
                F.regexp_replace(F.regexp_replace(p, r"^[^\n]*\n", ""), r"<\|end\|>\n$", "")
            ),
            F.lit("\n"),
        ),
    )
    loss = F.array_join(F.transform("targets", lambda t: unescape(t["target"])), "")
    return convs.select(
        "conv_id",
        F.size(parts).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def write_examples(turns: DataFrame) -> DataFrame:
    """Format ``turns``, write the examples and return them as read from storage."""
    return space(turns.sparkSession, "chat").write(expand(turns), "examples")
