"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation becomes one formatted stream. Each assistant turn is an example of its
own: the stream up to the end of that turn, with only the reply under the loss mask.
Since every example is a prefix of its conversation's stream, an example is kept as
(prefix length, reply start, reply length) beside the stream, so that what is shuffled
grows with the turns; :func:`explode_examples` writes each example's text out, and
:func:`read_back` reads these texts alone.

Template: ``<s>[INST] text [/INST]</s>`` for a user, ``<s>text</s>`` for an assistant,
``<s>[ROLE]role[/ROLE]text</s>`` for any other role. Inside texts and role names each
backslash is doubled and each control string gets a backslash after its first
character, so no control string survives in a text and :func:`unescape` restores it.

Defined cases: null or empty text and null role count as ''; a null conv_id is one
conversation; turns are ordered by (turn, role, text) with nulls first, so repeated
rows are repeated turns; turns after the last reply form a last example without a
trainable part; a conversation without a reply has that example only; other columns
are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, stream, examples (array of prefix_chars, loss_start, loss_chars).

    loss_start counts code points from 0. loss_chars is 0 in an example without a reply.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    body = escape(text)
    head = F.when(role == "user", "<s>[INST] ").when(role == "assistant", "<s>").otherwise(F.concat(F.lit("<s>[ROLE]"), escape(role), F.lit("[/ROLE]")))
    tail = F.when(role == "user", " [/INST]</s>").otherwise("</s>")
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    pieces = (
        turns.select("conv_id", "turn", "role", "text", (role == "assistant").alias("reply"), F.length(head).alias("head_chars"), F.length(body).alias("body_chars"), F.concat(head, body, tail).alias("piece"))
        .withColumn("at", F.row_number().over(order))
        .withColumn("prefix_chars", F.sum(F.length("piece")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    )
    start = F.col("prefix_chars") - F.length("piece") + F.col("head_chars")
    example = F.struct(F.col("prefix_chars").cast("long").alias("prefix_chars"), start.cast("long").alias("loss_start"), F.col("body_chars").cast("long").alias("loss_chars"))
    packed = pieces.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "").alias("stream"),
        F.array_sort(F.collect_list(F.when(F.col("reply"), example))).alias("examples"),
        F.max("prefix_chars").alias("all_chars"),
        F.max(F.when(F.col("reply"), F.col("prefix_chars"))).alias("reply_chars"),
    )
    rest = F.struct(F.col("all_chars").cast("long").alias("prefix_chars"), F.col("all_chars").cast("long").alias("loss_start"), F.lit(0).cast("long").alias("loss_chars"))
    trailing = F.coalesce(F.col("reply_chars"), F.lit(-1)) < F.col("all_chars")
    return packed.select("conv_id", "stream", F.when(trailing, F.concat("examples", F.array(rest))).otherwise(F.col("examples")).alias("examples"))


def explode_examples(formatted: DataFrame) -> DataFrame:
    """One row an example: conv_id, example, text, loss_start, loss_chars, last (of its conversation)."""
    rows = formatted.select("conv_id", "stream", F.size("examples").alias("n"), F.posexplode("examples").alias("example", "e"))
    return rows.select("conv_id", "example", F.expr("left(stream, cast(e.prefix_chars as int))").alias("text"), "e.loss_start", "e.loss_chars", (F.col("example") == F.col("n") - 1).alias("last"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and trainable text recovered from the exploded examples alone: turns from the last, which holds all."""
    pieces = F.filter(F.split("text", "</s>"), lambda x: x != "")
    user, other = "<s>[INST] ", "<s>[ROLE]"

    def turn(p: Column) -> Column:
        role = F.when(p.startswith(user), "user").when(p.startswith(other), F.regexp_extract(p, r"(?s)^<s>\[ROLE\](.*?)\[/ROLE\]", 1)).otherwise("assistant")
        text = (
            F.when(p.startswith(user), F.regexp_extract(p, r"(?s)^<s>\[INST\] (.*) \[/INST\]$", 1))
            .when(p.startswith(other), F.regexp_extract(p, r"(?s)^<s>\[ROLE\].*?\[/ROLE\](.*)$", 1))
            .otherwise(F.substring(p, 4, 2**31 - 1))
        )
        return F.concat(unescape(role), F.lit("\n"), unescape(text), F.lit("\n"))

    loss = unescape(F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")))
    # Each text is reduced in its own row, so that no aggregate holds texts of prefixes.
    found = explode_examples(formatted).select("conv_id", "example", loss.alias("loss"), F.length("text").cast("long").alias("chars"), F.when(F.col("last"), F.transform(pieces, turn)).alias("turns"))
    read = found.select("conv_id", "example", "loss", "chars", F.when(F.col("turns").isNotNull(), F.size("turns")).cast("long").alias("n_turns"), F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"))
    packed = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return packed.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
