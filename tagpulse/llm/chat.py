r"""Chat formatting by prefix-target expansion, on DataFrame functions only.

A turn is rendered as ``### role: text</turn>`` and a newline. Inside texts and roles a backslash becomes two,
``#`` becomes ``\#``, ``</`` becomes ``<\/``, and in roles ``: `` becomes ``:\ ``; so no control string can occur in
them, and dropping each backslash but keeping what follows it gives the original back.

Every assistant turn is an example of its own: all turns before it are context, only its text is trainable.
All examples of a conversation are prefixes of one rendered string, so they are kept as that string and a list of
offsets (linear in its turns) and expanded by ``expand_examples``.

Defined cases: null text or role is empty; turns are ordered by (turn, role, text), nulls first, repeated rows all
kept; rows with a null conv_id form one conversation; conversations without an assistant have no example; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

START, COLON, END = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("#"), F.lit("\\#")), F.lit("</"), F.lit("<\\/"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, target_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, targets): the loss mask, (start, end) of each trainable text in 0-based code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit(": "), F.lit(":\\ ")), F.lit(COLON))
    parts = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), escape(text).alias("body"))
    rendered = F.concat("head", "body", F.lit(END))
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = F.sum(F.length(rendered)).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.select("conv_id", F.row_number().over(ordered).alias("n"), rendered.alias("rendered"), upto.alias("upto"), "role", "head", "body")
    end = F.col("upto") - len(END)
    target = F.when(F.col("role") == target_role, F.struct((end - F.length("body")).alias("start"), end.alias("end")))
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "rendered"))).alias("t"), F.array_sort(F.collect_list(target)).alias("targets"))
    return grouped.select("conv_id", F.array_join(F.col("t.rendered"), "").alias("formatted"), "targets")


def expand_examples(formatted: DataFrame) -> DataFrame:
    """A row for each trainable turn: conv_id, example, context (all turns before it and its header), target, loss_start, loss_end.

    target and context are cut from the formatted string by the mask, escaped as they stand there.
    """
    each = formatted.select("conv_id", "formatted", F.posexplode("targets").alias("example", "t")).select("conv_id", "formatted", "example", "t.*")
    return each.select("conv_id", "example", cut(F.lit(0), F.col("start")).alias("context"), cut(F.col("start"), F.col("end")).alias("target"), F.col("start").alias("loss_start"), F.col("end").alias("loss_end"))


def cut(start: Column, end: Column) -> Column:
    return F.col("formatted").substr((start + 1).cast("int"), (end - start).cast("int"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string, as an array of (role, text)."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")

    def one(p: Column) -> Column:
        at = F.instr(p, F.lit(COLON))
        return F.struct(
            unescape(F.substring(p, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"),
            unescape(F.substring(p, at + len(COLON), F.length(p))).alias("text"),
        )

    return F.transform(pieces, one)


def op6_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), hard.alias("text"))
    done = format_conversations(rows.unionByName(own))
    read = done.withColumn("turns", read_turns(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    turns = read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
    examples = expand_examples(done).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("example", "target"))).alias("e"))
    trained = F.array_join(F.transform("e.target", unescape), "")
    loss = examples.select(F.col("conv_id").alias("_conv"), F.length(trained).cast("long").alias("n"), F.sha2(trained, 256).alias("h"))
    both = turns.join(loss, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return both.select("conv_id", "n_turns", "turns_sha256", F.coalesce("n", F.lit(0)).cast("long").alias("loss_chars"), F.coalesce("h", F.sha2(F.lit(""), 256)).alias("loss_sha256"), "formatted_chars")


OP6_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(14 + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/'))
             + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/'), ': ', ':\ ')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
