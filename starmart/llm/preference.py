"""Preference pairs: the common turns of two conversations rendered once as a prompt, the rest as masked completions.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is rendered.
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"
LEARNED_ROLE = "assistant"


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns array<struct<role, text>>) in order of turn, ties by role and text.

    Null roles and texts are empty; repeated rows are repeated turns; rows without a conv_id belong to no conversation.
    A conversation becomes one cell, as any rendered form of it does.
    """
    row = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    grouped = turns.where(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id")).agg(F.collect_list(row).alias("all"))
    return grouped.select("conv_id", F.expr("transform(array_sort(all), t -> struct(t.role AS role, t.text AS text))").alias("turns"))


def stale_replies(held: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen, rejected) from single conversations with two or more replies.

    Chosen is the conversation up to its last reply; in rejected, that reply is the one given before it.
    Conversations with fewer replies give no pair, and turns after the last reply are left out. Both sides share all
    turns before the last reply, so their completions are that one turn each, or empty where the replies are equal.
    """
    replies = F.expr(f"filter(sequence(0, size(turns) - 1), i -> turns[i].role = '{LEARNED_ROLE}')")
    known = held.where(F.size("turns") > 0).withColumn("replies", replies).where(F.size("replies") >= 2)
    known = known.withColumns({"last": F.expr("replies[size(replies) - 1]"), "before": F.expr("replies[size(replies) - 2]")})
    return known.select(
        F.col("conv_id").alias("pair_id"),
        F.expr("slice(turns, 1, last + 1)").alias("chosen"),
        F.expr("concat(slice(turns, 1, last), array(turns[before]))").alias("rejected"),
    )


def rendered(turns: str) -> Column:
    return F.expr(
        f"array_join(transform({turns}, t -> concat('{OPEN}', t.role, '{AFTER_ROLE}', t.text, '{CLOSE}')), '')".replace("\n", "\\n")
    )


def learned(turns: str) -> Column:
    """[from, to) spans, in characters of the rendered turns, that a loss covers: replies with their closing mark."""
    size = f"length(t.role) + length(t.text) + {len(OPEN) + len(AFTER_ROLE) + len(CLOSE)}"
    ends = f"""transform({turns}, (t, i) -> struct(t.role AS role, t.text AS text, CAST(aggregate(
      slice({turns}, 1, i + 1), 0L, (a, t) -> a + {size}) AS BIGINT) AS until))"""
    return F.expr(
        f"""transform(filter({ends}, t -> t.role = '{LEARNED_ROLE}'),
          t -> struct(t.until - length(t.text) - {len(CLOSE)} AS from, t.until AS to))"""
    )


def preference_rows(pairs: DataFrame) -> DataFrame:
    """`pairs` (pair_id, chosen, rejected: arrays of turns) as training rows.

    n_prompt is the number of leading turns that both share, role and text alike; `prompt` renders them once.
    `chosen` and `rejected` render what follows, empty where nothing does; chosen_learned and rejected_learned are
    their loss spans, so that other roles' turns in a completion are masked. Null arrays count as empty.
    """
    empty = "CAST(array() AS array<struct<role: string, text: string>>)"
    both = pairs.select(
        "pair_id", F.expr(f"coalesce(chosen, {empty})").alias("c"), F.expr(f"coalesce(rejected, {empty})").alias("r")
    )
    shorter = "least(size(c), size(r))"
    differ = f"CASE WHEN {shorter} > 0 THEN array_min(filter(sequence(0, {shorter} - 1), i -> c[i] <> r[i])) END"
    cut = both.withColumn("n_prompt", F.expr(f"coalesce({differ}, {shorter})"))
    parts = cut.withColumns(
        {
            "p": F.expr("slice(c, 1, n_prompt)"),
            "cc": F.expr("slice(c, n_prompt + 1, size(c))"),
            "rc": F.expr("slice(r, n_prompt + 1, size(r))"),
        }
    )
    return parts.select(
        "pair_id",
        F.col("n_prompt").cast("long").alias("n_prompt"),
        rendered("p").alias("prompt"),
        rendered("cc").alias("chosen"),
        rendered("rc").alias("rejected"),
        learned("cc").alias("chosen_learned"),
        learned("rc").alias("rejected_learned"),
    )
