"""Chat logs: keep the longest snapshot of each conversation, and render it. DataFrame functions only.

A conversation is often logged after every turn, so that one log is a prefix of another. Each turn gets a rolling hash
of all turns up to it; the hash of a whole conversation that also stands inside a longer one marks a snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROLE_START, ROLE_END, TURN_END = "<|im_start|>", "\n", "<|im_end|>\n"
MARKS = ["<|im_start|>", "<|im_end|>"]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, h1, h2): 128 hash bits of the turns up to each place, counted from 1.

    The exclusive or of hashes that hold the place, role and text of a turn: it can be rolled on by one turn, and
    another order, role or text gives another value. Only hashes are shuffled and sorted, no texts.
    """
    turn = turns.select("conv_id", "turn", *[F.xxhash64(F.lit(k), "role", "text").alias(f"t{k}") for k in (1, 2)])
    order = Window.partitionBy("conv_id").orderBy("turn", "t1", "t2")
    placed = turn.select("conv_id", "turn", "t1", "t2", F.row_number().over(order).alias("place"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = [F.bit_xor(F.xxhash64(F.lit(k), "place", f"t{k}")).over(so_far).alias(f"h{k}") for k in (1, 2)]
    ordered = placed.withColumn("place", F.col("place").cast("bigint"))
    return ordered.select("conv_id", "place", *rolled)


def distinct_turns(conversations: DataFrame) -> DataFrame:
    """Turns with a conversation, without repeated rows; a null role or text becomes empty."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.distinct()


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that are no prefix of a longer one.

    Of equal conversations the smallest conv_id stands for all n_copies. Prefixes are made distinct before the
    anti-join, so a first turn that opens a third of all conversations is one row there.
    """
    prefixes = prefix_hashes(turns)
    last = Window.partitionBy("conv_id")
    marked = prefixes.withColumn("n_turns", F.max("place").over(last))
    key = ["place", "h1", "h2"]
    whole = marked.where("place = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inside = marked.where("place < n_turns").select(*key).distinct()
    return whole.join(inside, key, "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_copies")


def escaped(value: Column) -> Column:
    """A role or text in which a mark that stands there is told from a real one by a backslash after its <."""
    for mark in MARKS:
        value = F.replace(value, F.lit(mark), F.lit(mark.replace("<", "<\\", 1)))
    return value


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, text): each conversation's turns in order, with role and turn marks; no text can forge a turn."""
    role, said = escaped(F.translate("role", "\n", " ")), escaped(F.col("text"))
    one: Column = F.concat(F.lit(ROLE_START), role, F.lit(ROLE_END), said, F.lit(TURN_END))
    told = turns.select("conv_id", "turn", F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2"), one.alias("told"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "t1", "t2", "told")))
    return told.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda x: x["told"]), "").alias("text"))


def collapse_and_render(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, text) for every maximal conversation.

    conversations: conv_id, turn, role, text. Turns are taken in the order of `turn` (null first; turns with one
    number in the order of their hash); gaps in the numbers don't matter. Repeated rows count once, null roles and
    texts are empty, rows without conv_id belong to no conversation and go. Marks inside a text get a backslash, line
    ends inside a role become spaces. Other columns are ignored. The rendered
    text of one conversation is one value, so its turns meet in one task; snapshots go before that.
    """
    turns = distinct_turns(conversations)
    kept = maximal(turns)
    told = render(turns.join(kept.select("conv_id"), "conv_id", "left_semi"))
    return kept.join(told, "conv_id")
