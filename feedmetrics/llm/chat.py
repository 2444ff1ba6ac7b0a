"""Chat formatting after cumulative-snapshot collapse.

Logs often store a conversation again after every turn, so most logged conversations are
prefixes of longer ones. For every turn a window computes the hash of the turns up to it: the
running XOR of two independent 64-bit hashes of (position, role, text), which is the same for
equal turn prefixes. A conversation whose whole hash is a proper prefix hash of another one is
left out by an anti-join; of equal conversations the one with the smallest id stays. Both sides
of the anti-join are aggregated first, so each hash occurs once however often it was logged.
The conversations that stay are rendered.

The rows of one conversation become one row with its text, so they have to fit a row; there is
no such bound on how many conversations share turns.

Defined cases: turns are ordered by (turn, role, text), nulls first, and counted by position,
so gaps, ties and repeated turns are kept; a null role or text differs from an empty one when
compared and is rendered as empty; rows with a null conversation id form one conversation; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmetrics.llm.common import saved


def turn_hash(lane: int) -> Column:
    """Hash of a turn with its position; nulls differ from any value."""
    return F.xxhash64(F.lit(lane), "i", F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def prefixes(turns: DataFrame) -> DataFrame:
    """Per turn: conv_id, its position i, the hashes h1 and h2 of the turns up to it, last."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = turns.select("conv_id", "turn", "role", "text").withColumn("i", F.row_number().over(w))
    return (at.withColumn("a", turn_hash(1)).withColumn("b", turn_hash(2))
            .select("conv_id", "i", F.bit_xor("a").over(upto).alias("h1"), F.bit_xor("b").over(upto).alias("h2"),
                    F.lead("i").over(w).isNull().alias("last")))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id and n_turns of the conversations that no longer one continues (one of each equal group)."""
    p = saved(prefixes(turns), "turn-prefixes")
    whole = p.where("last").groupBy("i", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    begun = p.where("not last").select("i", "h1", "h2").distinct()
    return whole.join(begun, ["i", "h1", "h2"], "left_anti").select("conv_id", F.col("i").cast("long").alias("n_turns"))


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat template."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and the rendered text of every maximal conversation."""
    kept = saved(maximal(turns), "maximal-conversations")
    own = turns.select(F.col("conv_id").alias("c"), "turn", "role", "text")
    rows = own.join(kept, own["c"].eqNullSafe(kept["conv_id"]))
    turn = F.array_sort(F.collect_list(F.struct("turn", "role", "text")), order)
    return (rows.groupBy("conv_id", "n_turns").agg(turn.alias("t"))
            .select("conv_id", "n_turns", F.array_join(F.transform("t", lambda t: rendered(t["role"], t["text"])), "").alias("text")))


def order(a: Column, b: Column) -> Column:
    """Turn order, nulls first, as in the window."""
    def by(name: str, then: Column) -> Column:
        x, y = a[name], b[name]
        return (F.when(x.eqNullSafe(y), then).when(x.isNull(), -1).when(y.isNull(), 1).when(x < y, -1).otherwise(1))

    return by("turn", by("role", by("text", F.lit(0))))
