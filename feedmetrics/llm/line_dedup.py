"""Line dedup by suffix ranks over line-id sequences; DataFrame functions only.

Every line gets an id (the rank of its hash among the lines that occur twice or more; a line
that occurs once can be in no repeated run). Prefix doubling gives the rank of every suffix by
its first 1, 2, 4, ... lines: the rank by 2k lines sorts the pairs (rank by k lines here, rank
by k lines k further on), and suffixes whose rank is unique drop out. Ranks come from a
distributed sort of the distinct pairs. Suffixes that share their first m lines are an interval
of the suffix array with a longest common prefix of at least m; for any m, two overlapping
power-of-two ranks name that interval.

A run of lines with at least ``min_words`` words is deleted where the same run begins earlier
(by document id, then line). Not every repeated run has to be tested: from each line the
shortest run with enough words, and to each line likewise. Any longer repeated run is the union
of such runs inside it: a line with enough words from the run's first line up to it is in the
shortest run that ends with it; any other is in the shortest run from the run's first line. Each
of these begins at the same distance in the earlier copy. So deleting the shortest runs that
occur earlier deletes exactly the later copies of all maximal runs.

Every step keys its rows by document and line or by rank, never by a group that one task must
hold: class minima are partial aggregations, and the joins back are plain joins of saved
tables, which Spark splits where one line is very common. Windows run within one document.

Defined cases: lines are split at line feeds and compared exactly; an empty line is a line
without words; a null text has no lines and stays null; rows that repeat both id and text are
one document and are treated alike; a null id comes first; a document may have any number of
lines; an empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmetrics.llm.common import saved

KEY = ["k1", "k2"]
#: Characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
WORDS = r"[^\x20\x09-\x0D]+"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a 128-bit key of id and text (columns k1, k2)."""
    parts = F.col(id_col).isNull(), F.col(id_col), F.col(text_col)
    return docs.withColumn("k1", F.xxhash64(F.lit(1), *parts)).withColumn("k2", F.xxhash64(F.lit(2), *parts))


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line of each document: key, id, line number i, line hash (a, b), words w."""
    rows = keyed(docs.select(id_col, text_col), id_col, text_col).where(F.col(text_col).isNotNull())
    rows = rows.select("k1", "k2", F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "\n", -1)).alias("i", "line"))
    return rows.select(*KEY, "id", "i", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(7), "line").alias("b"),
                       F.regexp_count("line", F.lit(WORDS)).cast("long").alias("w"))


def ranked(keys: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """The rows sorted by ``columns``, with a rank: ascending, not dense; saved, so it is fixed."""
    return saved(keys.orderBy(*columns).withColumn("rank", F.monotonically_increasing_id()), kind)


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The lines that occur twice or more, with the rank of their id, each place once (saved).

    Rows that repeat both id and text give the same places; made distinct here, they take a
    shuffle of the repeated lines only, not of the texts."""
    twice = lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b")
    ids = ranked(twice, ["a", "b"], "line-ids")
    return saved(lines.join(ids, ["a", "b"]).select(*KEY, "id", "i", "w", "rank").distinct(), "repeated-lines")


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """Key, id, first line s and number of lines m of the shortest runs of repeated lines with
    at least ``min_words`` words, from each line and to each line (saved)."""
    doc = Window.partitionBy(*KEY).orderBy("i")
    rows = lines.withColumn("island", F.col("i") - F.row_number().over(doc))
    own = Window.partitionBy(*KEY, "island")
    upto = own.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Words up to and with a line, and before it.
    rows = rows.withColumn("upto", F.sum("w").over(upto)).withColumn("before", F.col("upto") - F.col("w"))
    rows = rows.withColumn("total", F.sum("w").over(own)).withColumn("final", F.max("i").over(own)).withColumn("begin", F.min("i").over(own))
    # The first later line before which there are enough words; frames grow, so one pass each.
    after = own.orderBy(F.col("before").desc()).rangeBetween(Window.unboundedPreceding, -min_words)
    earlier = own.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    rows = rows.withColumn("next", F.min("i").over(after)).withColumn("prior", F.max("i").over(earlier))
    end = F.when(F.col("next").isNotNull(), F.col("next") - 1).when(F.col("total") - F.col("before") >= min_words, F.col("final"))
    first = F.when(F.col("prior").isNotNull(), F.col("prior") + 1).when(F.col("upto") >= min_words, F.col("begin"))
    onward = rows.select(*KEY, "id", F.col("i").alias("s"), (end - F.col("i") + 1).alias("m"))
    back = rows.select(*KEY, "id", first.alias("s"), (F.col("i") - first + 1).alias("m"))
    runs = saved(onward.unionByName(back).where("m is not null and s is not null"), "runs-all")
    return runs.distinct()


def doubled(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks by twice ``step`` lines from ranks by ``step`` lines; suffixes without a like drop out (saved)."""
    ahead = ranks.select(*KEY, (F.col("i") - step).alias("i"), F.col("rank").alias("next"))
    pairs = saved(ranks.join(ahead, [*KEY, "i"]), "rank-pairs")
    twice = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("rank").alias("r"), "next")
    order = ranked(twice, ["r", "next"], "rank-order").select(F.col("r"), F.col("next").alias("x"), F.col("rank").alias("new"))
    both = pairs.join(order, (pairs["rank"] == order["r"]) & (pairs["next"] == order["x"]))
    return saved(both.select(*KEY, "i", F.col("new").alias("rank")), "ranks")


def later_runs(lines: DataFrame, runs: DataFrame) -> DataFrame:
    """Key, first line s and number of lines m of the runs that begin earlier as well."""
    runs = saved(runs, "runs")
    longest = runs.agg(F.max("m")).first()[0] or 0
    ranks, step, named = lines.select(*KEY, "i", "rank"), 1, []
    while step <= longest:
        mine = runs.where(f"m >= {step} and m < {2 * step}").withColumn("t", F.col("s") + F.col("m") - step)
        head = ranks.select(*KEY, F.col("i").alias("s"), F.col("rank").alias("head"))
        tail = ranks.select(*KEY, F.col("i").alias("t"), F.col("rank").alias("tail"))
        named.append(mine.join(head, [*KEY, "s"]).join(tail, [*KEY, "t"]).select(*KEY, "id", "s", "m", "head", "tail"))
        step *= 2
        if step <= longest:
            ranks = doubled(ranks, step // 2)
            if ranks.isEmpty():
                break
    if not named:
        return runs.select(*KEY, "s", "m").limit(0)
    rows = saved(reduce(DataFrame.unionByName, named), "named-runs")
    place = F.struct("id", "k1", "k2", "s")
    first = saved(rows.groupBy("m", "head", "tail").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first-runs")
    return rows.join(first, ["m", "head", "tail"]).where(F.col("first") < place).select(*KEY, "s", "m")


def deleted_lines(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Per document with deletions: key and the numbers of its deleted lines (saved)."""
    lines = repeated_lines(saved(lines_of(docs, id_col, text_col), "lines"))
    runs = later_runs(lines, shortest_runs(lines, min_words))
    reach = runs.groupBy(*KEY, F.col("s").alias("i")).agg(F.max(F.col("s") + F.col("m")).alias("end"))
    upto = Window.partitionBy(*KEY).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = lines.select(*KEY, "i").join(reach, [*KEY, "i"], "left").withColumn("end", F.max("end").over(upto)).where("i < end")
    return saved(covered.groupBy(*KEY).agg(F.collect_list("i").alias("gone")), "deleted-lines")


def delete_repeats(docs: DataFrame, *, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the later copies of repeated runs of lines: its columns (``text_col``
    changed, null where no line is left) and n_lines, n_deleted."""
    gone = deleted_lines(docs, id_col, text_col, min_words)
    columns = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    # Always a merge join: what is deleted grows with the documents.
    rows = keyed(docs.select(*columns), id_col, text_col).join(gone.hint("merge"), KEY, "left")
    lines = F.split(text_col, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col(text_col)).when(F.size(left) > 0, F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return rows.select(*[text.alias(c) if c == text_col else F.col(c) for c in columns],
                       F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"))
