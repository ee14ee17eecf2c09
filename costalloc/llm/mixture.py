"""Mixing sources to target weights by repeating documents. DataFrame functions only.

Documents are measured in words. Each source gets a share of all words by its weight, up to a bound on how often it may
be repeated; a document is taken as often as the whole part of its source's rate says, and once more with the
probability of the rest, by a hash of the document. So a rerun, on any cluster, takes the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costalloc.llm.common import materialize

CYCLE = (5, 2, 1)
MOST = 3
SEED = 11
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """sources with a column `weight`: the numbers of the cycle in turn, sources in the order of their code points, null last.

    Ranks are counted within ranges of names and shifted by the number of names in the ranges before, so no task sees
    more names than one range has.
    """
    named = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id())
    named = materialize(named, "sources")
    sizes = named.groupBy("range").agg(F.count("*").alias("n"))  # at most as many rows as shuffle partitions
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    placed = named.withColumn("place", F.row_number().over(within)).join(shift, "range")
    turn = F.pmod(F.col("place") + F.col("shift") - 1, F.lit(len(cycle))).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), turn + 1)
    return placed.withColumn("weight", weight.cast("bigint")).drop("range", "place", "shift")


def targets(sources: DataFrame, most: float = MOST) -> DataFrame:
    """(source, source_size, target): how many words the mix wants of each source.

    sources: source, source_size, weight. All targets together are all sizes together. Shares are by weight, but end at
    `most` times the source's size; what is cut off goes to the others by weight, again and again, until no target is
    above its bound. Each such round is one aggregate that gives the driver a row. A source without weight gets nothing.
    """
    sources = materialize(sources, "weights")
    bound, share = F.col("source_size") * F.lit(float(most)), F.col("weight").cast("double")
    total = float(sources.where("weight > 0").agg(F.sum("source_size")).first()[0] or 0)
    level, n_full = 0.0, -1  # words per unit of weight
    while True:
        full = bound < share * F.lit(level)
        now = sources.where("weight > 0").agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, bound)), F.lit(0.0)).alias("words"),
            F.coalesce(F.sum(F.when(~full, share)), F.lit(0.0)).alias("weight"),
        ).first()
        if now.n == n_full or not now.weight:
            break
        n_full, level = now.n, (total - now.words) / now.weight
    wanted = F.when(F.col("weight") > 0, F.least(bound, share * F.lit(level))).otherwise(0.0)
    return sources.select("source", "source_size", wanted.alias("target"))


def chance(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that hangs on the values of the columns alone; null and empty count as equal."""
    key = F.concat(F.lit(f"{seed}"), *[F.concat(F.lit(":"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rated(docs: DataFrame, weights: DataFrame | None = None, most: float = MOST, seed: int = SEED) -> DataFrame:
    """(row, size, source_size, target, copies): every document, and how often the mix takes it.

    docs: doc_id, text, source and any other columns, all of them in the struct `row`. weights: (source, weight), or the
    cycle of weights where none are given; a source that it lacks is not taken. A null or empty text has size 0. Sources of size 0 are
    taken 0 times. Null is a source of its own, the empty string another. Rows alike in doc_id and text share their
    draw, so repeated rows are all taken equally often; null ids are told apart by their texts. An empty table gives
    no rows. Sizes are added up before they are shuffled, and the rates, one row a source, come to the documents by a
    join that adaptive execution broadcasts only by measured size and otherwise splits at a large source.
    """
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), n_words("text").alias("size"))
    sizes = sized.groupBy(F.col("row.source").alias("source")).agg(F.sum("size").alias("source_size"))
    if weights is None:
        weighed = cycled_weights(sizes)
    else:
        given = weights.select(F.col("source").alias("_source"), F.col("weight").cast("bigint").alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    wanted = materialize(targets(weighed, most), "targets")
    joined = sized.join(wanted, F.col("row.source").eqNullSafe(F.col("source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    once_more = chance(seed, "row.doc_id", "row.text") < rate - F.floor(rate)
    copies = F.floor(rate) + F.when(once_more, 1).otherwise(0)
    return joined.select("row", "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def mix(docs: DataFrame, weights: DataFrame | None = None, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mixed documents: each row of docs as often as `rated` says, numbered from 1 in the column `copy`.

    A column of docs of that name gives way. Documents that are taken 0 times are absent.
    """
    taken = rated(docs, weights, most, seed).where("copies > 0")
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "copy"]
    return taken.select(*kept, F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
