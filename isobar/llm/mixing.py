"""Mixing sources to target weights by Efraimidis-Spirakis sampling (native).

Every document draws one exponential key, -ln(u) / w, with u a uniform draw
hashed from the row and w its quality weight; smaller keys come first.  A
source that must give T words out of S gives floor(T / S) complete epochs
first, then its documents in key order until their summed sizes reach the rest
of the budget.

The order within a source is never built as one sorted group: sizes are summed
per (source, key bin), a prefix sum over the bins finds the one bin in which
the budget ends, and only that bin's documents are sorted.  This gives one
threshold key per source, and a document is chosen if its key is at or below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import SPACE_WORD, bounded, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MAX_EPOCHS = 3
#: Key bins per source; a bin's documents are what one task sorts.
BINS = 4096
SEED = 20240229


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for plain prose, lower for texts full of shouting, bars and filler signs; at least 1/16."""
    junk = sum((F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))
                for s in ("!!", "|", "&&&", "###", "$$$", "%%%", "***")), F.lit(0))
    return F.coalesce(1 / (1 + 15 * junk / F.greatest(F.length(text), F.lit(1))), F.lit(1.0))


def drawn(quality: Column | None = None, seed: int = SEED) -> Column:
    """The key of a row; it hashes the row, so reruns agree."""
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text"))
    u = (draw.bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / (quality_weight(F.col("text")) if quality is None else quality)


def key_bin(key: Column, bins: int) -> Column:
    """key / (1 + key) maps the keys onto [0, 1) in order."""
    return F.least(F.floor(key / (1 + key) * bins), F.lit(bins - 1))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target words per source; ``sizes`` has one row (source, source_size) per source.

    Targets are min(max_epochs * size, x * weight) with the one x that makes
    them sum to all sizes: what resharing the excess by weight arrives at.
    The windows without partition run over one row per source.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("cap")
    ranked = (sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(max_epochs))
              .withColumn("room", cap / F.col("weight")))
    # x if all sources before this one (by room) are capped and the others not
    x = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the first source (by room) that x leaves uncapped settles x
    level = F.min(F.when(F.col("x") <= F.col("room"), F.struct("turn", "x"))).over(every)["x"]
    return (ranked.withColumn("x", x).withColumn("turn", F.row_number().over(by_room)).withColumn("level", level)
            .select("source", "source_size",
                    F.when(F.col("level").isNull(), cap).otherwise(F.least(cap, F.col("level") * F.col("weight"))).alias("target")))


def source_plan(slim: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                bins: int = BINS) -> DataFrame:
    """One row per source: s, source_size, target, epochs, end_bin and cut.

    ``slim`` is a written table of source, size and key.  A row is chosen for
    the fractional epoch if its bin is below end_bin, or equals it and its key
    is at most cut.
    """
    slim = slim.withColumn("bin", key_bin(F.col("key"), bins))
    hist = written(slim.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")), "mix-bins")
    targets = source_targets(hist.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, max_epochs)
    n = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
    plan = (targets.withColumn("epochs", n.cast("long"))
            .withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))))

    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("cum", F.sum("bin_size").over(upto)).withColumnRenamed("source", "s")
    # the bin in which the budget ends, and what the bins before it hold; the
    # rest is less than the source, so there is one unless the source has no words
    end = (plan.join(cum, F.col("source").eqNullSafe(F.col("s")))
           .where(F.col("cum") > F.col("rest"))
           .groupBy("source").agg(F.min_by(F.struct("bin", (F.col("cum") - F.col("bin_size")).alias("before")), "bin").alias("e"))
           .select(F.col("source").alias("s"), F.col("e.bin").alias("end_bin"), F.col("e.before").alias("before")))
    plan = written(plan.join(end, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-plan")

    ends = plan.select(F.col("source").alias("s"), "end_bin", "before", "rest")
    last = (slim.join(bounded(ends, _row_bytes()), F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("end_bin")))
            .groupBy("s", "key", "before", "rest").agg(F.sum("size").alias("size")))
    run = F.sum("size").over(Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = (last.withColumn("run", F.col("before") + run)
           .where(F.col("run") - F.col("size") / 2 <= F.col("rest"))
           .groupBy("s").agg(F.max("key").alias("cut")))
    return written(plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
                   .select(F.col("source").alias("s"), "source_size", "target", "epochs", "end_bin", "cut"), "mix-cuts")


def _row_bytes() -> Column:
    """Size of a plan row, given its source s."""
    return F.coalesce(F.octet_length("s"), F.lit(0)) + 64


def _chosen(key: Column, bins: int) -> Column:
    at = key_bin(key, bins)
    return F.coalesce((at < F.col("end_bin")) | ((at == F.col("end_bin")) & (key <= F.col("cut"))), F.lit(False))


def _sized(docs: DataFrame, quality: Column | None, seed: int) -> DataFrame:
    return written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                               drawn(quality, seed).alias("key")), "mix-sizes")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        quality: Column | None = None, bins: int = BINS, seed: int = SEED) -> DataFrame:
    """One row per document with the words the mix takes of it.

    Returns doc_id, source, size, source_size, target, epochs (complete ones),
    key, chosen (in the fractional epoch too), copies and taken.

    Null or empty text: size 0, nothing taken.  A null source is a source and
    comes last.  Rows that agree in id, source and text share one key and are
    chosen together.  An empty table gives an empty result.  Reruns agree: the
    draw hashes the row.  Taken words miss the target by at most about half of
    the document at which the budget ends.
    """
    slim = _sized(docs, quality, seed)
    plan = source_plan(slim, weights, max_epochs, bins)
    return (slim.join(bounded(plan, _row_bytes()), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("chosen", _chosen(F.col("key"), bins))
            .withColumn("copies", F.col("epochs") + F.col("chosen").cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "epochs", "key", "chosen", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
          quality: Column | None = None, bins: int = BINS, seed: int = SEED) -> DataFrame:
    """The mix itself: docs with each row as often as it is taken, docs' columns.

    Texts without words, of which nothing can be taken, leave.
    """
    plan = source_plan(_sized(docs, quality, seed), weights, max_epochs, bins)
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("of"), drawn(quality, seed).alias("key"),
                       (word_count(F.col("text")) > 0).alias("some"))
    return (rows.join(bounded(plan, _row_bytes()), F.col("of").eqNullSafe(F.col("s")))
            .withColumn("copies", F.when(F.col("some"), F.col("epochs") + _chosen(F.col("key"), bins).cast("long")).otherwise(0))
            .where(F.col("copies") > 0)
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("row.*"))
