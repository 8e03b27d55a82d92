"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash. Words are summed by source and by the leading bits
of the hash; the bucket in which a source's budget runs out is refined by the
next bits, and only its rows are read again, until one hash value is left. A
document is then taken by comparing its hash with its source's threshold:
nothing is sorted. A target above its source's size takes every document once
and, with the same hashes nested inside, some a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, stage

#: weights of the sources in order, repeating; share of all words that is taken;
#: most copies of a source
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: bits of the hash that a refinement looks at, of 63
BITS, ALL_BITS = 12, 63
#: sources up to which their thresholds (a few numbers each) are broadcast
FEW_SOURCES = 10_000


def _order(column: str) -> list[Column]:
    return [F.col(column).isNull(), F.col(column)]


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` of ``sizes(source, source_size)``, one row a source.

    Sources weigh by their place in code point order, null last. A target is
    ``weight * level`` but at most ``most`` times its source's size; resharing
    the excess by weight until none is above ends at the one level for which
    the targets add up to ``share`` of all words.
    """
    every = Window.orderBy(*_order("source"))
    by_ratio = Window.orderBy("ratio", *_order("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.row_number().over(every) - 1) % len(weights) + 1)
    ranked = (sizes.withColumn("weight", weight)
              .withColumn("cap", most * F.col("source_size").cast("double"))
              .withColumn("ratio", F.col("cap") / F.col("weight"))
              .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
              .withColumn("heavy", F.sum("weight").over(Window.partitionBy()))
              .withColumn("level", (F.lit(share) * F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / (F.col("heavy") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(Window.partitionBy())
    return ranked.withColumn("at", first["level"]).select(
        "source", "source_size",
        F.when(F.col("ratio") <= F.col("at"), F.col("cap"))
        .otherwise(F.least("cap", F.col("weight") * F.col("at"))).alias("target"))


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, budget, edge, owed``: rows with ``h < edge`` are within the budget,
    and those with ``h = edge`` still get ``owed`` words."""
    done, low = 0, budgets.select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("owed"))
    inside = rows.where("size > 0")
    while done < ALL_BITS:
        step = min(BITS, ALL_BITS - done)
        shift = ALL_BITS - done - step
        inside = (inside.join(low.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
                  .where(F.expr(f"shiftright(h, {shift + step}) = prefix")).drop("s", "prefix", "owed"))
        hist = (inside.groupBy("source", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi")))
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        edges = (hist.withColumn("sofar", F.coalesce(F.sum("words").over(running), F.lit(0)))
                 .join(low.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
                 .where("sofar <= owed and owed < sofar + words")
                 .select("source", F.col("bucket").alias("prefix"), F.expr("owed - sofar").alias("owed"),
                         F.expr("lo < hi").alias("many")))
        low = stage(edges, "edges")
        done += step
        if not low.where("many").take(1):
            break
        low = low.drop("many")
    # the edge bucket now holds one hash value; sources without one take everything
    last = inside.select("source", "h").distinct().withColumnRenamed("source", "s")
    edge = (low.join(last, F.col("source").eqNullSafe(F.col("s")) & F.expr(f"shiftright(h, {ALL_BITS - done}) = prefix"))
            .groupBy("source").agg(F.min("h").alias("edge"), F.max("owed").alias("owed")))
    return stage(edge, "thresholds")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken``.

    ``taken`` counts the words the mix takes: a whole number of copies, but for
    the one document at a source's threshold, of which the words still owed are
    taken, so that a source meets its target to the word.

    Defined cases: null and empty texts have size 0 and give nothing; a null
    source is a source of its own, last in order; rows with the same id and text
    share a hash and fill what is owed in order of ``size``, each in turn;
    an empty table gives an empty result; columns of ``docs`` that carry one of
    the added names are replaced.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    sized = docs.select(
        F.struct(*own).alias("doc"), F.col("source").alias("s"),
        F.coalesce(F.regexp_count("text", F.lit(f"[^{WHITE}]+")).cast("long"), F.lit(0).cast("long")).alias("size"),
        F.xxhash64("doc_id", F.xxhash64("text")).bitwiseAND(F.lit((1 << ALL_BITS) - 1)).alias("h"))
    rows = stage(sized.select(F.col("s").alias("source"), "size", "h"), "sizes")
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goal = stage(goal.withColumn("base", F.least(F.lit(most).cast("long"), F.floor(
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0))))
        .withColumn("budget", F.round("target").cast("long") - F.col("base") * F.col("source_size")), "targets")
    edges = _thresholds(rows, goal).withColumnRenamed("source", "s")
    goal = stage(goal.join(edges, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "goal")
    # one row a source; sent to every task while there are few, else joined by shuffles
    small = goal.count() <= FEW_SOURCES
    full = sized.join(F.broadcast(goal) if small else goal, F.col("source").eqNullSafe(F.col("s")))

    def taken(at_edge: Column) -> Column:
        more = (F.when(F.col("edge").isNull(), (F.col("budget") > 0).cast("long") * F.col("size"))
                .when(F.col("h") < F.col("edge"), F.col("size")).when(F.col("h") == F.col("edge"), at_edge)
                .otherwise(F.lit(0).cast("long")))
        return F.col("base") * F.col("size") + more

    tied = (rows.where("size > 0").withColumnRenamed("source", "s")
            .join(goal, F.col("source").eqNullSafe(F.col("s")) & F.expr("h = edge"))
            .groupBy("source").count().where("count > 1").take(1))
    if not tied:  # one row at each edge
        out = full.withColumn("taken", taken(F.least("size", "owed")))
    else:
        turn = Window.partitionBy("s", "h").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
        edge = (full.where("h = edge").withColumn("before", F.coalesce(F.sum("size").over(turn), F.lit(0)))
                .withColumn("taken", taken(F.greatest(F.lit(0), F.least("size", F.expr("owed - before"))))).drop("before"))
        out = full.where("edge is null or h <> edge").withColumn("taken", taken(F.lit(0))).unionByName(edge)
    return out.select("doc.*", "size", "source_size", "target", "taken")
