"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots. Slot ``i`` takes the point ``frac((i + 1) / phi)``, which the cumulative
weights map to a source; points of the golden ratio fill the unit interval evenly, so after any
number of slots every source is close to its share. Each source's documents are shuffled into one
stream of words, repeated as often as allowed and cut into blocks of equal length; the j-th slot of
a source takes its j-th block.

A source below ``RARE`` of the mix would meet too few points. It takes its target exactly instead: its
words go in pieces to slots at equal distances, and the other sources share the schedule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paceline.llm.common import words
from paceline.llm.spread import buckets, draw, ranked, share
from paceline.session import stage

#: Slots of the mix. A source with a hundredth of it differs from its target by about 0.1 %.
SLOTS = 1 << 17
#: A source with less than this share of the mix (64 slots) is rare.
RARE = 1 / (1 << 11)
#: Weights dealt to the sources in order, again and again.
WEIGHTS = (3, 1, 2)
#: Words of the mix for each word of the input, and the most often that a document is repeated.
TOTAL, REPEATS = 1.5, 2
#: Cells of the unit interval in which slots look for their source.
CELLS = 1 << 10
SEED = 17

_GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(sizes: DataFrame, total: float = TOTAL, repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row per source.

    Sources in code-point order, NULL last, get the weights in turn and share ``total`` times all
    sizes. A target stops at ``repeats`` times its source; what is over goes to the others by
    weight until none is above. That is the level of ``min(cap, level * weight)`` with the right
    sum, found in one scan by the size of cap over weight. The table has a row per source.
    """
    everything = W.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    out = (sizes.withColumn("weight", F.get(cycle, ((F.row_number().over(by_name) - 1) % len(weights))))
           .withColumn("_cap", F.col("source_size") * float(repeats))
           .withColumn("_all", F.sum("source_size").over(everything) * total))
    upto = everything.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    level = ((F.col("_all") - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))))
    # Once the level of a source is within its cap, it holds for all after it.
    out = out.withColumn("_level", level).withColumn("_fits", F.col("_level") * F.col("weight") <= F.col("_cap"))
    return (out.withColumn("_final", F.min(F.when(F.col("_fits"), F.struct(F.col("_cap") / F.col("weight"), F.col("_level").alias("level")))).over(everything)["level"])
            .select("source", "source_size", "weight",
                    F.when(F.col("_final").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_final") * F.col("weight"))).alias("target")))


def schedule(spark, goals: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(slot, source, turn): the source of every slot, and its running number within the source."""
    everything = W.partitionBy(F.lit(0))
    upto = everything.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = F.sum("target").over(everything)
    spans = (goals.where("target > 0").select("source", (F.sum("target").over(upto) / whole).alias("_hi"),
                                              F.max(F.col("source").isNull()).over(everything).alias("_x"), "target", whole.alias("_all"))
             .withColumn("_lo", F.coalesce(F.lag("_hi").over(everything.orderBy(F.col("source").asc_nulls_last())), F.lit(0.0)))
             .withColumn("_hi", F.when(F.lead("_hi").over(everything.orderBy(F.col("source").asc_nulls_last())).isNull(), 1.0).otherwise(F.col("_hi")))
             .select("source", "_lo", "_hi", F.explode(F.sequence(F.floor(F.col("_lo") * CELLS), F.floor(F.least(F.col("_hi") * CELLS, F.lit(CELLS - 1.0))))).alias("_cell")))
    point = (F.col("id") + 1) * _GOLDEN
    placed = (spark.range(slots).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("_x"))
              .withColumn("_cell", F.floor(F.col("_x") * CELLS))
              .join(spans, "_cell").where((F.col("_x") >= F.col("_lo")) & (F.col("_x") < F.col("_hi")))
              .select("slot", "source", (F.col("slot") / float(slots)).alias("_f")))
    return ranked(placed, ["source"], "_f", ["slot"], buckets(slots), "turn").drop("_f")


def rare_schedule(goals: DataFrame, slots: int) -> DataFrame:
    """(slot, source, turn): equal distances for the ``_turns`` pieces of each source, from a start by its name."""
    start = F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / float(1 << 20)
    return (goals.select("source", "_turns", F.explode(F.sequence(F.lit(0), F.col("_turns") - 1)).alias("turn"))
            .select(F.least(F.floor((F.col("turn") + start) / F.col("_turns") * slots), F.lit(slots - 1)).cast("long").alias("slot"),
                    "source", F.col("turn").cast("long").alias("turn")))


def mix(docs: DataFrame, source: str = "source", text: str = "text", id_col: str = "doc_id", slots: int = SLOTS,
        total: float = TOTAL, repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED,
        carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The mix as two tables.

    ``plan`` has a row per row of ``docs``: id, size (words), source, place (unique within the source),
    source_size, target, first_word (where the row starts in the shuffled stream of its source), and
    the columns ``carry``. ``pieces`` has a row for each part of a row that the mix takes: source,
    place, slot, turn (of its source), epoch (times the stream was used up before), from_word and
    to_word. In slot order they are the mix.

    NULL and wordless texts have size 0 and are never taken. A NULL source is a source. Rows that
    repeat id and text are rows like any other; which of them gets which share is open unless
    ``carry`` tells them apart. No row is taken more than ``repeats`` times. An empty table gives
    empty tables.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                      draw(seed, F.col(id_col), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("_draw"), *carry)
    own = stage(own, "sizes")
    sizes = own.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stage(targets(sizes, total, repeats, weights), "targets")
    rows = own.count()
    placed = ranked(own.withColumn("_f", share(F.col("_draw"))), ["source"], "_f", ["_draw", "id", *carry], buckets(rows), "place",
                    "size", "first_word")
    plan = stage(placed.join(goals.select(F.col("source").alias("_source"), "source_size", "target"),
                             F.col("source").eqNullSafe(F.col("_source")))
                 .select("id", "size", "source", "place", "source_size", "target", "first_word", *carry), "streams")
    whole = goals.agg(F.sum("target")).first()[0] or 0.0
    rare = F.col("target") < RARE * whole
    words_often = goals.where(~rare).agg(F.sum("target")).first()[0] or 0.0
    block = F.lit(words_often or 1.0) / float(slots)  # words of the mix in each slot
    turns = F.greatest(F.round(F.col("target") / (max(whole, 1.0) / slots)), F.lit(1.0)).cast("int")
    few = goals.where(rare & (F.round("target") > 0)).select("source", turns.alias("_turns"))
    epoch = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("epoch")
    stream = (plan.where("size > 0").select("source", "place", "size", "source_size", "first_word", "target", epoch)
              .withColumn("_block", F.when(rare, F.round("target") / turns).otherwise(block)).where(~rare | (F.col("_block") > 0))
              .withColumn("_from", F.col("first_word") + F.col("epoch") * F.col("source_size"))
              .withColumn("_to", F.col("_from") + F.col("size")).where(~rare | (F.col("_from") < F.col("target"))))
    start = lambda turn: F.round(turn * F.col("_block")).cast("long")  # noqa: E731  first word of a block
    last = F.floor(F.col("_to") / F.col("_block")) + 1
    spread = (stream.withColumn("turn", F.explode(F.sequence(F.greatest(F.floor(F.col("_from") / F.col("_block")) - 1, F.lit(0)), last)))
              .withColumn("_a", F.greatest("_from", start(F.col("turn")))).withColumn("_b", F.least("_to", start(F.col("turn") + 1)))
              .where("_a < _b"))
    taken = schedule(spark, goals.where(~rare), slots).unionByName(rare_schedule(few, slots))
    pieces = (spread.join(taken.select("slot", F.col("source").alias("_s"), F.col("turn").alias("_t")),
                          (F.col("turn") == F.col("_t")) & F.col("source").eqNullSafe(F.col("_s")))
              .select("source", "place", "slot", "turn", "epoch", (F.col("_a") - F.col("_from")).alias("from_word"),
                      (F.col("_b") - F.col("_from")).alias("to_word")))
    return plan, pieces


def takings(docs: DataFrame, **how) -> DataFrame:
    """``plan`` of :func:`mix` with ``taken``, the words that the mix takes of each row, repeats counted."""
    plan, pieces = mix(docs, **how)
    sums = (pieces.groupBy(F.col("source").alias("_s"), F.col("place").alias("_p"))
            .agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken")))
    return (plan.join(sums, (F.col("place") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "_p")
            .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")))


def mixed(docs: DataFrame, row: str, **how) -> DataFrame:
    """(row, epoch): the rows of ``docs``, known by the unique column ``row``, that a mix of whole rows holds.

    A row is in an epoch of its stream when the mix takes its first word there, so every source
    comes within one document of its target. Rows without words are in no epoch.
    """
    plan, pieces = mix(docs, carry=(row,), **how)
    first = pieces.where("from_word = 0").select(F.col("source").alias("_s"), F.col("place").alias("_p"), "epoch")
    return plan.join(first, (F.col("place") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s"))).select(row, "epoch")
