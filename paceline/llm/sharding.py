"""Shards that all match the mixture, by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; a row's fractional rank says how
far down its source it is. Each source starts at a seeded offset below one rank, so that many small
sources spread over the whole table. Sorted by fractional rank, any stretch of the table holds each
source in proportion, so the table is cut into stretches whose row counts differ by at most one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.spread import buckets, draw, ranked, share
from paceline.session import stage

SHARDS = 24
SEED = 29


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) and 8 for the row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text; that of the empty text for NULL."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def assign(docs: DataFrame, carry: tuple[str, ...] = (), shards: int = SHARDS, id_col: str = "doc_id", text: str = "text",
           source: str = "source", seed: int = SEED) -> DataFrame:
    """(id, carry..., size, text_crc32, shard, slot): one row per row of ``docs``.

    The law is ``rows``: counts of any two shards differ by at most one, and slots number the rows of
    a shard from 0 without gaps. A NULL source is a source of its own, NULL texts have size 8,
    repeated rows are dealt like any other. With fewer rows than shards some shards stay empty.
    """
    own = stage(docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), text_size(F.col(text)).alias("size"),
                            text_crc32(F.col(text)).alias("text_crc32"),
                            draw(seed, F.col(id_col), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("_draw"), *carry), "rows")
    rows = own.count()
    counts = own.groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    inside = ranked(own.withColumn("_f", share(F.col("_draw"))), ["source"], "_f", ["_draw", "id", *carry], buckets(rows), "_rank")
    inside = (inside.join(counts, F.col("source").eqNullSafe(F.col("_s")))
              .withColumn("_f", (F.col("_rank") + share(draw(seed, F.col("source")))) / F.col("_n")))
    # The order among equal rows must not change between two computations of the same rank.
    inside = stage(inside.select("id", "size", "text_crc32", "_draw", "_f", *carry), "fractions")
    placed = ranked(inside, [], "_f", ["_f", "_draw", "id", *carry], buckets(rows), "_at")
    # In whole numbers: the shard is (at * shards) div rows, its first place the ceiling of shard * rows / shards.
    shard = F.expr(f"cast((_at * {shards}L) div {max(rows, 1)}L as int)")
    first = F.expr(f"(shard * {max(rows, 1)}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard).select(F.col("id").alias(id_col), *carry, "size", "text_crc32", "shard",
                                                    (F.col("_at") - first).alias("slot"))
