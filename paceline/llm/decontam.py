"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed looks at 7 consecutive tokens through a fixed mask that ignores three of them. Seeds of all
documents are joined with the seeds of all benchmark items on their hash. A hit proposes an
alignment (document, item, offset); each alignment is then verified token by token over the whole
item, so changed words cost matches but do not hide a leak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.session import stage

#: Token positions that each mask looks at. Every pattern of replaced tokens that keeps ``COVERAGE`` of an item of 8 tokens or
#: more, or a stretch of ``STRETCH``, leaves a mask whole somewhere; the tests prove it by going through all patterns.
MASKS = ((0, 1, 2, 4), (0, 3, 4, 5), (0, 3, 5, 6), (0, 4, 5, 6), (1, 2, 5, 6))
SPAN = 7
#: An alignment is a leak when it matches this share of the item's tokens ...
COVERAGE = 0.7
#: ... or has a stretch whose matches less twice its mismatches reach this.
STRETCH = 13
#: Benchmark seeds up to this number (about 50 MB) are broadcast; more are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; empty for NULL."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def seeds(hashes: Column) -> Column:
    """Array of all seed hashes: for each start the masks in turn. Empty below ``SPAN`` tokens."""
    def at(i):
        return F.array(*[F.xxhash64(F.lit(m), *[F.get(hashes, i + o) for o in mask]) for m, mask in enumerate(MASKS)])
    starts = F.when(F.size(hashes) >= SPAN, F.sequence(F.lit(0), F.size(hashes) - SPAN)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(starts, at))


def _hashed(df: DataFrame, key: list[str], text: str) -> DataFrame:
    return df.select(*key, F.transform(tokens(F.col(text)), lambda t: F.xxhash64(t)).alias("w"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, text_key, item, item_tokens, matched, stretch, doc_start): one row per leak of an item into a text.

    The best alignment of each pair is reported: most matched tokens, then the longest stretch, then
    the earliest place. ``text_key`` is XXH64 of the whole text; rows that repeat id and text are
    reported once, NULL ids like any other. NULL or empty texts never leak. Items below ``SPAN`` tokens are too short
    to tell from chance and are not searched; of items with ``SPAN`` tokens some changed copies have no seed. Items with equal tokens are searched once and
    reported each. Other columns are ignored.
    """
    items = _hashed(benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")), ["item"], "text")
    items = items.where(F.size("w") >= SPAN).withColumn("kind", F.xxhash64("w"))
    kinds = items.groupBy("kind").agg(F.first("w").alias("v"))
    marks = (kinds.select("kind", F.size("v").alias("n"), F.posexplode(seeds(F.col("v"))).alias("_i", "seed"))
             .select("kind", "n", "seed", F.floor(F.col("_i") / len(MASKS)).cast("int").alias("item_pos")))
    marks = stage(marks, "seeds")
    if marks.count() <= BROADCAST_SEEDS:
        marks = F.broadcast(marks)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    found = (_hashed(source, ["id", "text_key"], "text")
             .select("id", "text_key", F.posexplode(seeds(F.col("w"))).alias("_i", "seed")).join(marks, "seed"))
    offset = (F.floor(F.col("_i") / len(MASKS)).cast("int") - F.col("item_pos")).alias("offset")
    hits = stage(found.select("id", "text_key", "kind", "n", offset).distinct(), "hits")
    hit = hits.select("id", "text_key").distinct()
    texts = source.join(hit, source["id"].eqNullSafe(hit["id"]) & (source["text_key"] == hit["text_key"]), "left_semi")
    texts = _hashed(texts.dropDuplicates(["id", "text_key"]), ["id", "text_key"], "text")
    # Only the tokens that face the item travel on; of an item that starts before the text the first ones face nothing.
    faced = F.slice("w", F.greatest("offset", F.lit(0)) + 1, F.greatest(F.least(F.col("n"), F.col("offset") + F.col("n")), F.lit(0))).alias("w")
    pair = (hits.join(texts, hits["id"].eqNullSafe(texts["id"]) & (hits["text_key"] == texts["text_key"]))
            .select(hits["id"], hits["text_key"], "kind", "offset", faced).join(kinds, "kind"))
    # get() is NULL outside of the text.
    same = F.transform(F.col("v"), lambda t, i: F.coalesce(F.get("w", i + F.least("offset", F.lit(0))) == t, F.lit(False)))
    run = F.aggregate("same", F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")), lambda s, hit: F.struct(
        F.greatest(s["now"] + F.when(hit, 1).otherwise(-2), F.lit(0)).alias("now"),
        F.greatest(s["best"], s["now"] + F.when(hit, 1).otherwise(-2)).alias("best")), lambda s: s["best"])
    judged = (pair.select("id", "text_key", "kind", "offset", F.size("v").alias("item_tokens"), same.alias("same"))
              .select("id", "text_key", "kind", "item_tokens", "offset",
                      F.size(F.filter("same", lambda x: x)).alias("matched"), run.alias("stretch"))
              .where((F.col("matched") >= F.col("item_tokens") * COVERAGE) | (F.col("stretch") >= STRETCH)))
    best = judged.groupBy("id", "text_key", "kind", "item_tokens").agg(
        F.max(F.struct("matched", "stretch", (-F.col("offset")).alias("back"))).alias("b"))
    return (best.join(items.select("kind", "item"), "kind")
            .select(F.col("id").alias(id_col), "text_key", F.col("item").alias(item_col), "item_tokens",
                    F.col("b.matched").alias("matched"), F.col("b.stretch").alias("stretch"), (-F.col("b.back")).alias("doc_start")))
