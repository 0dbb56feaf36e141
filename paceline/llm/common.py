"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.session import discard, stage

#: A word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def in_pieces(df: DataFrame, rows: int = 512) -> DataFrame:
    """``df`` with Arrow batches of at most ``rows`` rows and about 64 MB, so that a batch of very long texts fits in memory.

    The same settings for every operator, so a query built later does not change one built earlier.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    return df


def words(text) -> F.Column:
    """Array of the words of a string column; empty for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a unique number per row that stays the same however often it is computed.

    A table read from files takes its place in them; anything else is written once.
    """
    try:
        place = df.withColumn(name, F.concat_ws(":", F.xxhash64("_metadata.file_path"), "_metadata.row_index"))
        place.schema  # noqa: B018  resolves the columns
        return place
    except AnalysisException:
        return stage(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): one root for all nodes of ``pairs(a, b)`` that links connect. Nodes without a pair are absent.

    Each round hangs every node below its smallest neighbour; of two that choose each other the
    smaller becomes a top (longer circles can't occur). The chains are flattened by doubling, and
    the pairs between tops remain. Every node with a pair merges with another, so at least half of
    the nodes vanish in a round. Every table is written and read back, which cuts the lineage.
    """
    edges = stage(pairs.where("a != b").select("a", "b").distinct(), "edges")
    roots = stage(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root")), "roots")
    while not edges.isEmpty():
        chosen = stage(edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                                                      F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"))
                       .groupBy("e.node").agg(F.min("e.other").alias("top")), "chosen")
        back = chosen.select(F.col("node").alias("top"), F.col("top").alias("back"))
        up = stage(chosen.join(back, "top").select(
            "node", F.when((F.col("back") == F.col("node")) & (F.col("node") < F.col("top")), F.col("node"))
            .otherwise(F.col("top")).alias("top"), F.lit(True).alias("moved")), "up")
        discard(chosen)
        while not up.where("moved").isEmpty():
            over = up.select(F.col("node").alias("top"), F.col("top").alias("further"))
            higher = stage(up.drop("moved").join(over, "top").select(
                "node", F.col("further").alias("top"), (F.col("further") != F.col("top")).alias("moved")), "up")
            discard(up)
            up = higher
        flat = up.select("node", "top")
        new_roots = stage(roots.join(flat.withColumnRenamed("node", "root"), "root", "left")
                          .select("node", F.coalesce("top", "root").alias("root")), "roots")
        new_edges = stage(edges.join(flat.select(F.col("node").alias("a"), F.col("top").alias("_a")), "a")
                          .join(flat.select(F.col("node").alias("b"), F.col("top").alias("_b")), "b").where("_a != _b")
                          .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
        for old in (roots, edges, up):
            discard(old)
        roots, edges = new_roots, new_edges
    return roots
