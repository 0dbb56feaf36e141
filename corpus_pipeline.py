"""The training-data pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``docs``, values
untouched, whatever their names; sharding replaces columns named shard and slot.

NULL and empty texts, and texts without letters, leave at language ID; in the other stages they are
texts without words. Repeated rows are near duplicates, later on rows of their own; ties go to the
smallest id, then to a hash. Texts are read whole, however long. An empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.llm import decontam, langid, mixing, sharding, simhash
from paceline.llm.common import with_row_id
from paceline.session import discard, stage

#: A document stays when the likeliest language is at least this likely.
SURE = 0.5


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique number per row, in a column whose name no other has."""
    name = "_row"
    while name in [c.lower() for c in docs.columns]:
        name = f"_{name}"
    return with_row_id(docs, name), name


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model has learned; those without letters, and undecided ones, go."""
    # Columns travel under other names, so that none meets those that the model adds.
    named = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)],
                        F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    said = langid.identify(named, "_id", "_text", "_lang").where((F.col("lang_pred") != "und") & (F.col("score") >= SURE))
    return said.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    rows, row = _numbered(docs)
    kept = simhash.near_duplicates(rows, row).where("kept").select(row)
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = (decontam.leaks(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
             .select(F.col("doc_id").alias("_id"), "text_key").distinct())
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"]) == found["text_key"]), "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the mixture of their sources; a document that the mix takes twice is there twice."""
    rows, row = _numbered(docs)
    taken = mixing.mixed(rows, row).select(row)
    return rows.join(taken, row).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard (0 to 23) and slot."""
    rows, row = _numbered(docs.drop("shard", "slot"))
    places = sharding.assign(rows, (row,)).select(row, "shard", "slot")
    return rows.join(places, row).drop(row)


STAGES = [("language ID", languages), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontaminate),
          ("mixing", mix), ("sharding", shard)]

#: Language ID has no SQL form; tests compare the whole with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        if written is not None:
            discard(written)
        written = docs
    return docs
