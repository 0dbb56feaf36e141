"""Line deduplication within one word edit, by a deletion-neighbourhood join, in DataFrame functions only.

Two lines within one inserted, deleted or replaced word become equal when at most one word is
deleted from each. Every distinct line therefore emits the hashes of its variants with one word
missing, and of itself; equal hashes are joined and verified word by word. Variants with the word
missing at the same place differ in that word only, so the earliest line of such a group stands for
all earlier ones, and no pairs inside a group are formed. A first hash of each variant covers its pairs
of adjacent words without their order, which takes one step a variant; only variants that share it
with another line are hashed whole, so that long lines cost time in proportion.

Lines whose halves no other line has cannot have a partner and emit nothing: one edit leaves the
first or the last half of the shorter line as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import words
from paceline.session import discard, stage

#: Shorter lines are only compared exactly: one word of five is the most that may differ.
MIN_WORDS = 5


def _lines(docs: DataFrame) -> DataFrame:
    """(id, text_key, line, text, h1, h2): every line that has a word."""
    rows = docs.select("id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    return rows.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumns({"h1": F.xxhash64("text"), "h2": F.hash("text")})


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda x: F.xxhash64(x))


def _halves(w: Column) -> Column:
    """Keys that a line shares with every line within one edit: the untouched half, for either length of the shorter one."""
    n = F.size(w)
    keys = []
    for m in (n, n - 1):
        half = F.greatest(F.ceil((m - 1) / 2).cast("int"), F.lit(1))
        keys += [F.xxhash64(F.lit("p"), m, F.slice(w, F.lit(1), half)), F.xxhash64(F.lit("s"), m, F.slice(w, n - half + 1, half))]
    return F.array(*keys)


def _pairs(w: Column) -> Column:
    """XOR of the hashes of all pairs of adjacent words, the ends included."""
    return F.aggregate(F.sequence(F.lit(0), F.size(w)), F.lit(0).cast("long"),
                       lambda s, i: s.bitwiseXOR(F.xxhash64(F.get(w, i - 1), F.get(w, i))))


def _sketches(w: Column, whole: Column) -> Column:
    """(at, sketch): the line itself at -1, and for each word the line without it; ``whole`` is ``_pairs`` of the line."""
    n = F.size(w)

    def without(x, i):
        left, right = F.get(w, i - 1), F.get(w, i + 1)
        rest = whole.bitwiseXOR(F.xxhash64(left, x)).bitwiseXOR(F.xxhash64(x, right)).bitwiseXOR(F.xxhash64(left, right))
        return F.struct(i.alias("at"), F.xxhash64(n - 1, rest).alias("sketch"))
    return F.concat(F.array(F.struct(F.lit(-1).alias("at"), F.xxhash64(n, whole).alias("sketch"))), F.transform(w, without))


def _variants(w: Column, ats: Column) -> Column:
    """(at, key) of these variants, hashed in order. Hashing two arrays in turn is hashing them joined."""
    return F.transform(ats, lambda i: F.struct(i.alias("at"), F.when(i < 0, F.xxhash64(w)).otherwise(
        F.xxhash64(F.slice(w, F.lit(1), i), F.slice(w, i + 2, F.size(w)))).alias("key")))


def within_one_edit(a: Column, b: Column) -> Column:
    """True for word lists that are equal up to one inserted, deleted or replaced word."""
    short, long = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    ends = F.aggregate(F.zip_with(short, long, lambda x, y: x.eqNullSafe(y)), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
                       lambda s, same: F.struct((s["n"] + F.when(s["on"] & same, 1).otherwise(0)).alias("n"), (s["on"] & same).alias("on")),
                       lambda s: s["n"])
    rest = F.size(short) - ends
    return (F.size(long) - F.size(short) <= 1) & (
        F.slice(short, ends + 1 + F.when(F.size(short) == F.size(long), 1).otherwise(0), F.size(short) + 1)
        == F.slice(long, ends + 2, F.size(long) + 1)) | (rest == 0) & (F.size(long) - F.size(short) <= 1)


def find_repeats(docs: DataFrame) -> DataFrame:
    """(id, text_key, line, near): lines to drop from ``docs(id, text_key, text)``. ``near``: an earlier line is within one edit, not equal."""
    lines = _lines(docs)
    place = F.struct("id", "line", "h1", "h2")
    kinds = stage(lines.withColumn("w", _hashes(F.col("text"))).withColumn("n", F.size("w")).withColumn("halves", F.when(F.size("w") >= MIN_WORDS, _halves(F.col("w"))))
                  .groupBy("h1", "h2").agg(F.min(F.struct("id", "line", "text_key")).alias("first"), F.max("n").alias("n"),
                                           F.max("halves").alias("halves")), "lines")
    long = kinds.where(F.col("n") >= MIN_WORDS)
    halves = long.select("h1", "h2", F.explode(F.array_distinct("halves")).alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    alive = stage(halves.join(shared, "half", "left_semi").select("h1", "h2").distinct(), "alive")
    # The words of the lines that may have a partner, from their first occurrence.
    firsts = kinds.select("h1", "h2", "first").join(alive, ["h1", "h2"], "left_semi").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("first.id").alias("_id"), F.col("first.line").alias("_line"),
        F.col("first.text_key").alias("_key"))
    texts = stage(lines.join(firsts, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & F.col("id").eqNullSafe(F.col("_id"))
                             & (F.col("line") == F.col("_line")) & (F.col("text_key") == F.col("_key")))
                  .select("id", "line", "h1", "h2", "text").dropDuplicates(["h1", "h2"])
                  .select("id", "line", "h1", "h2", _hashes(F.col("text")).alias("w"))
                  .withColumn("whole", _pairs(F.col("w"))), "words")
    # The sketch of a whole line is a column of the table of lines, taken once a line.
    marks = stage(texts.select("h1", "h2", F.explode(_sketches(F.col("w"), F.col("whole"))).alias("s")).select("h1", "h2", "s.sketch", "s.at"), "marks")
    # Most variants belong to one line only; the few that are shared go on.
    busy = (marks.groupBy("sketch").agg(F.min("h1").alias("a"), F.max("h1").alias("b"), F.min("h2").alias("c"), F.max("h2").alias("d"))
            .where("a != b OR c != d").select("sketch"))
    alike = marks.join(busy, "sketch", "left_semi").groupBy("h1", "h2").agg(F.collect_list("at").alias("ats"))
    shared = stage(texts.join(alike, ["h1", "h2"]).select(place.alias("place"), F.explode(_variants(F.col("w"), F.col("ats"))).alias("v"))
                   .select("place", "v.key", "v.at"), "shared")
    discard(marks)
    firsts_at = shared.groupBy("key", "at").agg(F.min("place").alias("first"))
    ends = shared.groupBy("key").agg(F.min(F.when(F.col("at") < 0, F.col("place"))).alias("whole"),
                                     F.min(F.when(F.col("at") >= 0, F.col("place"))).alias("cut"))
    near = (shared.join(firsts_at, ["key", "at"]).join(ends, "key")
            .select("place", F.explode(F.array(
                F.when(F.col("at") >= 0, F.col("first")),  # a word replaced
                F.when(F.col("at") >= 0, F.col("whole")).otherwise(F.col("cut")))).alias("other"))  # a word more or less
            .where("other < place"))
    pairs = near.distinct()
    mine = texts.select("h1", "h2", "w")
    theirs = texts.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("w").alias("v"))
    checked = stage(pairs.join(mine, (F.col("place.h1") == F.col("h1")) & (F.col("place.h2") == F.col("h2")))
               .join(theirs, (F.col("other.h1") == F.col("_h1")) & (F.col("other.h2") == F.col("_h2")))
               .where(within_one_edit(F.col("w"), F.col("v"))).select("h1", "h2").distinct(), "near")
    for done in (alive, texts, shared):
        discard(done)
    verdict = kinds.select("h1", "h2", "first").join(checked.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
    return (lines.select("id", "text_key", "line", "h1", "h2").join(verdict, ["h1", "h2"])
            .withColumn("near", F.coalesce("near", F.lit(False)))
            .where(F.col("near") | ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("line") == F.col("first.line"))
                                     & (F.col("text_key") == F.col("first.text_key"))))
            .select("id", "text_key", "line", "near"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_key, n_lines, n_exact, n_near, text): every document without the lines that repeat an earlier one.

    A line goes when an earlier line, in order of id and line number (NULL ids first), is equal, or
    within one inserted, deleted or replaced word; the earliest of all always stays. Only lines with ``MIN_WORDS``
    words or more are compared beyond equality, and words are what stands between ASCII white space.
    An earlier line counts even where it goes itself. Lines without a word always stay. A NULL text
    has no lines and stays NULL; an empty table gives an empty result. Rows that repeat id and text
    are one document and come out alike, one row each. Other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    gone = (find_repeats(source).groupBy(F.col("id").alias("_id"), F.col("text_key").alias("_key"))
            .agg(F.collect_set("line").alias("gone"), F.countDistinct(F.when(F.col("near"), F.col("line"))).alias("n_near")))
    out = source.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    # A column of its own: inside the lambda the text would be split again for every line.
    out = out.withColumn("_split", F.split("text", "\n", -1))
    split = F.col("_split")
    lost = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), lost)
    kept = F.when(split.isNotNull(), F.transform(stay, lambda i: F.get(split, i)))
    return out.select(F.col("id").alias(id_col), "text_key", F.coalesce(F.size(split), F.lit(0)).alias("n_lines"),
                      (F.size(lost) - F.coalesce("n_near", F.lit(0))).cast("long").alias("n_exact"),
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.array_join(kept, "\n").alias("text"))
