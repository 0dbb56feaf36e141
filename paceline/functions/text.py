"""Checks and clean-up of report texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.operators.documents import DRIVER_NAMES

# Loanwords and their replacements, in order; terms a report must not use; sections.
LOANWORDS = [("deployado", "acionado"), ("deployada", "acionada"), ("deployed", "acionado"), ("deployar", "acionar"),
             ("deployment", "acionamento"), ("deploy", "acionamento")]
FORBIDDEN_PATTERN = (r"(?i)\b(tire cliff|drop_seconds|push %|base %|degraded %|anomaly|cliff_validated|ataque %|"
                     r"desgaste %|cluster|isolation forest|SOFT|MEDIUM|HARD|INTERMEDIATE)\b")
SECTIONS = ["titulo", "lead", "narrativa", "destaques", "conclusao"]
COVERED_TYPES = ["safety_car", "undercut", "overcut", "retirement", "penalty"]
CODE_PATTERN = r"\(([A-Z]{3})\)"


def normalize_words(text: str | Column) -> Column:
    """Replace the loanwords, whole words in any case."""
    out = F.col(text) if isinstance(text, str) else text
    for word, new in LOANWORDS:
        out = F.regexp_replace(out, rf"(?i)\b{word}\b", new)
    return out


def normalize_report(df: DataFrame, sections: Sequence[str] = SECTIONS) -> DataFrame:
    return df.select(*[normalize_words(c).alias(c) if c in sections else F.col(c) for c in df.columns])


def word_count(text: str | Column) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.size(F.filter(F.split(F.trim(col), r"\s+"), lambda w: w != "")).cast("long")


def section_word_counts(df: DataFrame, sections: Sequence[str] = SECTIONS) -> DataFrame:
    """Append words per section and in total."""
    per = [word_count(c).alias(f"{c}_words") for c in sections]
    return df.select("*", *per, word_count(F.concat_ws(" ", *sections)).alias("total_words"))


def to_text(sections: Sequence[str] = SECTIONS) -> Column:
    return F.concat_ws("\n\n", *sections)


def to_markdown() -> Column:
    t, lead, body, high, end = (F.col(c) for c in SECTIONS)
    return F.concat(F.lit("# "), t, F.lit("\n\n> "), lead, F.lit("\n\n"), body, F.lit("\n\n---\n\n"), high, F.lit("\n\n"), end)


def unknown_code_score(text: str | Column, known: str | Column) -> Column:
    """1 minus 0.15 per distinct code in parentheses that is not known, 0 at least; 1 without known codes."""
    col = F.col(text) if isinstance(text, str) else text
    names = F.col(known) if isinstance(known, str) else known
    codes = F.array_distinct(F.regexp_extract_all(col, F.lit(CODE_PATTERN), 1))
    unknown = F.array_except(codes, F.transform(names, F.upper))
    score = F.bround(F.greatest(F.lit(0.0), 1.0 - F.size(unknown) * 0.15), 3)
    return F.when(F.coalesce(F.size(names), F.lit(0)) <= 0, F.lit(1.0)).otherwise(score)


def forbidden_score(text: str | Column) -> Column:
    """1 minus 0.1 per technical term, 0 at least."""
    col = F.col(text) if isinstance(text, str) else text
    return F.greatest(F.lit(0.0), 1.0 - F.regexp_count(col, F.lit(FORBIDDEN_PATTERN)) * 0.1)


def _surname(code: str) -> Column:
    table = F.create_map(*[F.lit(x) for c, n in DRIVER_NAMES.items() for x in (c, n.split()[-1].lower())])
    return table[F.upper(F.coalesce(F.col(code), F.lit("")))]


def event_coverage(reports: DataFrame, events: DataFrame, keys: Sequence[str], report_id: str, text: str | Column,
                   types: Sequence[str] = COVERED_TYPES, digits_only: bool = False) -> DataFrame:
    """(report id, coverage): share of the race's events whose lap or surname the text mentions.

    A lap is mentioned as "volta N" or "lap N" (with ``digits_only`` as bare digits), also as the
    start of a longer number. Mentions are taken out of each text once and joined with the events
    by value; texts and events are never paired up.
    """
    keys = list(keys)
    col = F.lower(F.col(text) if isinstance(text, str) else text)
    ev = events.where(F.col("type").isin(list(types))).select(*keys, "lap", *[
        _surname(c).alias(f"_n{i}") for i, c in enumerate(("driver", "winner", "loser"))])
    # Equal events are counted, not repeated; the row number-free id is their content.
    ev = ev.groupBy(*keys, "lap", "_n0", "_n1", "_n2").agg(F.count(F.lit(1)).alias("_c"))
    total = ev.groupBy(*keys).agg(F.sum("_c").alias("_total"))
    pattern = r"(\d+)" if digits_only else r"(?:volta|lap) (\d+)"
    numbers = F.array_distinct(F.regexp_extract_all(col, F.lit(pattern), 1))

    def pieces(n: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(n)) if digits_only else F.array(F.lit(1))
        return F.flatten(F.transform(starts, lambda s: F.transform(
            F.sequence(F.lit(1), F.length(n) - s + 1), lambda m: F.substring(n, s, m))))

    laps = F.array_distinct(F.flatten(F.transform(numbers, pieces)))
    surnames = sorted({n.split()[-1].lower() for n in DRIVER_NAMES.values()})
    said = F.array_compact(F.array(*[F.when(F.contains(col, F.lit(n)), F.lit(n)) for n in surnames]))
    r = reports.select(*keys, report_id, laps.alias("_laps"), said.alias("_said"))
    at = [*keys, report_id, "lap", "_n0", "_n1", "_n2", "_c"]
    by_lap = (r.select(*keys, report_id, F.explode("_laps").alias("_l"))
              .join(ev.withColumn("_l", F.col("lap").cast("string")), [*keys, "_l"]).select(*at))
    named = ev.withColumn("_s", F.explode(F.array_distinct(F.array_compact(F.array("_n0", "_n1", "_n2")))))
    by_name = r.select(*keys, report_id, F.explode("_said").alias("_s")).join(named, [*keys, "_s"]).select(*at)
    covered = by_lap.unionByName(by_name).distinct().groupBy(*keys, report_id).agg(F.sum("_c").alias("_hit"))
    out = r.select(*keys, report_id).join(total, keys, "left").join(covered, [*keys, report_id], "left")
    share = F.bround(F.coalesce("_hit", F.lit(0)) / F.col("_total"), 3)
    return out.select(*keys, report_id, F.coalesce(share, F.lit(1.0)).alias("coverage"))


def winner_score(winner: str | Column, lead: str, title: str) -> Column:
    """1 when the winner's code is in lead or title, or the surname in the lead; else 0."""
    w = F.col(winner) if isinstance(winner, str) else winner
    code = F.nullif(F.regexp_extract(w, CODE_PATTERN, 1), F.lit(""))
    surname = F.lower(F.element_at(F.split(F.trim(F.element_at(F.split(w, r"\("), 1)), " "), -1))
    by_code = F.contains(F.col(lead), code) | F.contains(F.col(title), code)
    by_name = (w != "") & F.contains(F.lower(F.col(lead)), surname)
    return F.when(F.coalesce(by_code, F.lit(False)) | F.coalesce(by_name, F.lit(False)), 1.0).otherwise(0.0)


def length_score(words: Column) -> Column:
    """0.10 for 500 to 800 words, 0.05 for 400 to 1000."""
    return F.when(words.between(500, 800), 0.10).when(words.between(400, 1000), 0.05).otherwise(0.0)


def composite_score(winner: Column, coverage: Column, terms: Column, words: Column) -> Column:
    """0.3 winner + 0.4 coverage + 0.2 plain language + length."""
    return F.bround(winner * 0.30 + coverage * 0.40 + terms * 0.20 + length_score(words), 3)
