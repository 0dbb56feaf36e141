"""Queries over report texts: documents, conversations and control messages read as reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.functions import text as ops
from paceline.operators import contracts
from paceline.plans.q_control import cf, with_cf
from paceline.plans.q_documents import EVENTS_SQL, events
from paceline.plans.registry import query, rounded
from paceline.plans.views import table

_WORDS = "len(list_filter(regexp_split_to_array(trim({c}), '\\s+'), lambda w: w <> ''))"


@query("text_normalise", with_cf("""SELECT part, seq, regexp_replace(regexp_replace(Message, '\\bdeployed\\b', 'acionado', 'gi'), '\\bdeploy\\b', 'acionamento', 'gi') AS Message
 FROM cf WHERE Message IS NOT NULL"""))
def text_normalise(spark, sf_dir):
    return cf(spark, sf_dir).where(F.col("message") != "").select("part", "seq", ops.normalize_words("Message").alias("Message"))


@query("text_normalise_documents", "SELECT doc_id, md5(regexp_replace(text, '\\bdeploy\\b', 'acionamento', 'gi')) AS h FROM documents")
def text_normalise_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(ops.normalize_words("text")).alias("h"))


@query("word_count", f"SELECT doc_id, CAST({_WORDS.format(c='text')} AS BIGINT) AS words FROM documents")
def word_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ops.word_count("text").alias("words"))


_REPORT_SQL = "rep AS (SELECT doc_id, source || ' ' || lang AS titulo, lang || ' ' || n_chars AS lead, text AS narrativa, source AS destaques, CASE WHEN doc_id % 3 = 0 THEN 'fim' ELSE source || source || source || source || source END AS conclusao FROM documents)"


def reports(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat("source", F.lit(" "), "lang").alias("titulo"), F.concat("lang", F.lit(" "), F.col("n_chars")).alias("lead"),
                    F.col("text").alias("narrativa"), F.col("source").alias("destaques"),
                    F.when(F.col("doc_id") % 3 == 0, "fim").otherwise(F.repeat("source", F.lit(5))).alias("conclusao"))


@query("section_words", f"WITH {_REPORT_SQL} SELECT doc_id, " + ", ".join(f"CAST({_WORDS.format(c=s)} AS BIGINT) AS {s}_words" for s in ops.SECTIONS)
       + ", CAST(" + _WORDS.format(c="titulo || ' ' || lead || ' ' || narrativa || ' ' || destaques || ' ' || conclusao") + " AS BIGINT) AS total_words FROM rep")
def section_words(spark, sf_dir):
    return ops.section_word_counts(reports(spark, sf_dir)).select("doc_id", *[f"{s}_words" for s in ops.SECTIONS], "total_words")


@query("render", f"""WITH {_REPORT_SQL} SELECT doc_id, md5(concat_ws(chr(10) || chr(10), titulo, lead, narrativa, destaques, conclusao)) AS plain,
 md5('# ' || titulo || chr(10) || chr(10) || '> ' || lead || chr(10) || chr(10) || narrativa || chr(10) || chr(10) || '---' || chr(10) || chr(10) || destaques || chr(10) || chr(10) || conclusao) AS markdown FROM rep""")
def render(spark, sf_dir):
    return reports(spark, sf_dir).select("doc_id", F.md5(ops.to_text()).alias("plain"), F.md5(ops.to_markdown()).alias("markdown"))


@query("contract_report", f"""WITH {_REPORT_SQL} SELECT doc_id, concat_ws(',', CASE WHEN length(titulo) < 10 THEN 'titulo' END, CASE WHEN length(lead) < 50 THEN 'lead' END,
 CASE WHEN length(narrativa) < 150 THEN 'narrativa' END, CASE WHEN length(destaques) < 50 THEN 'destaques' END, CASE WHEN length(conclusao) < 20 THEN 'conclusao' END) AS violations FROM rep""")
def contract_report(spark, sf_dir):
    return contracts.check(reports(spark, sf_dir), contracts.report_rules()).select("doc_id", F.array_join("violations", ",").alias("violations"))


@query("unknown_codes", with_cf(""", kn AS (SELECT part, any_value(code) AS code FROM cf GROUP BY part HAVING max(Lap) > 66)
 SELECT cf.part, cf.seq, CAST(CASE WHEN kn.code IS NULL THEN 1.0 ELSE round(greatest(0, 1 - 0.15 * len(list_filter(list_distinct(regexp_extract_all(Message || ' (ZZZ) (ZZZ)', '\\(([A-Z]{3})\\)', 1)),
   lambda c: c <> kn.code))), 3) END AS DOUBLE) AS score FROM cf LEFT JOIN kn ON kn.part = cf.part WHERE Message IS NOT NULL"""))
def unknown_codes(spark, sf_dir):
    msg = cf(spark, sf_dir).where(F.col("message") != "")
    known = cf(spark, sf_dir).groupBy("part").agg(F.array(F.min("code")).alias("known"), F.max("Lap").alias("_l")).where("_l > 66").drop("_l")
    text = F.concat("Message", F.lit(" (ZZZ) (ZZZ)"))
    return msg.join(known, "part", "left").select("part", "seq", ops.unknown_code_score(text, "known").alias("score"))


@query("forbidden_terms", """SELECT doc_id, round(greatest(0, 1 - 0.1 * len(regexp_extract_all(text || CASE WHEN doc_id % 4 = 0 THEN ' tire cliff, CLUSTER and soft' ELSE '' END,
 '\\b(tire cliff|drop_seconds|push %|base %|degraded %|anomaly|cliff_validated|ataque %|desgaste %|cluster|isolation forest|SOFT|MEDIUM|HARD|INTERMEDIATE)\\b', 0, 'i'))), 6) AS score FROM documents""")
def forbidden_terms(spark, sf_dir):
    text = F.concat("text", F.when(F.col("doc_id") % 4 == 0, " tire cliff, CLUSTER and soft").otherwise(""))
    return rounded(table(spark, sf_dir, "documents").select("doc_id", ops.forbidden_score(text).alias("score")))


# Each document reports on the race of its number; mentions are appended by rule.
_COVER_SQL = """, rep AS (SELECT CAST(doc_id % 10 AS BIGINT) AS race, doc_id, lower(text || ' volta ' || (doc_id % 70) || CASE WHEN doc_id % 5 = 0 THEN ' Verstappen' ELSE '' END) AS t FROM documents),
 evx AS (SELECT race, lap, winner, loser, driver FROM tl WHERE type IN ('safety_car', 'undercut', 'overcut', 'retirement', 'penalty'))"""


def covered_reports(spark, sf_dir):
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    extra = F.concat(F.lit(" volta "), (i % 70).cast("string"), F.when(i % 5 == 0, " Verstappen").otherwise(""))
    return d.select((i % 10).alias("race"), "doc_id", F.concat("text", extra).alias("t"))


@query("event_coverage", with_cf(EVENTS_SQL + _COVER_SQL + """ SELECT rep.race, doc_id, round_even(avg(CASE WHEN contains(t, 'volta ' || lap) OR contains(t, 'lap ' || lap) OR ('VER' IN (winner, loser) AND contains(t, 'verstappen'))
  OR ('HAM' IN (winner, loser) AND contains(t, 'hamilton')) THEN 1.0 ELSE 0.0 END), 3) AS coverage FROM rep JOIN evx ON evx.race = rep.race GROUP BY rep.race, doc_id"""))
def event_coverage(spark, sf_dir):
    return ops.event_coverage(covered_reports(spark, sf_dir), events(spark, sf_dir), ["race"], "doc_id", "t")


_DIGITS_SQL = """, dg AS (SELECT race, doc_id, lower(t) AS t FROM (SELECT CAST(conv_id % 10 AS BIGINT) AS race, conv_id * 1000 + turn AS doc_id, text || ' ' || (conv_id % 70) AS t FROM conversations))"""


@query("event_coverage_digits", with_cf(EVENTS_SQL + _DIGITS_SQL + """ SELECT dg.race, doc_id, round_even(avg(CASE WHEN contains(t, CAST(lap AS VARCHAR)) THEN 1.0 ELSE 0.0 END), 3) AS coverage
 FROM dg JOIN (SELECT race, lap FROM tl WHERE type IN ('safety_car', 'undercut', 'retirement')) e ON e.race = dg.race GROUP BY dg.race, doc_id"""))
def event_coverage_digits(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    rep = c.select((F.col("conv_id") % 10).alias("race"), (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
                   F.concat("text", F.lit(" "), (F.col("conv_id") % 70).cast("string")).alias("t"))
    ev = events(spark, sf_dir).select("race", "lap", "type", *[F.lit(None).cast("string").alias(c) for c in ("driver", "winner", "loser")])
    return ops.event_coverage(rep, ev, ["race"], "doc_id", "t", types=["safety_car", "undercut", "retirement"], digits_only=True)


_SCORES_SQL = f""", rp AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Max Verstappen (VER)' ELSE 'Lando Norris' END AS winner, CASE WHEN doc_id % 3 = 0 THEN 'VER wins' ELSE lang END AS titulo,
   text || CASE WHEN doc_id % 5 = 0 THEN ' NORRIS' ELSE '' END AS lead FROM documents),
 sc AS (SELECT doc_id, CASE WHEN (winner LIKE '%(VER)%' AND (contains(lead, 'VER') OR contains(titulo, 'VER'))) OR contains(lower(lead), CASE WHEN winner LIKE 'Max%' THEN 'verstappen' ELSE 'norris' END) THEN 1.0 ELSE 0.0 END AS w,
   {_WORDS.format(c='lead')} AS n FROM rp)"""


def _scored(spark, sf_dir):
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.when(i % 2 == 0, "Max Verstappen (VER)").otherwise("Lando Norris").alias("winner"), F.when(i % 3 == 0, "VER wins").otherwise(F.col("lang")).alias("titulo"),
        F.concat("text", F.when(i % 5 == 0, " NORRIS").otherwise("")).alias("lead"))


@query("winner_mentioned", "WITH x AS (SELECT 1)" + _SCORES_SQL + " SELECT doc_id, w AS score FROM sc")
def winner_mentioned(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", ops.winner_score("winner", "lead", "titulo").alias("score"))


@query("composite_score", with_cf(EVENTS_SQL + _COVER_SQL + _SCORES_SQL + """, cov AS (SELECT doc_id, round_even(avg(CASE WHEN contains(t, 'volta ' || lap) OR contains(t, 'lap ' || lap)
   OR ('VER' IN (winner, loser) AND contains(t, 'verstappen')) OR ('HAM' IN (winner, loser) AND contains(t, 'hamilton')) THEN 1.0 ELSE 0.0 END), 3) AS c FROM rep JOIN evx ON evx.race = rep.race GROUP BY doc_id),
 trm AS (SELECT doc_id, greatest(0, 1 - 0.1 * len(regexp_extract_all(lead, '\\b(tire cliff|drop_seconds|push %|base %|degraded %|anomaly|cliff_validated|ataque %|desgaste %|cluster|isolation forest|SOFT|MEDIUM|HARD|INTERMEDIATE)\\b', 0, 'i'))) AS p FROM rp)
 SELECT doc_id, round_even(w * 0.3 + coalesce(c, 1) * 0.4 + p * 0.2 + CASE WHEN n BETWEEN 500 AND 800 THEN 0.1 WHEN n BETWEEN 400 AND 1000 THEN 0.05 ELSE 0 END, 3) AS score
 FROM sc JOIN trm USING (doc_id) LEFT JOIN cov USING (doc_id)"""))
def composite_score(spark, sf_dir):
    cover = event_coverage(spark, sf_dir).select("doc_id", "coverage")
    s = ops.composite_score(ops.winner_score("winner", "lead", "titulo"), F.col("coverage"), ops.forbidden_score("lead"), ops.word_count("lead"))
    return _scored(spark, sf_dir).join(cover, "doc_id").select("doc_id", s.alias("score"))
