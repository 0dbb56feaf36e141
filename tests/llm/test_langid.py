import math
import random

from paceline.llm import langid

SYLLABLES = {"aa": ["ka", "to", "mi", "re"], "bb": ["stra", "kno", "pfe", "sch"], "cc": ["éa", "ñu", "ço", "lü"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def brute_bits(trained, value):
    """Code length under each language, symbol by symbol, with plain dictionaries."""
    out = {}
    for lang, texts in trained.items():
        counts = [{} for _ in range(langid.ORDER + 1)]
        for t in texts:
            s = langid.symbols(t)
            for i in range(langid.ORDER, len(s)):
                for k in range(langid.ORDER + 1):
                    own = counts[k].setdefault(s[i - k:i], {})
                    own[s[i]] = own.get(s[i], 0) + 1
        bits, s = 0.0, langid.symbols(value)
        for i in range(langid.ORDER, len(s)):
            for k in range(langid.ORDER, -1, -1):
                own = counts[k].get(s[i - k:i])
                if own is None:
                    continue
                mass = sum(own.values()) + len(own)
                if s[i] in own:
                    bits -= math.log2(own[s[i]] / mass)
                    break
                bits -= math.log2(len(own) / mass)
            else:
                bits += math.log2(155)
        out[lang] = bits
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(4)


def test_code_lengths_are_exact(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, rng.randint(1, 40)), lang, "x") for i, lang in enumerate(["aa", "bb", "cc"] * 12)]
    model = langid.learn(frame(spark, rows), "text", "lang", min_share=0.0)
    trained = {name: [t for _, t, g, _ in rows if g == name] for name in SYLLABLES}
    for value in ["kato", "stra kno éa", "Zzz 123 qq", "Ñu!! ço?", rows[0][1], text(rng, "bb", 5), "中文"]:
        want = brute_bits(trained, value)
        got = model.total(langid.symbols(value))
        assert model.labels == sorted(want)
        for name, bits in zip(model.labels, got):
            assert abs(bits - want[name]) < 1e-6, (value, name)


def test_identify(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, 30), lang, "x") for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    odd = [(1000, None, "aa", "x"), (1001, "", "aa", "x"), (1002, "12 34 !!", "bb", "x"), (None, text(rng, "bb", 30), None, "x"),
           (1003, text(rng, "cc", 40_000), None, "x"), (5, rows[5][1], "cc", "x"), (5, rows[5][1], "cc", "x")]
    got = langid.identify(frame(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 1000:
            assert r.lang_pred == r.lang
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, None, 1003)] == ["und", "und", "und", "bb", "cc"]
    assert by[None].held_out and by[1000].score == 0


def test_nothing_to_learn(spark):
    assert [r.lang_pred for r in langid.identify(frame(spark, [(1, "abc", None, "x")])).collect()] == ["und"]
    assert langid.identify(frame(spark, []).limit(0)).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    got = langid.identify(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out AND lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
