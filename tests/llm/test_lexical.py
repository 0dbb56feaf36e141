import math
import random
import re
from collections import Counter

from paceline.llm import lexical

SCHEMA = "doc_id long, text string, item_id string, rank string, score string, _item string, term string"


def cut(text):
    return re.findall(lexical.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    terms = [(d, Counter(cut(t))) for d, t in docs]
    terms = [(d, c) for d, c in terms if c]
    n, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for i, text in items:
        found = []
        for d, c in terms:
            m = 100 - 75 + 75 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in cut(text) if c[t])
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", "y", "z", "u", "v") for i, t in docs], SCHEMA).repartition(5)
    b = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, doc_id string, term string").repartition(2)
    return sorted([tuple(r) for r in lexical.search(d, b, **options).select("item_id", "rank", "doc_id", "score").collect()], key=str)


def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)] + ["été", "Ünï", "İx", "ſ", "日本", "a", "ab", "abc", "x1"]
    say = lambda n: "".join(rng.choice(words) + rng.choice([" ", "  ", "-", ".\n", "'", "\x7f"]) for _ in range(n))
    docs = [(i, say(rng.randint(1, 60))) for i in range(120)]
    docs += [(i + 200, docs[3][1].upper()) for i in range(15)] + [(5, docs[5][1]), (None, docs[3][1]), (None, docs[3][1]), (900, None), (901, ""), (902, " .-\n")]
    items = [(i, say(rng.randint(1, 12))) for i in range(12)] + [(3, "w1 w1 W1 w2"), (None, "w3"), (50, None), (51, ""), (52, "nowhere"), (53, docs[3][1])]
    return docs, items


def test_ranks_against_brute_force(spark):
    docs, items = corpus()
    expected = brute(docs, items)
    assert run(spark, docs, items) == expected
    assert run(spark, docs, items, block_bytes=60) == expected  # many automata
    assert run(spark, docs, items, top=2) == brute(docs, items, 2)


def test_long_texts_are_scanned_in_pieces(spark, monkeypatch):
    block = lexical.Block([{"term": t, "_item": "i", "item_id": 1, "k": 1} for t in ("ab", "b", "é")])
    text = "ab  B é," * 500 + "ab" * 300 + " b"
    whole = block.count(text)
    for piece in (1, 7, 64):
        monkeypatch.setattr(lexical, "PIECE", piece)
        n, tf = block.count(text)
        assert n == whole[0] == len(cut(text)) and tf.tolist() == whole[1].tolist() == [500, 501, 500]
    docs = [(1, "big " * 400_000), (2, "big")]
    assert run(spark, docs, [(1, "BIG")]) == brute(docs, [(1, "BIG")])


def test_empty_tables(spark):
    docs, items = corpus()
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, docs, [(1, None)]) == []
