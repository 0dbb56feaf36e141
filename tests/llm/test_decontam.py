import random
import re

from paceline.llm import decontam

WORDS = [f"w{i}" for i in range(3000)]


def item(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def brute(docs, items):
    """Every alignment of every pair, without seeds."""
    cut = lambda t: [w for w in re.split(r"[^\w]+", (t or "").lower()) if w]
    out = set()
    for d, text in docs:
        w = cut(text)
        for i, it in items:
            v = cut(it)
            if len(v) < decontam.SPAN:
                continue
            for off in range(-len(v) + 1, len(w)):
                same = [0 <= k + off < len(w) and w[k + off] == t for k, t in enumerate(v)]
                now = best = 0
                for s in same:
                    now = max(0, now + (1 if s else -2))
                    best = max(best, now)
                if sum(same) >= decontam.COVERAGE * len(v) or best >= decontam.STRETCH:
                    out.add((d, i))
    return out


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    items = [(i, item(rng, n)) for i, n in enumerate([30, 45, 16, 60, 20, 5])] + [(6, None), (7, "")]
    items.append((8, items[0][1].upper()))
    docs = []
    for d in range(60):
        words = item(rng, rng.randint(20, 200)).split()
        if d % 3 == 0:
            leak = items[rng.randrange(6)][1].split()
            if d % 2:  # every fifth word is replaced
                leak = [("new" if k % 5 == 2 else x) for k, x in enumerate(leak)]
            at = rng.randrange(len(words))
            words[at:at] = [x + rng.choice(["", ",", "###"]) for x in leak]
        docs.append((d, " ".join(words)))
    docs += [(100, None), (101, ""), (None, items[1][1]), (103, "x " * 20_000 + items[3][1]), (104, items[2][1]), (104, items[2][1])]
    got = decontam.leaks(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id long"),
                         spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = [(r.doc_id, r.item_id) for r in got]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == brute([d for d in docs if d[0] != 103], items) | {(103, 3)}
    assert all(r.matched <= r.item_tokens for r in got)


def test_shuffled_seeds_give_the_same(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, item(rng, 25)) for i in range(4)]
    docs = [(d, item(rng, 30) + " " + items[d % 4][1]) for d in range(8)]
    frames = (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    wide = sorted(map(tuple, decontam.leaks(*frames).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 0)
    assert sorted(map(tuple, decontam.leaks(*frames).collect())) == wide and len(wide) == 8


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(docs, items).collect() == []
    assert decontam.leaks(spark.createDataFrame([(1, "a b c")], docs.schema), items).collect() == []
