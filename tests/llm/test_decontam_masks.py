"""Every pattern of replaced tokens that is a leak has a seed."""

import itertools
import random

from paceline.llm import decontam


def seeded(same):
    return any(all(same[i + o] for o in mask) for i in range(len(same) - decontam.SPAN + 1) for mask in decontam.MASKS)


def most_matched(top):
    """For each length the most matches of a pattern without a seed, and the best stretch of such a pattern, over all patterns."""
    span, best, high, out = decontam.SPAN, {(): (0, 0)}, 0, [0]
    for _ in range(top):
        new = {}
        for last, (n, run) in best.items():
            for hit in (0, 1):
                now = (*last, hit)
                if len(now) == span and seeded(now):
                    continue
                got = (n + hit, max(0, run + (1 if hit else -2)))
                key = now[-(span - 1):]
                old = new.get(key, (0, 0))
                new[key] = (max(old[0], got[0]), max(old[1], got[1]))
        best = new
        high = max(high, max(r for _, r in best.values()))
        out.append(max(n for n, _ in best.values()))
    return out, high


def test_every_leak_has_a_seed():
    most, stretch = most_matched(400)
    assert stretch < decontam.STRETCH
    assert [n for n in range(8, 401) if most[n] >= decontam.COVERAGE * n] == []
    # The search by states agrees with all patterns written out.
    for n in range(7, 13):
        assert most[n] == max(sum(p) for p in itertools.product((0, 1), repeat=n) if not seeded(p))


def test_every_fourth_token_replaced(spark):
    rng = random.Random(3)
    items = [(i, [f"v{rng.randrange(3000)}" for _ in range(n)]) for i, n in enumerate([8, 15, 16, 20, 45, 200])]
    docs = [(i, " ".join(["a"] * 5 + [("new" if k % 4 == 3 else t) for k, t in enumerate(words)] + ["b"] * 5)) for i, words in items]
    got = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(6)]
