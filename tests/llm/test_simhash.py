import random

import numpy as np
import pytest
import xxhash

from paceline.llm import common, simhash

WORDS = [f"w{i}" for i in range(400)]


def brute_print(text, shingle=3):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    size = min(shingle, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints, radius):
    n = len(prints)
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(n)]


def texts():
    rng = random.Random(3)
    out = [None, "", "  \n\t ", "One", "one", "ONE two", "ÄÖ ÜB", "äÖ üB", "a b c", "a  b\nc", "x " * 30_000]
    for _ in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.randint(60, 300))]
        for _ in range(3):
            copy = base[:]
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("radius,parts,spread", [(2, 3, 0), (2, 4, 0), (3, 3, 0), (4, 3, 1), (8, 4, 1)])
def test_near_pairs_are_exact(spark, radius, parts, spread):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 40)
    prints = set()
    for b in base:
        for _ in range(12):
            flips = rng.choice(63, rng.integers(0, 7), replace=False)
            prints.add(int(b) ^ sum(1 << int(f) for f in flips))
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    got = sorted(map(tuple, simhash.near_pairs(df, radius, parts, spread).collect()))
    want = sorted((a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if bin(a ^ b).count("1") <= radius)
    assert got == want


def test_crowded_places_take_the_whole_print(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PROBE_COST", 0.001)
    rng = np.random.default_rng(2)
    prints = sorted({int(x) for x in rng.integers(0, 1 << 10, 200)})
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    want = sum(1 for i, a in enumerate(prints) for b in prints[i + 1:] if bin(a ^ b).count("1") <= 2)
    assert simhash.near_pairs(df).count() == want


def test_thresholds_are_cheapest():
    rng = np.random.default_rng(0)
    cost = rng.random((50, 3, 4))
    cost[:, :, 0] = 0
    got, total = simhash.thresholds(cost, 0)
    for q in range(50):
        best = min(((sum(cost[q, p, t[p] + 1] for p in range(3)), t) for t in np.ndindex(4, 4, 4)
                    for t in [tuple(x - 1 for x in t)] if sum(t) == 0))
        assert total[q] == pytest.approx(best[0]) and tuple(got[q]) == best[1]


def test_groups_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "a b c", "y"), (7, "repeated", "z"), (7, "repeated", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    got = simhash.near_groups(df).collect()
    assert len(got) == len(rows)
    prints = [brute_print(t) for _, t, _ in rows]
    tops = brute_groups(prints, 2)
    least = {}
    for (i, _, _), t in zip(rows, tops):
        if i is not None:
            least[t] = min(least.get(t, i), i)
    want = sorted(str((i, p if p < 2 ** 63 else p - 2 ** 64, least.get(t))) for (i, _, _), p, t in zip(rows, prints, tops))
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(df).collect() == []
    assert simhash.near_duplicates(df.selectExpr("*", "'x' AS _row"), "_row").collect() == []


def test_components_of_chains_stars_and_circles(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(500, 560)] + [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    pairs += [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(60)] + [(1, 1), (5, 6)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(top(a), top(b))] = min(top(a), top(b))
    nodes = sorted(got)
    assert nodes == sorted({x for a, b in pairs if a != b for x in (a, b)})
    assert {(x, y) for x in nodes for y in nodes if got[x] == got[y]} == {(x, y) for x in nodes for y in nodes if top(x) == top(y)}


def test_near_duplicates_keep_one_of_each_group(spark):
    rng = random.Random(9)
    rows = []
    for g in range(12):
        base = [rng.choice(WORDS) for _ in range(200)]
        for c in range(4):
            copy = base[:]
            if c == 2:
                copy[50] = "changed"
            if c == 3:  # a third of the words differ: not a near copy
                copy[:70] = [rng.choice(WORDS) for _ in range(70)]
            rows.append((10 * g + c, " ".join(copy)))
    rows += [(900, None), (901, ""), (None, "alone and without an id here")]
    df = spark.createDataFrame([(*r, f"r{i}") for i, r in enumerate(rows)], "doc_id long, text string, _row string")
    kept = {r._row for r in simhash.near_duplicates(df, "_row").where("kept").collect()}
    want = {f"r{i}" for i, (d, _) in enumerate(rows) if d is None or d == 900 or d < 900 and d % 10 in (0, 3)}
    assert kept == want
