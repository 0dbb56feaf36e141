import random

from paceline.llm import linededup

WORDS = [f"w{i}" for i in range(50)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs):
    """Every pair of lines is compared."""
    lines = sorted(((d is not None, d or 0), n, t) for d, text in dict.fromkeys(docs) if text is not None for n, t in enumerate(text.split("\n")))
    gone = set()
    for k, (d, n, t) in enumerate(lines):
        w = t.split()
        for d2, n2, t2 in lines[:k]:
            v = t2.split()
            if w and (t == t2 or min(len(w), len(v)) >= linededup.MIN_WORDS and edits(w, v) <= 1):
                gone.add((d, n))
                break
    return [(d, None if text is None else "\n".join(t for n, t in enumerate(text.split("\n")) if ((d is not None, d or 0), n) not in gone))
            for d, text in docs]


def test_against_brute_force(spark):
    rng = random.Random(8)
    bases = [[rng.choice(WORDS) for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 14]))] for _ in range(25)]
    docs = []
    for d in range(40):
        lines = []
        for _ in range(rng.randint(1, 6)):
            w = rng.choice(bases)[:]
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(w) + 1)
                how = rng.randrange(3)
                w = w[:at] + [rng.choice(WORDS)] * (how > 0) + w[at + (how < 2):]
            lines.append(rng.choice([" ", "  "]).join(w))
        docs.append((d, "\n".join(lines)))
    docs += [(None, docs[3][1]), (50, None), (51, ""), (52, "\n\n  \n"), (53, docs[0][1]), (53, docs[0][1]), (54, "long " * 3000), (55, "long " * 2999)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, line int").repartition(4)
    got = linededup.dedup_lines(df).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(map(str, brute(docs)))
    for r in got:
        if r.text:
            assert r.n_lines - r.n_exact - r.n_near == len(r.text.split("\n"))


def test_many_variants_of_one_line(spark):
    docs = [(i, f"a b c d e f g x{i}") for i in range(300)]
    got = linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [r.doc_id for r in got if r.text] == [0] and sum(r.n_near for r in got) == 299


def test_empty(spark):
    assert linededup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_lines(spark):
    """A line of many words costs time in proportion; words that repeat and orders that differ are no edits."""
    w = [f"w{i % 9000}" for i in range(60_000)]
    other = w[:30_000] + ["new"] + w[30_001:]
    turned = w[:10] + [w[11], w[10]] + w[12:]
    docs = [(1, " ".join(w)), (2, " ".join(other)), (3, " ".join(turned)), (4, " ".join(w[:-1])), (5, "a a a b a a"), (6, "a a a a b a"), (7, "a a a b a")]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == dict(brute_short(docs))


def brute_short(docs):
    """As ``brute``, with the one edit sought between the common ends."""
    kept, seen = [], []
    for d, text in docs:
        w = text.split()
        near = any(abs(len(w) - len(v)) <= 1 and one_edit(w, v) for v in seen)
        kept.append((d, "" if near else text))
        seen.append(w)
    return kept


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[head + (len(a) == len(b)):] == b[head + 1:]
