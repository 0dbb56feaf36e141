"""Near duplicates against a brute force over all links, whatever the distance of the fingerprints."""

import random

import pytest
from paceline.llm import simhash
from paceline.llm.simhash import fingerprint, shingle_hashes

WORDS = [f"w{i}" for i in range(5000)]


def brute(docs):
    """Of (doc_id, text): the smallest id of each group that links of 0.8 reach."""
    root = {d: d for d, _ in docs}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    sets = {d: set(shingle_hashes(t, 5).tolist()) for d, t in docs}
    for a in root:
        for b in root:
            both = len(sets[a] & sets[b])
            if a < b and (both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {d for d in root if top(d) == d}


def changed(rng, words, at):
    out = list(words)
    for i in at:
        out[i] = f"new{rng.random()}"
    return out


def kept(spark, docs):
    df = spark.createDataFrame([(d, " ".join(t), str(d)) for d, t in docs], "doc_id long, text string, _row string").repartition(5)
    return {int(r._row) for r in simhash.near_duplicates(df, "_row").where("kept").collect()}


def words(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


@pytest.mark.parametrize("changes", [2, 4])
def test_star_whose_centre_is_not_the_smallest_id(spark, changes):
    rng = random.Random(changes)
    base = words(rng, 200)
    docs = [(i, base if i == 130 else changed(rng, base, rng.sample(range(5, 195), changes))) for i in range(200)]
    assert kept(spark, docs) == brute([(d, " ".join(t)) for d, t in docs])


def test_chain(spark):
    """Each links to the next only; ids run in no order."""
    rng = random.Random(8)
    ids = rng.sample(range(1000), 30)
    now, docs = words(rng, 120), []
    for i, d in enumerate(ids):
        docs.append((d, now))
        now = changed(rng, now, [4 * i % 110 + 5, 4 * i % 110 + 6])
    docs += [(2000 + i, words(rng, n)) for i, n in enumerate([1, 3, 4, 5, 6, 7, 40, 300])]
    want = brute([(d, " ".join(t)) for d, t in docs])
    assert min(ids) in want and len(want) == 9
    assert kept(spark, docs) == want


def test_close_fingerprints_do_not_merge_different_texts(spark):
    """A line repeated 150 times decides the fingerprint; 300 words of each text are its own."""
    rng = random.Random(5)
    line = words(rng, 11)
    docs = [(i, line * 150 + [f"own{i}x{k}" for k in range(300)]) for i in range(3)]
    prints = {fingerprint(" ".join(t), 3) for _, t in docs}
    assert len(prints) == 1
    assert kept(spark, docs) == {0, 1, 2}


def test_pairs_beyond_eleven_bits(spark):
    """Blocks replaced and text appended up to 0.8, many pairs of which are further apart than 11 bits."""
    rng = random.Random(12)
    docs, far = [], 0
    for i in range(120):
        own = words(rng, rng.randint(60, 200))
        cut = int(len(own) * 0.17)
        other = own + words(rng, cut) if i % 2 else own[:20] + words(rng, cut // 2) + own[20 + cut // 2:]
        far += bin((fingerprint(" ".join(own), 3) ^ fingerprint(" ".join(other), 3)) & (2 ** 64 - 1)).count("1") > 11
        docs += [(2 * i, own), (2 * i + 1, other)]
    assert far > 5
    want = brute([(d, " ".join(t)) for d, t in docs])
    assert len(want) < 200 and kept(spark, docs) == want


def test_documents_of_the_smallest_size(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    df = spark.createDataFrame([(d, t, str(d)) for d, t in docs], "doc_id long, text string, _row string")
    assert {int(r._row) for r in simhash.near_duplicates(df, "_row").where("kept").collect()} == brute(docs)
