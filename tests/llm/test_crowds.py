"""Crowds of near copies that do not link: compared by what they differ in from a leader, with the links of brute force."""

import random

import pytest
from paceline.llm import simhash
from tests.llm.test_near_duplicates import brute, changed, kept, words


def asked_by(monkeypatch):
    """Numbers of pairs that are asked for, in the order of the rounds."""
    counts, confirm = [], simhash._confirmed

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return confirm(pairs, *rest)

    monkeypatch.setattr(simhash, "_confirmed", counted)
    return counts


def test_pairs_of_a_crowd_grow_with_its_size(spark, monkeypatch):
    """Copies of one text with one to three of 120 words changed: most of the pairs do not link."""
    rng = random.Random(3)
    base = words(rng, 120)
    docs = [(i, changed(rng, base, rng.sample(range(120), rng.randint(1, 3)))) for i in range(300)]
    counts = asked_by(monkeypatch)
    got = kept(spark, docs)
    assert got == brute([(d, " ".join(t)) for d, t in docs])
    assert sum(counts) < 20 * len(docs)


@pytest.mark.parametrize("seed", range(2))
def test_crowds_of_several_centres(spark, monkeypatch, seed):
    """Copies of copies, texts cut short and texts with an appendix, many of them near the limit; each place is a crowd."""
    monkeypatch.setattr(simhash, "FEW", 2)
    monkeypatch.setattr(simhash, "ROUNDS", seed % 2)  # without rounds all links but those of SimHash are left to the last step
    rng = random.Random(seed)
    centres = [words(rng, rng.choice([12, 40, 90]))]
    for _ in range(5):
        own = changed(rng, centres[0], rng.sample(range(len(centres[0])), max(1, len(centres[0]) // 25)))
        centres.append(own + words(rng, rng.randint(0, len(own) // 6)))
    centres.append(words(rng, 25))
    docs = []
    for i in range(150):
        own = rng.choice(centres)
        own = own[:len(own) - rng.randint(0, len(own) // 5)]
        docs.append((i, changed(rng, own, rng.sample(range(len(own)), rng.randint(0, 3)))))
    want = brute([(d, " ".join(t)) for d, t in docs])
    assert 3 < len(want) < 148 and kept(spark, docs) == want
