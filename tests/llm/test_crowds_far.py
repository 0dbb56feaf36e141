"""Sets of a crowded place that have little in common: no differences of whole texts are listed, and no link is lost."""

import random

import numpy as np
import pytest
from paceline.llm import simhash
from tests.llm.test_near_duplicates import brute, changed, kept, words


def test_differences_of_unlike_texts_are_not_listed(spark, monkeypatch):
    """40 texts of 400 words that share a passage of 60 only, and copies of one of them."""
    rng, listed, write = random.Random(4), [], simhash.stage

    def staged(df, name):
        out = write(df, name)
        if name == "loose":
            listed.append(out.count())
        return out

    monkeypatch.setattr(simhash, "stage", staged)
    monkeypatch.setattr(simhash, "_common", lambda *_: (np.empty(0, np.uint64), np.empty(0, np.int64)))  # as if no shingle were known as common
    passage = words(rng, 60)
    docs = [(i, words(rng, 170) + passage + words(rng, 170)) for i in range(40)]
    docs += [(40 + i, changed(rng, docs[7][1], rng.sample(range(400), 9))) for i in range(5)]
    assert kept(spark, docs) == brute([(d, " ".join(t)) for d, t in docs])
    assert sum(listed) < 4000  # 396 shingles a text


@pytest.mark.parametrize("near", [0.02, 0.2])
def test_several_leaders_of_a_place(spark, monkeypatch, near):
    """Crowds of several texts that share a passage; each place has further leaders until few sets are far."""
    monkeypatch.setattr(simhash, "FEW", 1)
    monkeypatch.setattr(simhash, "_LEFT", 2)
    monkeypatch.setattr(simhash, "NEAR", near)
    monkeypatch.setattr(simhash, "ROUNDS", 0)
    rng = random.Random(5)
    passage = words(rng, 30)
    centres = [words(rng, n) + passage for n in (10, 30, 30, 60)]
    docs = [(i, changed(rng, own, rng.sample(range(len(own)), rng.randint(0, 3))))
            for i in range(120) for own in [rng.choice(centres)]]
    assert kept(spark, docs) == brute([(d, " ".join(t)) for d, t in docs])


def test_sketches_never_say_too_much():
    rng = np.random.default_rng(6)
    for _ in range(200):
        sets = [rng.choice(rng.integers(0, 1 << 63, 400).astype(np.uint64), rng.integers(1, 400), replace=False) for _ in range(2)]
        both = rng.integers(0, 1 << 63, rng.integers(0, 3000)).astype(np.uint64)
        x, y = (np.unique(np.concatenate([s, both])) for s in sets)
        for bits in (64, 512, 1 << 18):
            assert simhash.apart(simhash.sketch(x), simhash.sketch(y), bits) <= len(np.setxor1d(x, y))
        assert simhash.apart(simhash.sketch(x), simhash.sketch(x)) == 0
