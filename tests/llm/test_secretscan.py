import random
import re

import pytest

from paceline.llm import secretscan
from paceline.llm.secretscan import BASE, MORE, Automaton, Rule

BITS = ["token", "Password", "passwd", "SECRET", "api_key", "apikey", "APIkey", "=", ":", " ", "  ", "'", '"', "AKIA", "abcdef0123456789",
        "ABCDEFGHIJKLMN", "deadbeef", "\n", ", ", "é", "日", "-----BEGIN ", "RSA ", "PRIVATE KEY", "-----", "eyJ", "abcdefghijkl", ".", "xoxb-",
        "ghp_", "a" * 36, "123456789012", "/", "ſecret", "\x00", "\x7f"]


def brute(text, rules=BASE + MORE):
    out = []
    for k, r in enumerate(rules):
        out += [(m.start(), k, m.end()) for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least]
    return [{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(out)]


@pytest.fixture(scope="module")
def automaton():
    return Automaton(BASE + MORE)


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_spans_against_regexes(automaton):
    own = [*texts(3000, 1), None, "", "token: password: secret=abcdefghijklmnop", "token: password: abcdefghijklmnopq", "AKIAAKIA" + "A" * 20]
    assert automaton.scan(own) == [brute(t) for t in own]


def test_pieces_and_stretches_change_nothing(automaton, monkeypatch):
    own = ["".join(texts(40, 2)), "".join(texts(40, 3)), "é" * 300, "f" * 5000, "AKIA" + "token=" * 2000, *texts(50, 4)]
    expected = [brute(t) for t in own]
    for piece, stretch in ((1, 1), (50, 3), (200, 64), (1 << 22, 1 << 9)):
        monkeypatch.setattr(secretscan, "PIECE", piece)
        monkeypatch.setattr(secretscan, "STRETCH", stretch)
        assert automaton.scan(own) == expected


def test_other_rules_compile():
    rng = random.Random(5)
    rules = (Rule("a", "(ab|a{2,3}c?)+x", 3), Rule("b", r"[^a\x20]{2}", 1), Rule("c", "x?(y|zz)*c{2}"), Rule("d", r"\[a\]"))
    own = ["".join(rng.choice("abcxyz [].") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    with pytest.raises(ValueError):
        Automaton((Rule("e", "a(b"),))
    for r in rules:
        one = Automaton((r,))
        for text, got in zip(own, one.scan(own)):
            # The longest match at a start; alternatives in another order may give the regex module a shorter one.
            ends, at, expected = re.compile(r.pattern), 0, []
            while at < len(text):
                e = max((e for e in range(at + 1, len(text) + 1) if ends.fullmatch(text, at, e)), default=0)
                if e:
                    expected += [{"kind": r.kind, "start": at, "end": e}] if e - at >= r.least else []
                at = e or at + 1
            assert got == expected


def test_job(spark):
    own = texts(200, 6)
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(own)] + [(7, own[7], "x", 1, "y"), (None, "token=abcdefghijklmn", "x", 1, "y"), (900, None, None, 0, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, kind string, start int, spans string")
    got = sorted([(r.doc_id, [s.asDict() for s in r.spans]) for r in secretscan.find_secrets(d).collect()], key=str)
    assert got == sorted([(i, brute(t)) for i, t, *_ in rows], key=str)
    assert secretscan.find_secrets(d.limit(0)).collect() == []
