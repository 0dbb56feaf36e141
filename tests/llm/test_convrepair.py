import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from paceline.llm import convrepair

SCHEMA = "conv_id long, turn long, role string, text string, edit string, part long, _rid long, audit string"
NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        said = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(said).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    """One conversation, with all best edit strings kept whole."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(convrepair.WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {q: (c, "I" * (c // 2)) for q, c in (("0", 0), ("s", 4), ("u", 2), ("a", 0))}
    for (_, role, _), fault in zip(rows[::-1], faults[::-1]):
        cut, now = int(fault == "truncated"), {}
        for q in best:
            own = [(3 + best[q][0], "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                c, tail = best[NEXT[q]]
                own.append((2 + cut + c, "R" + tail))
                if role[:1] == NEXT[q]:
                    own.append((cut + c, "K" + tail))
                if role[:1] == "s" and q == "0":
                    own.append((cut + best["s"][0], "K" + best["s"][1]))
            now[q] = min(own)
        for _ in range(3):
            now = {q: min(now[q], (2 + now[NEXT[q]][0], "I" + now[NEXT[q]][1])) for q in now}
        best = now
    cost, audit = best["0"]
    out, q, left = [], "0", iter(rows)
    for e in audit:
        if e == "I":
            q = NEXT[q]
            out.append(f"{NAME[q]}:")
        else:
            _, role, text = next(left)
            if e != "D":
                q = "s" if e == "K" and role[:1] == "s" else NEXT[q]
                out.append(f"{role if e == 'K' else NAME[q]}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def expected(rows):
    groups = defaultdict(list)
    for conv, *row in damaged(rows):
        groups[conv].append(tuple(row))
    return {c: brute(groups[c]) if c in groups else (0, 0, 0, 0, 0, 0, "", EMPTY) for c in {r[0] for r in rows}}


def run(spark, rows):
    d = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(3)
    out = convrepair.repair_all(convrepair.damage(d), d).collect()
    assert len(out) == len({r[0] for r in rows})
    return {r[0]: tuple(r)[1:] for r in out}


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["Yes.", "No", " ", "", "why? ", "é!\n", "a\n\n", "\x0b.", "ok.", "ok", "Was ist?"]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, most)):
            rows.append((c if c else None, rng.choice([t, t, t, t + 5, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "", None, "util", "Sys"]), rng.choice(texts)))
    return rows


def test_against_brute_force(spark):
    rows = random_rows(1, 150, 9)
    assert run(spark, rows) == expected(rows)


def test_long_conversations_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(convrepair, "LEAST_BLOCK", 3)
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), f"{rng.randint(0, 300)}{rng.choice(['.', '', '!'])}") for t in range(900)]
    rows += [(8, t, "system", f"{t}.") for t in range(60)] + [(9, None, "user", "x.")] * 70 + random_rows(3, 5, 30)
    assert run(spark, rows) == expected(rows)


def test_turns_that_repair_leaves(spark):
    rows = random_rows(4, 20, 9)
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = sorted(convrepair.repaired_turns(convrepair.damage(d)).collect(), key=lambda r: r["at"])
    for c, want in expected(rows).items():
        own = [t for t in turns if t.conv_id == c]
        assert "".join(t.edit for t in own) == want[6]
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in own if t.edit != "D").encode()).hexdigest() == want[7]


@pytest.mark.parametrize("size", [1, 4, 17])
def test_checkpoints_hold_the_costs_of_the_full_search(size):
    codes = np.random.default_rng(size).integers(0, 9, 60)
    full = convrepair.block_vectors(codes[None], convrepair._END)[:, 0]
    blocks = [codes[a:a + size] for a in range(0, 60, size)]
    kept = convrepair.checkpoints(convrepair.block_tables(convrepair._padded(blocks)))
    assert (kept == full[[*range(0, 60, size), 60]]).all()


def test_empty_table(spark):
    d = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert convrepair.repair_all(convrepair.damage(d), d).collect() == []
