"""Secret scans by one deterministic automaton over bytes, compiled from the regexes of all rules.

The rules become one non-deterministic automaton, subset construction makes it deterministic,
refinement of partitions makes it minimal, and bytes that no rule tells apart share a column of the
transition array. Two such arrays are built: one that may begin a rule at every byte finds where a
rule ends, in one pass over the bytes for all rules; one that begins at a given byte then reads the
spans around these places. A byte that leads back to the start from every state (most of those that
no rule holds) parts a text into stretches that know nothing of each other, so many stretches of
many texts advance in step, one array lookup per byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import in_pieces


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` knows literals, ``[...]``, ``(...)``, ``|``, ``? * + {m,n}`` and ``\\xNN``, all in ASCII.

    From its start a match reaches as far as it can. It counts if ``group`` (0: the whole) has ``least`` characters or more.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


# The base rules, then formats that services publish for their tokens and keys.
BASE = (
    Rule("assign", "(" + "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + either_case("api") + "_?"
         + either_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)

#: Stands between texts; no rule may hold it, and it occurs in no UTF-8.
_GAP = 255
#: Bytes that one pass works on, and bytes of one stretch on average.
PIECE, STRETCH = 1 << 22, 1 << 9


class _Graph:
    """Non-deterministic automaton: silent steps and steps on a set of bytes."""

    def __init__(self) -> None:
        self.silent: list[list[int]] = []
        self.step: list[tuple[frozenset[int], int] | None] = []

    def new(self) -> int:
        self.silent.append([])
        self.step.append(None)
        return len(self.step) - 1

    def add(self, pattern: str, at: int) -> int:
        """Read ``pattern`` from state ``at``; returns the state after it."""
        self.text, self.pos = pattern, 0
        end = self._any_of(at)
        if self.pos < len(pattern):
            raise ValueError(f"unexpected {pattern[self.pos]!r} at {self.pos} in {pattern!r}")
        return end

    def _peek(self) -> str:
        return self.text[self.pos:self.pos + 1]

    def _any_of(self, at: int) -> int:
        ends = [self._row(at)]
        while self._peek() == "|":
            self.pos += 1
            start = self.new()
            self.silent[at].append(start)
            ends.append(self._row(start))
        if len(ends) == 1:
            return ends[0]
        out = self.new()
        for e in ends:
            self.silent[e].append(out)
        return out

    def _row(self, at: int) -> int:
        own = self.new()
        self.silent[at].append(own)
        while self._peek() not in ("", "|", ")"):
            own = self._repeated(own)
        return own

    def _repeated(self, at: int) -> int:
        here = self.pos
        self._one(self.new())  # a dry run finds the end of the part
        found = re.compile(r"[?*+]|\{(\d+)(,?)(\d*)\}").match(self.text, self.pos)
        after = found.end() if found else self.pos
        low, high = 1, 1
        if found:
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(found[0], (0, 0))
            if found[0][0] == "{":
                low = int(found[1])
                high = int(found[3]) if found[3] else None if found[2] else low

        def again(state: int) -> int:
            self.pos = here
            return self._one(state)

        for _ in range(low):
            at = again(at)
        if high is None:
            loop = self.new()
            self.silent[at].append(loop)
            self.silent[again(loop)].append(loop)
            at = self.new()
            self.silent[loop].append(at)
        else:
            out = self.new()
            for _ in range(high - low):
                self.silent[at].append(out)
                at = again(at)
            self.silent[at].append(out)
            at = out
        self.pos = after
        return at

    def _one(self, at: int) -> int:
        if self._peek() == "(":
            self.pos += 1
            out = self._any_of(at)
            if self._peek() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.pos += 1
            return out
        out = self.new()
        self.step[at] = (self._set(), out)
        return out

    def _char(self) -> str:
        c = self._peek()
        self.pos += 1
        if c != "\\":
            return c
        c = self._peek()
        self.pos += 1
        if c == "x":
            self.pos += 2
            return chr(int(self.text[self.pos - 2:self.pos], 16))
        if c == "" or c.isalnum():
            raise ValueError(f"unknown escape in {self.text!r}")
        return c

    def _set(self) -> frozenset[int]:
        if self._peek() != "[":
            if self._peek() in (*"?*+{}].^$", ""):
                raise ValueError(f"unexpected {self._peek()!r} at {self.pos} in {self.text!r}")
            chars = {ord(self._char())}
        else:
            self.pos += 1
            turned = self._peek() == "^"
            self.pos += turned
            chars = set()
            while self._peek() != "]" or not chars:
                if not self._peek():
                    raise ValueError(f"unclosed class in {self.text!r}")
                a = ord(self._char())
                if self._peek() == "-" and self.text[self.pos + 1:self.pos + 2] not in ("]", ""):
                    self.pos += 1
                    chars |= set(range(a, ord(self._char()) + 1))
                else:
                    chars.add(a)
            self.pos += 1
            if turned:
                chars = set(range(128)) - chars
        if max(chars) > 127:
            raise ValueError(f"only ASCII in {self.text!r}")
        return frozenset(chars)


def _minimal(table: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart. The start stays state 0."""
    label = np.unique(accept, return_inverse=True)[1]
    while True:
        again = np.unique(np.column_stack([label, label[table]]), axis=0, return_inverse=True)[1].ravel()
        if again.max() == label.max():
            break
        label = again
    first = np.unique(label, return_index=True)[1]
    order = np.argsort(first)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    keep = first[order]
    return rank[label[table[keep]]], accept[keep]


class Automaton:
    """All rules in two transition arrays over classes of bytes."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        graph = _Graph()
        start = graph.new()
        ends = {}
        for k, rule in enumerate(rules):
            own = graph.new()
            graph.silent[start].append(own)
            ends[graph.add(rule.pattern, own)] = 1 << k
        sets = sorted({s[0] for s in graph.step if s}, key=sorted)
        held = np.array([[b in s for s in sets] for b in range(256)], bool)
        kinds, self.class_of = np.unique(held, axis=0, return_inverse=True)
        self.class_of = self.class_of.ravel().astype(np.uint8)
        inside = {s: np.flatnonzero(kinds[:, i]).tolist() for i, s in enumerate(sets)}

        def closure(states) -> frozenset[int]:
            out, todo = set(states), list(states)
            while todo:
                for t in graph.silent[todo.pop()]:
                    if t not in out:
                        out.add(t)
                        todo.append(t)
            return frozenset(out)

        def build(anywhere: bool) -> tuple[np.ndarray, np.ndarray]:
            first = closure([start])
            number, todo, rows, accept = {first: 0}, [first], [], []
            for own in todo:
                to = [set() for _ in kinds]
                for s in own:
                    if graph.step[s]:
                        for c in inside[graph.step[s][0]]:
                            to[c].add(graph.step[s][1])
                row = []
                for t in to:
                    new = closure(t) | first if anywhere else closure(t)
                    if new not in number:
                        number[new] = len(number)
                        todo.append(new)
                    row.append(number[new])
                rows.append(row)
                accept.append(sum({ends[s] for s in own if s in ends}))
            return _minimal(np.array(rows, np.int64), np.array(accept, np.int64))

        table, accept = build(True)
        self.width = len(kinds)
        # A state is known by the place of its row, so that a step is one addition and one lookup.
        self.table, self.found = table.astype(np.int32).ravel() * self.width, np.repeat(accept > 0, self.width)
        at, self.ends = build(False)
        # The rules that a state can still complete.
        may = self.ends.copy()
        while True:
            more = may | np.bitwise_or.reduce(may[at], axis=1)
            if (more == may).all():
                break
            may = more
        # By byte: nothing goes on after it, whatever came before. (The minimal search array can't tell: it forgets optional beginnings.)
        self.parts = (may[at] == 0).all(0)[self.class_of]
        self.at, self.may, self.ends = at.tolist(), may.tolist(), self.ends.tolist()
        self.exact = [re.compile(r.pattern) for r in rules]

    def places(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ascending (start, end) of the stretches of ``data`` in which a rule ends; ``data`` ends with a parting byte."""
        kind, parts = self.class_of[data], np.flatnonzero(self.parts[data])
        goals = np.arange(0, len(data), STRETCH)[1:]
        cuts = np.unique(np.concatenate([[0], parts[np.searchsorted(parts, goals)] + 1, [len(data)]]))
        start, length = cuts[:-1], np.diff(cuts)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        alive = np.searchsorted(-length, -np.arange(length[0]), side="left")  # stretches longer than each step
        state, hits = np.zeros(len(start), np.int32), []
        for i, n in enumerate(alive.tolist()):
            here = start[:n] + i
            now = self.table[state[:n] + kind[here]]
            state[:n] = now
            seen = self.found[now]
            if seen.any():
                hits.append(here[seen])
        if not hits:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hits = np.concatenate(hits)
        after = np.unique(np.searchsorted(parts, hits))
        return np.where(after > 0, parts[np.maximum(after - 1, 0)] + 1, 0), parts[after]

    def spans(self, stretch: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of the leftmost matches of each rule that don't overlap, by start; each as long as can be."""
        kind, n = self.class_of[np.frombuffer(stretch, np.uint8)].tolist(), len(stretch)
        free, out = [0] * len(self.rules), []
        at, may, ends = self.at, self.may, self.ends
        for p in range(n):
            s = at[0][kind[p]]
            if not may[s]:
                continue
            able = sum(1 << k for k, f in enumerate(free) if f <= p)
            q, last = p + 1, {}
            while may[s] & able:
                for k in range(len(free)) if ends[s] & able else ():
                    if ends[s] & able & 1 << k:
                        last[k] = q
                if q == n:
                    break
                s = at[s][kind[q]]
                q += 1
            for k, end in sorted(last.items()):
                out.append((p, k, end))
                free[k] = end
        return [(p, k, e) for p, k, e in out if self._counts(k, stretch[p:e])]

    def _counts(self, k: int, found: bytes) -> bool:
        rule = self.rules[k]
        if not rule.group:
            return len(found) >= rule.least
        match = self.exact[k].fullmatch(found.decode("ascii"))
        return match is not None and len(match[rule.group]) >= rule.least

    def scan(self, texts: list[str | None]) -> list[list[dict]]:
        """Spans of every text in code points, by start, then in the order of the rules."""
        out: list[list[dict]] = [[] for _ in texts]
        held: list[tuple[int, int, bytes]] = []  # text, its code points before the piece, piece
        size = 0
        for i, text in enumerate(texts):
            data, at, before = (text or "").encode(), 0, 0
            while at < len(data):
                end = self._cut(data, at + PIECE)
                held.append((i, before, data[at:end]))
                size += end - at
                if end < len(data):
                    before += len(data[at:end].decode())
                at = end
                if size >= PIECE:
                    self._scan_pieces(held, out)
                    held, size = [], 0
        self._scan_pieces(held, out)
        return out

    def _cut(self, data: bytes, at: int) -> int:
        """First end of a piece from ``at`` on: after a parting byte, and between characters."""
        while at < len(data):
            part = np.frombuffer(data[at:at + (1 << 16)], np.uint8)
            good = np.flatnonzero(self.parts[part[:-1]] & (part[1:] & 0xC0 != 0x80))
            if len(good):
                return at + int(good[0]) + 1
            at += max(len(part) - 1, 1)
        return len(data)

    def _scan_pieces(self, held: list[tuple[int, int, bytes]], out: list[list[dict]]) -> None:
        if not held:
            return
        gap = bytes([_GAP])
        joined = gap.join(piece for _, _, piece in held) + gap
        data = np.frombuffer(joined, np.uint8)
        start, end = self.places(data)
        if not len(start):
            return
        first = np.cumsum([0] + [len(piece) + 1 for _, _, piece in held])
        chars = np.concatenate([np.zeros(1, np.int32), np.cumsum(data & 0xC0 != 0x80, dtype=np.int32)])
        for a, b in zip(start.tolist(), end.tolist()):
            j = int(np.searchsorted(first, a, side="right")) - 1
            i, before, _ = held[j]
            base = before - chars[first[j]]
            for p, k, e in self.spans(joined[a:b]):
                out[i].append({"kind": self.rules[k].kind, "start": int(base + chars[a + p]), "end": int(base + chars[a + e])})


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(doc_id, spans): the secrets of every whole text, one row per row of ``docs``.

    ``spans`` lists kind, start and end (exclusive, in code points) by start, then in the order of
    the rules. Matches of one rule don't overlap and the leftmost wins, also where it is dropped for
    being too short; different rules may overlap. NULL and empty texts have no spans; repeated rows
    come out alike; an empty table gives an empty result; other columns, whatever their names, are
    ignored. Texts of any length are read piece by piece.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(rules))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = shared.value.scan(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = in_pieces(rows).mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:int,end:int>>")
    return out.withColumnRenamed("doc_id", doc_id)
