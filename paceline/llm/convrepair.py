"""Structure repair of conversations: cheapest edits that leave an optional system turn and user/assistant pairs.

A conversation passes through four states (nothing said, system said, user said, assistant said), so
what remains to be paid from a row on is a vector of four costs. Vectors are kept at checkpoints
only, one per block of about the square root of the conversation's rows. Each block is reduced to a
4 x 4 table of costs from state to state, which gives the vectors at all checkpoints, backwards;
then each block computes its own vectors anew from the checkpoint behind it and walks forward along
tight edits, the ASCII-least first. Blocks are worked on apart from each other, and what crosses
them is one small row per block. So a conversation of any length is spread over many tasks; only
its digest, which has one running hash, is read by one task, row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paceline.llm.common import in_pieces
from paceline.session import discard, stage

WHITE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
#: Rows of a block at least; a conversation of up to so many is one block.
LEAST_BLOCK = 64

#: States: nothing, system, user, assistant said. A row's code: 0 to 3 for the role (s, u, a, other), 4 more if truncated, 8 if it must go.
_GONE, _NONE = 8, 9
_FAR = 1 << 40
_NEXT = (2, 2, 3, 2)  # the state after the turn that may follow, which is also the one that an insert adds
_ROLE = {2: "u", 3: "a"}
_NAMES = {"u": "user", "a": "assistant"}


def _choices(code: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits that consume a row: (initial, cost, state after)."""
    out = []
    for q in range(4):
        own = [("D", DELETE, q)]
        if code < _GONE:
            role, cut = code & 3, CUT * (code >> 2)
            if role == 0 and q == 0:
                own.append(("K", cut, 1))
            if (role, q) in ((1, 0), (1, 1), (1, 3), (2, 2)):
                own.append(("K", cut, _NEXT[q]))
            own.append(("R", REROLE + cut, _NEXT[q]))
        out.append(own)
    return out


_CHOICES = [_choices(c) for c in range(_GONE + 1)]
#: Costs of inserts from state to state, of inserts and a row by code (the last: no row), and of the end.
_INSERTS = np.array([[0, _FAR, 2, 4], [_FAR, 0, 2, 4], [_FAR, _FAR, 0, 2], [_FAR, _FAR, 2, 0]], np.int64) * INSERT // 2
_STEPS = np.full((10, 4, 4), _FAR, np.int64)
for _c, _rows in enumerate(_CHOICES):
    for _q, _own in enumerate(_rows):
        for _, _cost, _to in _own:
            _STEPS[_c, _q, _to] = min(_STEPS[_c, _q, _to], _cost)
    _STEPS[_c] = np.minimum((_INSERTS[:, :, None] + _STEPS[_c][None]).min(1), _FAR)
_STEPS[_NONE][range(4), range(4)] = 0
_END = np.minimum(_INSERTS[:, 0], _INSERTS[:, 3])


def _padded(codes: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(codes), max(map(len, codes), default=0)), _NONE, np.int64)
    for i, c in enumerate(codes):
        out[i, :len(c)] = c
    return out


def block_tables(codes: np.ndarray) -> np.ndarray:
    """Costs from state to state over each row of ``codes`` (blocks by places), all blocks in step."""
    total = np.broadcast_to(_STEPS[_NONE], (len(codes), 4, 4))
    for at in range(codes.shape[1]):
        total = np.minimum((total[:, :, :, None] + _STEPS[codes[:, at]][:, None]).min(2), _FAR)
    return total


def block_vectors(codes: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs to the end of the conversation, by place (from the block's start to its end), block and state."""
    out = np.empty((codes.shape[1] + 1, len(codes), 4), np.int64)
    out[-1] = end
    for at in range(codes.shape[1] - 1, -1, -1):
        out[at] = np.minimum((_STEPS[codes[:, at]] + out[at + 1][:, None]).min(2), _FAR)
    return out


def checkpoints(tables: np.ndarray) -> np.ndarray:
    """Cost vectors at the end of each block of one conversation, and before them the one at its start."""
    out = [_END]
    for t in tables[::-1]:
        out.append(np.minimum((t + out[-1]).min(1), _FAR))
    return np.array(out[::-1])


def walk(codes: list[int], left: list[list[int]], state: int, last: bool) -> tuple[list[tuple[str, str, str, str]], int]:
    """Follow the ASCII-least tight edits through a block.

    Returns (edit, roles inserted before, role given or kept, roles inserted after) of each row, and the state at the end.
    """
    out, said = [], ""
    for at, code in enumerate(codes):
        while True:
            owed = left[at][state]
            if DELETE + left[at + 1][state] == owed:
                out.append(("D", said, "", ""))
                break
            up = _NEXT[state]
            if INSERT + left[at][up] == owed:
                said += _ROLE[up]
                state = up
                continue
            edit, to = next((e, to) for e, cost, to in _CHOICES[code][state] if e != "D" and cost + left[at + 1][to] == owed)
            out.append((edit, said, _ROLE.get(to, "s") if edit == "R" else "", ""))
            state = to
            break
        said = ""
    while last and left[-1][state]:
        state = _NEXT[state]
        said += _ROLE[state]
    if said:
        out[-1] = (*out[-1][:3], said)
    return out, state


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` rows (conv_id, turn, role, text) with faults planted by CRC-32 of id and turn; NULLs are one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(said("role"))
    times = F.when(kind == 3, 2).otherwise(1)
    return (rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_"))
            .drop("_"))


#: Key columns of a conversation; NULL ids are one conversation.
KEYS = ["_c", "_n"]


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows in order with a growing number ``_rid`` whose upper bits are the partition. Long conversations span many partitions."""
    own = rows.select(F.coalesce("conv_id", F.lit(0)).alias("_c"), F.col("conv_id").isNull().alias("_n"), F.col("turn"),
                      F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    order = [*KEYS, "turn", "role", "text"]
    placed = own.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_rid", F.monotonically_increasing_id())
    return stage(placed, "turns")


def _coded(rows: DataFrame) -> DataFrame:
    """(keys, turn, _rid, fault, code): the first fault of each row."""
    name = F.sha2(F.concat(F.col("role"), F.lit("\0"), F.sha2("text", 256)), 256)
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    seen = rows.select(*KEYS, "turn", "_rid", F.substring("role", 1, 1).alias("_r"), name.alias("_name"),
                       (bare == "").alias("_blank"), F.substring(bare, -1, 1).isin(".", "!", "?").alias("_whole"))
    first = seen.groupBy(*KEYS, "_name").agg(F.min("_rid").alias("_rid")).select("_rid", F.lit(True).alias("_first"))
    fault = (F.when(F.col("_blank"), "blank").when(F.col("_first").isNull(), "duplicate").when(~F.col("_whole"), "truncated"))
    role = F.when(F.col("_r") == "s", 0).when(F.col("_r") == "u", 1).when(F.col("_r") == "a", 2).otherwise(3)
    out = seen.join(first, "_rid", "left").select(*KEYS, "turn", "_rid", role.alias("role"), fault.alias("fault"))
    code = F.when(F.col("fault").isin("blank", "duplicate"), _GONE).otherwise(F.col("role") + F.when(F.col("fault") == "truncated", 4).otherwise(0))
    return stage(out.withColumn("code", code), "codes")


def _blocks(coded: DataFrame) -> DataFrame:
    """(keys, part, block, rids, codes, roles): the rows of each block, in order."""
    part = F.shiftright("_rid", 33).alias("part")
    parts = coded.groupBy(*KEYS, part).agg(F.min("_rid").alias("_base"), F.count(F.lit(1)).alias("_rows"))
    n = F.sum("_rows").over(W.partitionBy(*KEYS))
    parts = parts.select(*KEYS, "part", "_base", F.greatest(F.ceil(F.sqrt(n)), F.lit(LEAST_BLOCK)).cast("long").alias("_size"))
    rows = coded.select(*KEYS, part, "_rid", "code", "role").join(parts, [*KEYS, "part"])
    rows = rows.withColumn("block", F.floor((F.col("_rid") - F.col("_base")) / F.col("_size")).cast("long"))
    held = rows.groupBy(*KEYS, "part", "block").agg(F.array_sort(F.collect_list(F.struct("_rid", "code", "role"))).alias("r"))
    return stage(held.select(*KEYS, "part", "block", F.col("r._rid").alias("rids"), F.col("r.code").alias("codes"), F.col("r.role").alias("roles")), "blocks")


_PLACE = "_c long, _n boolean, part long, block long"


def _rows_of(batch: pa.RecordBatch, names: list[str], **cols: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({**{n: batch.column(n) for n in names}, **cols})


def _lists(values: np.ndarray) -> pa.Array:
    return pa.array(values.reshape(len(values), -1).tolist(), pa.list_(pa.int64()))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [np.array(c) for c in batch.column("codes").to_pylist()]
        roles = batch.column("roles").to_pylist()
        pairs = [sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(r, r[1:])) for r in roles]
        yield _rows_of(batch, ["_c", "_n", "part", "block"], table=_lists(block_tables(_padded(codes))), illegal=pa.array(pairs, pa.int64()),
                       head=pa.array([r[0] for r in roles], pa.int32()), tail=pa.array([r[-1] for r in roles], pa.int32()))


def _checkpointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {n: [] for n in ("_c", "_n", "part", "block", "end", "last", "cost")}
        for c, n, blocks in zip(*(batch.column(x).to_pylist() for x in ("_c", "_n", "blocks"))):
            vectors = checkpoints(np.array([b["table"] for b in blocks]).reshape(-1, 4, 4))
            for i, b in enumerate(blocks):
                row = (c, n, b["part"], b["block"], vectors[i + 1].tolist(), i == len(blocks) - 1, int(vectors[0][0]))
                for name, value in zip(out, row):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("_c", pa.int64()), ("_n", pa.bool_()), ("part", pa.int64()), ("block", pa.int64()),
                                                                ("end", pa.list_(pa.int64())), ("last", pa.bool_()), ("cost", pa.int64())]))


def _walked(batch: pa.RecordBatch) -> Iterator[tuple[int, list[int], list[list[int]], bool]]:
    """Each block of a batch with its codes and the vectors computed anew from the checkpoint behind it."""
    codes = batch.column("codes").to_pylist()
    ends = batch.column("end").to_pylist()
    for i, (own, end, last) in enumerate(zip(codes, ends, batch.column("last").to_pylist())):
        left = block_vectors(np.array([own]), np.array([end]))[:, 0].tolist()
        yield i, own, left, last


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        exits = [[walk(codes, left, q, last)[1] for q in range(4)] for _, codes, left, last in _walked(batch)]
        yield _rows_of(batch, ["_c", "_n", "part", "block"], exits=pa.array(exits, pa.list_(pa.int64())))


_EDIT = pa.list_(pa.struct([("rid", pa.int64()), ("edit", pa.string()), ("before", pa.string()), ("role", pa.string()), ("after", pa.string())]))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        entry, rids = batch.column("entry").to_pylist(), batch.column("rids").to_pylist()
        edits = [[{"rid": r, "edit": e, "before": b, "role": role, "after": a}
                  for r, (e, b, role, a) in zip(rids[i], walk(codes, left, entry[i], last)[0])] for i, codes, left, last in _walked(batch)]
        yield pa.RecordBatch.from_arrays([pa.array(edits, _EDIT)], ["edits"])


def _entered(exits: DataFrame) -> DataFrame:
    """(keys, part, block, entry): the state in which each block is entered. One small row per block of a conversation meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n: [] for n in ("_c", "_n", "part", "block", "entry")}
            for c, n, blocks in zip(*(batch.column(x).to_pylist() for x in ("_c", "_n", "blocks"))):
                state = 0
                for b in blocks:
                    for name, value in zip(out, (c, n, b["part"], b["block"], state)):
                        out[name].append(value)
                    state = b["exits"][state]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("_c", pa.int64()), ("_n", pa.bool_()), ("part", pa.int64()),
                                                                    ("block", pa.int64()), ("entry", pa.int64())]))
    held = exits.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("part", "block", "exits"))).alias("blocks"))
    return held.mapInArrow(run, _PLACE + ", entry long")


def _plan(coded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_rid, edit, before, role, after) of every row, and (keys, cost, illegal) of every conversation."""
    blocks = _blocks(in_pieces(coded))
    tables = stage(blocks.drop("rids").mapInArrow(_tables, _PLACE + ", table array<long>, illegal long, head int, tail int"), "tables")
    before = F.lag("tail").over(W.partitionBy(*KEYS).orderBy("part", "block"))
    legal = F.struct(before.alias("a"), F.col("head").alias("b")).isin(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 1), (1, 2), (2, 1))])
    illegal = (tables.select(*KEYS, (F.col("illegal") + F.when(before.isNotNull() & ~legal, 1).otherwise(0)).alias("illegal"))
               .groupBy(*KEYS).agg(F.sum("illegal").alias("illegal")))
    held = tables.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("part", "block", "table"))).alias("blocks"))
    ends = stage(held.mapInArrow(_checkpointed, _PLACE + ", end array<long>, last boolean, cost long"), "checkpoints")
    place = [*KEYS, "part", "block"]
    known = blocks.drop("roles").join(ends.drop("cost"), place)
    entries = _entered(known.drop("rids").mapInArrow(_exits, _PLACE + ", exits array<long>"))
    done = known.join(entries, place).mapInArrow(
        _edits, "edits array<struct<rid:long,edit:string,before:string,role:string,after:string>>")
    edits = stage(done.select(F.explode("edits").alias("e")).select(F.col("e.rid").alias("_rid"), "e.edit", "e.before", F.col("e.role").alias("given"), "e.after"), "edits")
    costs = stage(ends.groupBy(*KEYS).agg(F.first("cost").alias("cost")).join(illegal, KEYS), "costs")
    for t in (blocks, tables, ends):
        discard(t)
    return edits, costs


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, at, edit, role, text): the edits of every conversation in order, with the turn that each leaves (NULLs where it deletes)."""
    turns = _sorted_rows(rows)
    edits, _ = _plan(_coded(turns))
    new = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.struct(
        F.lit("I").alias("edit"), F.when(x == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))
    gone = F.col("edit") == "D"
    own = F.struct("edit", F.when(~gone, _given()).alias("role"), F.when(~gone, F.col("text")).alias("text"))
    said = turns.join(edits, "_rid").select(*KEYS, "_rid", F.posexplode(F.concat(new("before"), F.array(own), new("after"))).alias("k", "t"))
    return said.select(F.when(~F.col("_n"), F.col("_c")).alias("conv_id"), F.struct("_rid", "k").alias("at"), "t.edit", "t.role", "t.text")


def _given() -> Column:
    return F.when(F.col("given") == "u", "user").when(F.col("given") == "a", "assistant").otherwise(F.col("role"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and running hash of each conversation; rows come in order, and a conversation may run through many batches."""
    kind = pa.schema([("_c", pa.int64()), ("_n", pa.bool_()), ("audit", pa.string()), ("sha", pa.string())])
    key, audit, sha, any_line = None, [], hashlib.sha256(), False

    def done() -> tuple:
        return (*key, "".join(audit), sha.hexdigest())

    for batch in batches:
        out = []
        for c, n, edit, before, role, text, after in zip(*(batch.column(x) for x in ("_c", "_n", "edit", "before", "role", "text", "after"))):
            if (c.as_py(), n.as_py()) != key:
                if key is not None:
                    out.append(done())
                key, audit, sha, any_line = (c.as_py(), n.as_py()), [], hashlib.sha256(), False
            edit, before, after = edit.as_py(), before.as_py(), after.as_py()
            audit.append("I" * len(before) + edit + "I" * len(after))
            lines = [f"{_NAMES[x]}:" for x in before] + ([f"{role.as_py()}:{text.as_py()}"] if edit != "D" else []) + [f"{_NAMES[x]}:" for x in after]
            for line in lines:
                sha.update((b"\n" if any_line else b"") + line.encode())
                any_line = True
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(kind.names, zip(*out))), schema=kind)
    if key is not None:
        yield pa.RecordBatch.from_pydict(dict(zip(kind.names, zip(done()))), schema=kind)


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row per conversation of ``rows``.

    ``rows`` has conv_id and turn (integers), role and text; a conversation's rows are taken by turn
    (NULLs first), then role and text. Each row's first fault counts: blank, duplicate (role and text
    came before in the conversation), truncated (the last character but white space is none of ``.!?``).
    Keeping costs nothing, another role (user or assistant) 2, deleting 3, inserting an empty turn 2,
    a truncated row that stays 1; blank rows and duplicates are deleted. ``audit`` has the initials of
    the cheapest edits, of several the ASCII-least, that leave nothing, or an optional system turn and
    pairs of user and assistant (told by initials of roles).

    NULL roles and texts are one space; a NULL conv_id is a conversation of its own. Repeated rows are
    duplicates. Texts of any length are hashed as they come. Empty tables give an empty result. Other columns are ignored.
    """
    turns = _sorted_rows(rows)
    coded = _coded(turns)
    edits, costs = _plan(coded)
    counts = coded.groupBy(*KEYS).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    said = (turns.join(edits, "_rid").select(*KEYS, "_rid", "edit", "before", _given().alias("role"), "text", "after")
            .repartition(*KEYS).sortWithinPartitions(*KEYS, "_rid"))
    digests = said.mapInArrow(_digest, "_c long, _n boolean, audit string, sha string")
    out = digests.join(counts, KEYS).join(costs, KEYS)
    return out.select(F.when(~F.col("_n"), F.col("_c")).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                      "audit", F.col("sha").alias("repaired_sha256"))


def repair_all(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """:func:`repair` with a row for every distinct conv_id of ``ids``; zeros, empty audit and the hash of nothing where no row is left."""
    done = repair(rows)
    own = ids.select(F.col("conv_id").alias("_id")).distinct()
    found = own.join(done, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("_id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
