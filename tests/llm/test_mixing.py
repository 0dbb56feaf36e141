import random

import pytest
from pyspark.sql import functions as F

from paceline.llm import common, mixing, sharding

SCHEMA = "doc_id long, text string, source string, size string"


def frame(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "B", "é", None, "big", "big", "big"]), "x") for i in range(400)]
    rows += [(900, None, "a", "x"), (901, "", "only", "x"), (None, "w w", "b", "x"), (7, "same text", "c", "x"), (7, "same text", "c", "x"), (902, "w " * 30_000, "huge", "x")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def goals(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, out, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over


def test_targets_and_takings(spark):
    rows, df = frame(spark)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = goals(sizes)
    got = mixing.takings(df).collect()
    assert len(got) == len(rows)
    taken = {s: sum(r.taken for r in got if r.source == s) for s in sizes}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.01, abs=10)
    again = mixing.takings(df.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_pieces_are_the_mix(spark):
    rows, df = frame(spark)
    plan, pieces = mixing.mix(df, slots=500)
    got = pieces.orderBy("slot", "epoch", "source", "place", "from_word").collect()
    slots = {}
    for r in got:
        assert 0 <= r.from_word < r.to_word
        slots[r.slot] = slots.get(r.slot, 0) + r.to_word - r.from_word
    total = 1.5 * sum(len((t or "").split()) for _, t, _, _ in rows)
    assert sum(abs(n - total / 500) > 1 for n in slots.values()) <= 12  # all blocks are equal but the last of a source
    assert len({(r.source, r.place, r.epoch, r.from_word) for r in got}) == len(got)


def test_schedule_is_even(spark):
    weights = spark.createDataFrame([("a", 5.0), ("b", 1.0), (None, 4.0), ("z", 0.0)], "source string, target double")
    got = mixing.schedule(spark, weights, 1000).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(1000))
    seen = {}
    for i, r in enumerate(got, 1):
        assert r.turn == seen.get(r.source, 0)
        seen[r.source] = r.turn + 1
        for s, w in (("a", 0.5), ("b", 0.1), (None, 0.4)):
            assert abs(seen.get(s, 0) - w * i) < 4
    assert "z" not in seen


def test_whole_documents(spark):
    rows, df = frame(spark)
    got = mixing.mixed(common.with_row_id(df, "_row"), "_row").groupBy("_row").count().collect()
    assert got and max(r["count"] for r in got) <= 2


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.takings(empty).collect() == [] and sharding.assign(empty).collect() == []
    assert [r.taken for r in mixing.takings(spark.createDataFrame([(1, None, None, "x")], SCHEMA)).collect()] == [0]


def test_shards(spark):
    import zlib
    rows, df = frame(spark)
    got = sharding.assign(df.withColumn("shard", F.lit(9)), shards=7).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(7)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    source = {i: s for i, _, s, _ in rows}
    big = [sum(source[r.doc_id] == "big" for r in got if r.shard == k) for k in range(7)]
    assert max(big) - min(big) <= 2
    assert sorted(map(str, sharding.assign(df.repartition(3).withColumn("shard", F.lit(9)), shards=7).collect())) == sorted(map(str, got))


def test_fewer_rows_than_shards(spark):
    got = sharding.assign(spark.createDataFrame([(1, "a", "s", ""), (2, "b", "s", "")], SCHEMA)).collect()
    assert len({r.shard for r in got}) == 2 and {r.slot for r in got} == {0}
