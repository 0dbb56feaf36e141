import random

import numpy as np
import pytest

from paceline.llm import ann, quality


def test_quality_on_held_out_rows(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    got = quality.classify(spark.read.parquet(f"{path}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)


def test_quality_of_odd_rows(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["good", "text", "here."]) for _ in range(30)) if i % 2 else "###!!! " * 20, "x") for i in range(80)]
    docs += [(200, None, "x"), (201, "", "x"), (None, "good text", "x"), (202, "a" * 300_000, "x"), (3, docs[3][1], "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(1, None), (None, 1), (999, 0), (5, 1)], "doc_id long, quality int")
    got = quality.classify(df, labels).collect()
    assert len(got) == len(docs) and all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 80)
    by = {r.doc_id: r.score for r in got}
    assert by[200] == by[201]
    assert {r.score for r in quality.classify(df, labels.where("quality = 1")).collect()} == {0.5}
    assert quality.classify(df.limit(0), labels).collect() == []


def test_fit_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    label = (x[:, 1] - 0.5 * x[:, 2] + 0.1 * rng.normal(size=500) > 0.5).astype(int)
    model = quality.fit(x, label)
    score = model.score(x)
    assert np.mean((score >= quality.CUT) == (label == 1)) > 0.95
    good, bad = score[label == 1], score[label == 0]
    assert np.mean(good[:, None] > bad[None]) > 0.98
    assert quality.fit(x, np.ones(500)) is None


def brute(rows, k):
    ok = {(i, tuple(float(np.float32(a)) for a in v)) for i, v in rows
          if i is not None and v is not None and all(a is not None and np.isfinite(a) for a in v) and any(v)}
    out = {}
    for q, v in ok:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), i) for i, w in ok if i != q)
            out[q] = near[:k]
    return out


@pytest.mark.parametrize("shard_rows,query_rows", [(4096, 4096), (150, 3)])
def test_search(spark, shard_rows, query_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 12)) * 3
    rows = [(i, [float(np.float32(a)) for a in centres[i % 8] + rng.normal(size=12)]) for i in range(800)]
    rows += [(1000 + i, rows[100][1]) for i in range(40)]  # copies of a query, more than a result holds
    rows += [(2000, None), (2001, [0.0] * 12), (2002, [float("nan")] * 12), (2003, [None] * 12), (2100, [float("inf")] * 12), (None, rows[0][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(6)
    got = ann.search(df, df.where("vec_id % 100 = 0"), shard_rows=shard_rows, query_rows=query_rows).collect()
    want = brute(rows, 10)
    hits = 0
    for q, near in want.items():
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & {i for _, i in near})
    assert {r.query_id for r in got} == set(want)
    assert hits >= 0.95 * 10 * len(want)
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 100), key=lambda r: r.rank)] == [i for _, i in want[100]]


@pytest.mark.parametrize("kind", ["plain", "outlier", "huge outlier", "far groups", "offset"])
def test_recall_on_rows_without_structure(kind):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 32))
    if "outlier" in kind:
        x[7, 3] = 1e20 if kind == "huge outlier" else 1e8
    if kind == "far groups":
        x[:400] += 1e8
        x[400:410] -= 1e9
    if kind == "offset":
        x += 1e7
    graph, entry = ann.build(x)
    asked = np.arange(0, 1500, 10)
    found, _ = ann.beam_search(x, graph, entry, x[asked], ann.BEAM)
    hits = total = 0
    for q, row in zip(asked, found):
        near = np.argsort(((x - x[q]) ** 2).sum(1), kind="stable")[:11]
        hits, total = hits + len(set(near) & set(row[:11])), total + 11
    assert hits >= 0.95 * total


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], schema)
    got = sorted((r.rank, r.vec_id) for r in ann.search(df, df.where("vec_id % 100 = 0")).collect())
    assert got == [(1, 2), (2, 1)]
    assert ann.search(df.limit(0), df.limit(0)).collect() == []
    assert ann.search(df.where("vec_id = 0"), df.where("vec_id = 0")).collect() == []
