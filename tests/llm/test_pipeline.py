import re

import corpus_pipeline
import duckdb
import pytest
from paceline.llm import decontam, langid, mixing
from paceline.llm.simhash import fingerprint, shingle_hashes
from tests.llm.test_decontam import brute as brute_leaks


def brute_keep(docs):
    """Of (doc_id, text): the smallest id of each group of close fingerprints, then of each group of similar shingles."""
    root = {d: d for d, _ in docs}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    def link(a, b):
        root[max(top(a), top(b))] = min(top(a), top(b))

    prints = {d: fingerprint(t, 3) & (2 ** 64 - 1) for d, t in docs}
    sets = {d: set(shingle_hashes(t, 5).tolist()) for d, t in docs}
    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                link(a, b)
    heads = [d for d in ids if top(d) == d]
    for i, a in enumerate(heads):
        for b in heads[:i]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and bin(prints[a] ^ prints[b]).count("1") <= 11:
                link(a, b)
    return {d for d in ids if top(d) == d}


@pytest.fixture(scope="module")
def small(spark, sf_dir, tmp_path_factory):
    """documents of the smallest size with odd rows added, beside its benchmark."""
    folder = str(tmp_path_factory.mktemp("sf"))
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * FROM '{sf_dir}/documents.parquet' UNION ALL
        SELECT 9000 + i, t, 'en', NULL, length(t) FROM (VALUES (1, NULL), (2, ''), (3, '12 -- 34'), (4, repeat('the and of ', 20000)), (5, 'The thing')) v(i, t)
        UNION ALL SELECT 9100 + item_id, 'Before it ' || text || ' and after', 'en', 'src1', 0 FROM '{sf_dir}/benchmark.parquet' WHERE item_id < 3)
        TO '{folder}/documents.parquet'""")
    con.execute(f"COPY (SELECT * FROM '{sf_dir}/benchmark.parquet') TO '{folder}/benchmark.parquet'")
    docs = con.execute(f"SELECT * FROM '{folder}/documents.parquet'").fetchall()
    return folder, docs, con.execute(f"SELECT * FROM '{folder}/benchmark.parquet'").fetchall()


def test_pipeline_against_brute_force(spark, small):
    folder, docs, items = small
    got = corpus_pipeline.run(spark, folder).collect()
    text = {d: t for d, t, *_ in docs}
    assert all(text[r.doc_id] == r.text for r in got)
    # Language: every document with letters is in one of the languages.
    first = [(d, t) for d, t, *_ in docs if langid.has_letter(t)]
    kept = brute_keep(first)
    leaks = {d for d, _ in brute_leaks([(d, t) for d, t in first if d in kept and d != 9004], items)}
    assert {9100, 9101, 9102} <= leaks | (set(text) - kept)
    clean = kept - leaks
    # The mix holds no others, and every source comes near its target in whole documents.
    assert {r.doc_id for r in got} <= clean
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", text[d])) for d in clean}
    rows = spark.createDataFrame([(d, text[d], s) for d, _, _, s, _ in docs if d in clean], "doc_id long, text string, source string")
    goal = {r.source: r.target for r in mixing.takings(rows).collect()}
    for s, target in goal.items():
        taken = [size[r.doc_id] for r in got if r.source == s]
        longest = max(size[d] for d, _, _, x, _ in docs if d in clean and x == s)
        assert abs(sum(taken) - target) <= longest + 3
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in shards.values())


def test_stages_return_the_columns_of_documents(spark, small):
    folder, *_ = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.limit(40).selectExpr("*", "'x' AS _row", "1 AS score", "2 AS slot", "3 AS lang_pred")
    for name, step in corpus_pipeline.STAGES[:-1]:
        if name not in ("SimHash near-dedup", "mixing"):
            assert step(spark, odd, folder).columns == odd.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs.limit(0), folder).columns == docs.columns
        assert step(spark, docs.limit(0), folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
    assert decontam.SPAN <= 8


def test_columns_of_any_name_keep_their_values(spark, small):
    folder, *_ = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = {"_row": "'r' || doc_id", "__row": "doc_id * 2", "score": "0.25", "held_out": "doc_id % 7", "lang_pred": "'p'", "_id": "-doc_id", "_text": "'t'", "_lang": "'l'",
             "text_key": "doc_id + 5", "_key": "1", "n": "doc_id + 1", "set": "'s'", "fingerprint": "3", "size": "doc_id + 9", "draw": "'d'", "kept": "false", "key": "'k'", "root": "9"}
    odd = docs.where("doc_id < 60 OR doc_id > 8999").selectExpr("*", *[f"{e} AS `{c}`" for c, e in extra.items()])
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, odd, folder)
        assert out.columns == odd.columns, name
        assert out.exceptAll(odd.unionAll(odd)).isEmpty(), name
        assert not out.isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, odd.selectExpr("*", "'x' AS slot"), folder)
    assert last.select(*odd.columns).exceptAll(odd).isEmpty() and last.count() == odd.count()
