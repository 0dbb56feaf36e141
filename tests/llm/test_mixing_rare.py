"""Sources that are a tiny share of the mix."""

import duckdb
import pytest

from paceline.llm import common, mixing, queries, sql


def test_rare_sources_reach_their_targets(spark):
    rows = [(i, "w " * 1_000, "huge") for i in range(2_000)]
    rows += [(10_000 + i, "w " * 11, f"rare{i % 40:02}") for i in range(120)]
    rows += [(20_000, "one", "word")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.takings(df).collect()
    for s in {s for _, _, s in rows}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= (1 if s != "huge" else 0.001 * own[0].target)
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    whole = mixing.mixed(common.with_row_id(df, "_row"), "_row").groupBy("_row").count().collect()
    assert len(whole) >= 121 and max(r["count"] for r in whole) <= 2


def test_only_rare_sources(spark):
    rows = [(i, "w " * 7, f"s{i}") for i in range(2_500)]
    got = mixing.takings(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(abs(r.taken - r.target) <= 1 for r in got) and sum(r.taken for r in got) > 0


@pytest.mark.parametrize("rare", [1, 40])
def test_sql_knows_rare_sources(spark, tmp_path, rare):
    rows = [(i, "w " * 1_000, ("huge", "large")[i % 2]) for i in range(400)]
    rows += [(10_000 + i, "w " * (5 + i % 9), f"rare{i % rare:02}") for i in range(3 * rare)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op8(spark, str(tmp_path)).select("doc_id", "size", "source_size", "target", "taken").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = {r[0]: r for r in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({sql.OP8})").fetchall()}
    assert len(got) == len(want) == len(rows)
    for r in got:
        assert (r.size, r.source_size, r.taken) == (want[r.doc_id][1], want[r.doc_id][2], want[r.doc_id][4])
        assert r.target == pytest.approx(want[r.doc_id][3])
