import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from conftest_llm import prose

from sportlake.llm.queries import ORACLES, QUERIES


def test_registered():
    names = entry_point.queries()
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names and set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted(tuple(r[c] for c in columns) for r in frame.collect())
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = connection.sql(ORACLES[name])
    order = [want.columns.index(c) for c in columns]
    assert got == sorted(tuple(r[i] for i in order) for r in want.fetchall())


def test_stages_take_effect(spark, frame, tmp_path):
    rows = [(i, prose(i, 60), "en", f"s{i % 3}") for i in range(150)]
    toxic = [(200 + i, prose(200 + i, 50) + " vile cretin", "en", "s0") for i in range(60)]
    copies = [(300 + i, rows[i][1] + " zu", "en", "s1") for i in range(20)]
    item = prose(999, 30)
    leaks = [(400 + i, prose(400 + i, 40) + " " + item, "en", "s2") for i in range(5)]
    docs = frame(rows + toxic + copies + leaks)
    labels = [(d, int(200 <= d < 300)) for d, *_ in rows + toxic]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids, stage_docs = [], docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        stage_docs = stage(spark, stage_docs, str(tmp_path))
        assert stage_docs.columns == docs.columns
        ids.append({r.doc_id for r in stage_docs.select("doc_id").collect()})
    clean = {r[0] for r in rows}
    assert ids[0] == clean | {r[0] for r in copies + leaks}
    assert ids[1] == clean | {r[0] for r in leaks}
    assert ids[2] == clean
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert set(found.columns) == {*docs.columns, "shard", "slot"}
    assert {r.doc_id for r in found.select("doc_id").collect()} <= clean and found.count() > 100


def test_stages_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            before = docs.count()
            docs = stage(spark, docs, str(tmp_path))
            assert before or docs.count() == 0


def test_rows_without_id_and_repeated_rows(spark, frame, tmp_path):
    item = prose(9, 30)
    spark.createDataFrame([(1, item), (2, "what is it?")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    a, b, c, leak = prose(1, 80), prose(2, 80), prose(3, 80), prose(4, 40) + " " + item
    rows = [(None, a), (None, a), (5, b), (5, b), (7, b + " zu"), (None, b + " ka"), (None, c), (2, c)]
    rows += [(None, leak), (8, "so what is it? no"), (9, None), (9, None), (None, ""), (None, " ")]
    docs = frame(rows)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_dedup"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    want = [(None, a), (5, b), (2, c), *rows[8:]]
    assert found == sorted(want, key=repr)
    clean = stages["decontamination"](spark, kept, str(tmp_path))
    want = [r for r in want if r[1] not in (leak, "so what is it? no")]
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted(want, key=repr)
