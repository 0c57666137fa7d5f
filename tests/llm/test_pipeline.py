import random

import corpus_pipeline
from shiftloom.llm import catalog

from .helpers import edge_rows, frame, prose


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, prose(rng, 80, 3000), ("en", "de")[i % 2], f"s{i % 3}", 1) for i in range(240)]
    rows += [(300 + i, rows[i][1], "en", "s0", 1) for i in range(20)] + [(400, "JUNK!! " * 50, "en", "s0", 1)] + edge_rows()
    items = [(1, prose(rng, 30, 3000))]
    rows += [(500, prose(rng, 40, 3000) + " " + items[0][1], "en", "s1", 1)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[:5] == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept.append({r["doc_id"] for r in docs.collect()})
    first, second, third, fourth, last = kept
    assert first == set(range(240)) | set(range(300, 320)) | {500}
    assert second == set(range(240)) | {500}
    assert third == set(range(240))
    assert len(fourth) > 120 and fourth < third and last == fourth
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == last


def test_columns_with_the_operators_own_names(spark, tmp_path):
    rng = random.Random(2)
    names = ["__quality", "__source", "__lang", "__topic", "__id", "__group", "__known", "__size", "__crc", "__row", "__ROW2", "kept0__row"]
    rows = [(i, prose(rng, 60, 3000), "en", "s", 1, *[f"{n}{i}" for n in names]) for i in range(120)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    frame(spark, [], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns + (["shard"] if name == "sharding" else [])
        got = out.collect()
        assert got and all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names)


def test_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_catalog_has_one_query_per_operator():
    names = sorted(int(q[2:].split("_")[0]) for q in catalog.QUERIES if q.startswith("op"))
    assert names == list(range(1, 14)) and "pipeline" in catalog.QUERIES
    assert set(catalog.SQL) <= set(catalog.QUERIES)
