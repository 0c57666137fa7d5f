import zlib
from collections import defaultdict

from shiftloom.llm import sharding

from .helpers import corpus, frame


def test_sizes_slots_and_digests(spark):
    rows = corpus(8, 200)
    df = frame(spark, rows).withColumnRenamed("lang", "shard").withColumnRenamed("source", "slot").repartition(5)
    got = sharding.manifest(df, 7).collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(sizes) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, largest = sum(sizes.values()), max(r["size"] for r in got)
    assert all(abs(s - total / 7) <= largest for s in sizes.values())


def test_equal_texts_stay_together_but_for_the_cuts(spark):
    rows = [(i, f"text {i % 9} " * (1 + i % 9), "en", "a", 1) for i in range(300)]
    got = sharding.manifest(frame(spark, rows).repartition(4), 5).collect()
    shards = defaultdict(set)
    for r in got:
        shards[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) - 1 for s in shards.values()) <= 4


def test_one_hot_text_is_split(spark):
    rows = [(i, "the same", "en", "a", 1) for i in range(400)]
    got = sharding.manifest(frame(spark, rows).repartition(3), 8).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [50] * 8


def test_shard_column_agrees_with_the_manifest(spark):
    rows = [r for r in corpus(8, 150) if r[0] is not None]
    df = frame(spark, rows).repartition(3)
    by_id = {r["doc_id"]: r["shard"] for r in sharding.manifest(df, 6).collect() if r["doc_id"] != 905}
    got = sharding.shard(df, 6)
    assert got.columns == [*df.columns, "shard"]
    assert {r["doc_id"]: r["shard"] for r in got.collect() if r["doc_id"] != 905} == by_id


def test_many_shards(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    by_id = {r["doc_id"]: r["shard"] for r in sharding.manifest(df, 3000).collect()}
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(df, 3000).collect()}
    assert got == by_id and len(set(got.values())) == 3000


def test_no_rows(spark):
    assert sharding.manifest(frame(spark, [])).collect() == []
    assert sharding.shard(frame(spark, [])).collect() == []
