"""The hash tree's laws, shares and slots."""

import zlib

from pyspark.sql import functions as F

from scorelab.llm import sharding


def test_law(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = sharding.shard_documents(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shares_follow_weights(spark):
    tree = {"a": {"x": {0: 1.0, 1: 3.0}}, "b": {"y": {2: 2.0}, "z": {3: 2.0}}}
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    counts = {r.shard: r.n for r in sharding.assign_shards(docs, tree).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    for shard, share in ((0, 1 / 8), (1, 3 / 8), (2, 1 / 4), (3, 1 / 4)):
        assert abs(counts[shard] / 40_000 - share) < 0.01


def test_moves_stay_in_changed_subtrees(spark):
    """A heavier shard draws rows into its own region and rack, and none move elsewhere."""
    tree = sharding.tree_of(8)
    heavier = {region: {rack: dict(shards) for rack, shards in racks.items()} for region, racks in tree.items()}
    heavier["region1"]["rack3"][7] = 2.0
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    moved = sharding.assign_shards(docs, tree, heavier).where("shard <> grown_shard").groupBy("shard", "grown_shard").count().collect()
    assert moved and all(r.grown_shard in (6, 7) or r.grown_shard in (4, 5) and r.shard < 4 for r in moved)
    assert not any(r.shard >= 4 and r.grown_shard < 4 for r in moved)


def test_every_growth_moves_only_into_the_new_shard(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    for shards in (8, 9, 12):
        rows = sharding.assign_shards(docs, sharding.tree_of(shards), sharding.tree_of(shards + 1)).collect()
        assert all(r.grown_shard in (r.shard, shards) for r in rows) and any(r.grown_shard == shards for r in rows)


def test_odd_rows(odd, odd_rows, none):
    rows = sharding.shard_documents(odd).collect()
    assert len(rows) == len(odd_rows) and sharding.shard_documents(none).collect() == []
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert all(r.size == 1 and r.text_crc32 == 0 for r in rows if r.doc_id in (2, 3))


def test_twin(spark, small):
    """Everything but the slots, which follow the tasks, against SQL."""
    from compare import duck

    from scorelab.llm.oracle import SHARDING

    twin = {r[0]: r[1:] for r in duck(small).execute(SHARDING).fetchall()}
    rows = sharding.shard_documents(spark.read.parquet(f"{small}/documents.parquet")).collect()
    assert {r.doc_id: (r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in rows} == twin
