"""Sharding by a hierarchical weighted hash tree.

A row descends from the root to a region, a rack and a shard.  On each level every child
draws -ln(u) / weight with a hash u of the row's key and the child's name, and the smallest
draw wins, so a child gets its share of the weight.  A draw depends on the key, the child and
its own weight only: when weights change, rows move into (or out of) the changed children and
stay where they are everywhere else.  A new shard opens a region of its own, so it takes rows
only into itself.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorelab.session import materialise

#: {region: {rack: {shard: weight}}}
Tree = dict[str, dict[str, dict[int, float]]]


def tree_of(shards: int, regions: int = 2, racks: int = 2, per_rack: int = 2) -> Tree:
    """Shards 0.. in racks of regions; those beyond the full grid get a region of their own each."""
    grid: Tree = {}
    for shard in range(shards):
        rack, region = shard // per_rack, shard // (per_rack * racks)
        rack = rack if region < regions else shard
        region = region if region < regions else shard
        grid.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return grid


def weight(node) -> float:
    return sum(map(weight, node.values())) if isinstance(node, dict) else node


def draw(key: Column, name: str, own: float) -> Column:
    """-ln(u) / weight with u in (0, 1) from 52 bits of the md5 of key and child name."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"/{name}")).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(own)


def descend(key: Column, node, path: str = "") -> Column:
    """The shard below ``node``; only the draws along a row's own path are computed."""
    children = sorted(node)
    below = {c: descend(key, node[c], f"{path}/{c}") if isinstance(node[c], dict) else F.lit(c).cast("int") for c in children}
    if len(children) == 1:
        return below[children[0]]
    draws = [F.struct(draw(key, f"{path}/{c}", weight(node[c])).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(children)]
    winner = F.least(*draws)["child"]
    return F.element_at(F.array(*below.values()), winner + 1) if not isinstance(node[children[0]], dict) else _choose(winner, list(below.values()))


def _choose(winner: Column, below: list[Column]) -> Column:
    chosen = F.when(winner == 0, below[0])
    for i, column in enumerate(below[1:], 1):
        chosen = chosen.when(winner == i, column)
    return chosen


def assign_shards(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, and grown_shard under the grown tree.

    The key is doc_id as text, the empty text for null, so repeated rows share a shard.  Size
    is the text's UTF-8 bytes (none for null) plus 1.  Other columns are ignored.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        descend(key, tree).alias("shard"),
        (descend(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))


def add_slots(assigned: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    Tasks number their own rows of each shard; the table is written with task and number, so
    that both stay fixed, and every task's numbers are then moved by the rows of the tasks before
    it.  No task sees a whole shard: only counts per task and shard are gathered.
    """
    fields = [f.name for f in assigned.schema.fields]
    place = fields.index("shard")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in assigned.schema.fields)

    def number(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            numbers = []
            for shard in batch.column(place).to_pylist():
                numbers.append(seen.get(shard, 0))
                seen[shard] = numbers[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(numbers), pa.int32()), pa.array(numbers, pa.int64())], names=[*fields, "task_", "number_"])

    numbered = materialise(assigned.mapInArrow(number, f"{schema}, task_ int, number_ long"), "shards")
    before = W.partitionBy("shard").orderBy("task_").rowsBetween(W.unboundedPreceding, -1)
    counts = numbered.groupBy("shard", "task_").agg(F.count("*").alias("rows_"))
    offsets = counts.select("shard", "task_", F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("offset_"))
    joined = numbered.join(offsets, ["shard", "task_"])
    return joined.select(*fields, (F.col("number_") + F.col("offset_")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """All rows of ``docs`` in shards 0 .. shards - 1, with slots and the shard after one more was added."""
    assigned = add_slots(assign_shards(docs, tree_of(shards), tree_of(shards + 1)))
    return assigned.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
