"""Merkle manifest of a dataset with a membership proof for every row.

Leaves of a group are appended in order.  An ``Accumulator`` keeps the open subtrees, complete
ones of falling heights, and a partial witness for each leaf: the sibling digests known so far.
When a later subtree of the same height is complete, the two merge and each extends the
witnesses of the other's leaves.  Appends are aligned, so they can be made block by block in
different tasks: a block's root is a further append one tree up, whose witness extends those of
all leaves of the block.  The roots of the groups are appended once more for the root of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorelab.llm.common import reachable
from scorelab.session import materialise

#: A block has 2 ** HEIGHT leaves.
HEIGHT = 10
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts: str) -> str:  # noqa: N802
    return sha256("".join(parts).encode()).hexdigest()


class Accumulator:
    """Open subtrees (height, digest, first leaf) and the witness of every leaf so far."""

    def __init__(self):
        self.open: list[tuple[int, str, int]] = []
        self.witnesses: list[list[str]] = []

    def _merge(self, end: int) -> None:
        """The last two subtrees, of equal height, become one; ``end`` is the leaf after them."""
        (height, right, middle), (_, left, start) = self.open.pop(), self.open.pop()
        for witness in self.witnesses[start:middle]:
            witness.append(right)
        for witness in self.witnesses[middle:end]:
            witness.append(left)
        self.open.append((height + 1, H(left, right), start))

    def append(self, digest: str) -> None:
        self.open.append((0, digest, len(self.witnesses)))
        self.witnesses.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._merge(len(self.witnesses))

    def closed(self, height: int = 0) -> tuple[str, list[list[str]]]:
        """Root and whole witnesses if nothing more came, at ``height`` at least; appends may go on after it."""
        done = Accumulator()
        done.open, done.witnesses = list(self.open), [list(w) for w in self.witnesses]
        while len(done.open) > 1 or done.open[-1][0] < height:
            if len(done.open) > 1 and done.open[-1][0] == done.open[-2][0]:
                done._merge(len(done.witnesses))
            else:
                own, digest, start = done.open.pop()
                done.open.append((own + 1, H(digest), start))
        return done.open[0][1], done.witnesses


def folded(digest: str, place: int, count: int, siblings: Iterator[str]) -> str:
    """The root over ``count`` nodes, from the one at ``place`` and its siblings."""
    while count > 1:
        if place % 2:
            digest = H(next(siblings), digest)
        elif place + 1 < count:
            digest = H(digest, next(siblings))
        else:
            digest = H(digest)
        place, count = place // 2, (count + 1) // 2
    return digest


def leaf_digest(*columns: Column) -> Column:
    """H of the columns as text, each with its length in bytes; a null is a dash."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with ``place``, from 0 in each ``kind`` by ``order``, and ``count``, the rows of the kind.

    Rows are sorted by ranges, so a kind with most of the rows spans many tasks.  Tasks number
    their own rows; what is gathered are counts per task and kind.
    """
    fields = nodes.columns
    at = fields.index("kind")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)

    def number(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            numbers = []
            for kind in batch.column(at).to_pylist():
                numbers.append(seen.get(kind, 0))
                seen[kind] = numbers[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(numbers), pa.int32()), pa.array(numbers, pa.int64())], names=[*fields, "task_", "number_"])

    ranged = nodes.repartitionByRange("kind", *order).sortWithinPartitions("kind", *order)
    numbered = materialise(ranged.mapInArrow(number, f"{schema}, task_ int, number_ long"), "merkle-places")
    counts = numbered.groupBy("kind", "task_").agg(F.count("*").alias("rows_"))
    kind = W.partitionBy("kind")
    before = F.coalesce(F.sum("rows_").over(kind.orderBy("task_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("kind", "task_", before.alias("offset_"), F.sum("rows_").over(kind).alias("count"))
    return numbered.join(offsets, ["kind", "task_"]).select(*fields, (F.col("number_") + F.col("offset_")).alias("place"), "count")


def appended(nodes: DataFrame, height: int) -> DataFrame:
    """``nodes`` (kind, place, count, digest, ...) with the witness inside their block and the block's root."""
    fields = nodes.columns
    kind_at, place_at, count_at, digest_at = (fields.index(n) for n in ("kind", "place", "count", "digest"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    size = 1 << height

    def run(batches):
        block, held, accumulator, count = None, [], Accumulator(), 0

        def done():
            # A whole tree ends at its root; blocks of a larger one all end at the same height.
            root, witnesses = accumulator.closed(height if count > size else 0)
            table = pa.Table.from_batches(held).combine_chunks()
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns]
            columns += [pa.array([bytes.fromhex("".join(w)) for w in witnesses], pa.binary()), pa.array([root] * len(witnesses), pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[*fields, "witness", "block_root"])

        for batch in batches:
            start = 0
            rows = zip(*(batch.column(i).to_pylist() for i in (kind_at, place_at, count_at, digest_at)))
            for i, (kind, place, whole, digest) in enumerate(rows):
                if (kind, place // size) != block:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield done()
                    block, held, accumulator, count, start = (kind, place // size), [], Accumulator(), whole, i
                accumulator.append(digest)
            if batch.num_rows > start:
                held.append(batch.slice(start))
        if held:
            yield done()

    dealt = nodes.withColumn("block_", F.col("place").bitwiseAND(F.lit(-size).cast("long")))
    dealt = dealt.repartition("kind", "block_").sortWithinPartitions("kind", "place").drop("block_")
    return materialise(dealt.mapInArrow(run, f"{schema}, witness binary, block_root string"), "merkle-blocks")


def trees(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``nodes`` (kind, place, count, digest, ...) with ``witness``, whole, and the ``root`` of their kind.

    Each round takes the block roots of the one before as its nodes, a thousandth of them.
    """
    rounds = [appended(nodes, height)]
    while (rounds[-1].agg(F.max("count")).first()[0] or 0) > 1 << height:
        last = rounds[-1].where(F.col("place") % (1 << height) == 0)
        nodes = last.select("kind", F.shiftright("place", height).alias("place"), F.shiftright(F.col("count") + ((1 << height) - 1), height).alias("count"), F.col("block_root").alias("digest"))
        rounds.append(appended(nodes, height))
    above = rounds.pop().withColumnRenamed("block_root", "root")
    while rounds:
        upper = above.select("kind", F.col("place").alias("block_"), F.col("witness").alias("more_"), "root")
        own = rounds.pop().drop("block_root").withColumn("block_", F.shiftright("place", height))
        above = own.join(upper, ["kind", "block_"]).withColumn("witness", F.concat("witness", "more_")).drop("block_", "more_")
    return above


def manifest(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The rows of ``leaves`` (kind, order, digest, ...) with subroot, root and what a proof needs.

    ``kind`` is the group, ``order`` the place in it; equal places go by digest, so repeated rows
    have a place each.  Added are place, count, witness (digests from the leaf to the subroot),
    subroot, top_place, top_count, top_witness and root.  A null kind comes first.
    """
    keyed = leaves.withColumn("kind", F.coalesce(F.concat(F.lit("="), F.col("kind")), F.lit("")))
    own = trees(placed(keyed, "order", "digest"), height).withColumnRenamed("root", "subroot")
    tops = own.where("place = 0").select(F.lit("").alias("kind"), F.col("kind").alias("name"), F.col("subroot").alias("digest"))
    tops = trees(placed(tops, "name"), height)
    tops = tops.select(F.col("name").alias("kind"), F.col("place").alias("top_place"), F.col("count").alias("top_count"), F.col("witness").alias("top_witness"), "root")
    return own.join(tops, "kind").withColumn("kind", F.expr("CASE WHEN kind = '' THEN NULL ELSE substring(kind, 2) END"))


def proofs(rows: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of ``manifest`` rows.

    ``shown`` is the leaf that is folded with the witness; it is verified if that gives the root.
    """
    columns = ["doc_id", "digest", "shown", "place", "count", "witness", "top_place", "top_count", "top_witness", "subroot", "root"]

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, leaf, shown, place, count, own, top_place, top_count, top, subroot, root in zip(*(c.to_pylist() for c in batch.columns)):
                text = own.hex() + top.hex()
                siblings = (text[i : i + 64] for i in range(0, len(text), 64))
                folded_root = folded(folded(shown, place, count, siblings), top_place, top_count, siblings)
                out.append((doc_id, leaf, subroot, root, H(text), folded_root, folded_root == root))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [batch.schema.field(0).type, *[pa.string()] * 5, pa.bool_()])], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return rows.select(*columns).mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def document_proofs(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Proofs of all rows of ``docs``, grouped by lang, in order of doc_id.

    Where 7 divides crc32 of the id as text (a null id counts as the empty text), the leaf shown has
    n_chars + 1; a null n_chars stays, so that row still verifies.  Null ids come first; rows
    of one id go by their leaves, and repeated rows have a place each.  An empty table gives no
    rows.  Columns beside the five of a leaf are ignored.
    """
    reachable(docs.sparkSession)
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 0
    leaf = leaf_digest(*map(F.col, LEAF_COLUMNS))
    changed = leaf_digest(*(F.col(n) + 1 if n == "n_chars" else F.col(n) for n in LEAF_COLUMNS))
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("kind"), F.col("doc_id").cast("long").alias("order"), leaf.alias("digest"), F.when(tampered, changed).alias("changed"))
    # Written once: sorting by ranges reads its input twice, which should not hash the texts again.
    rows = manifest(materialise(leaves, "merkle-leaves"), height)
    return proofs(rows.withColumn("shown", F.coalesce("changed", "digest")))
