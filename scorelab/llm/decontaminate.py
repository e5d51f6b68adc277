"""Benchmark decontamination by Wu-Manber search over words.

Patterns are windows of consecutive benchmark words.  The search slides a frame of the
pattern's length over a document.  A table gives for each block of words how far the frame
can move without missing a pattern; blocks that no pattern has move it by almost its whole
length.  A block that ends some pattern opens a bucket by its hash; the bucket's strings with
the same first word are compared directly.  Symbols are words, so shift tables stay small.

Patterns are searched in blocks of bounded size.  One block is the normal case; a larger
benchmark takes one narrow pass per block, and nothing is ever shuffled.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab.llm.common import small_slices

WINDOW = 10
#: Benchmark text per pattern block; its tables take some thirty times as much in each task.
BLOCK_BYTES = 4 << 20
BLOCK = 2

#: A-Z to lower case; ASCII other than letters and digits separates words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class Searcher:
    """Shift tables, buckets and patterns of one length."""

    def __init__(self, patterns: dict[tuple[int, ...], set[str]], length: int, base: int):
        self.length, self.base = length, base
        self.block = min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = self.key(pattern, end)
                move = length - end
                if move < self.shift.get(key, self.default):
                    self.shift[key] = move
            self.buckets[self.key(pattern, length)][pattern[0]].append((pattern, items))

    def key(self, ids, end: int) -> int:
        return ids[end - 2] * self.base + ids[end - 1] if self.block == 2 else ids[end - 1]

    def search(self, ids: list[int], spans: list, items: set) -> None:
        """Add (start, end) of every occurrence, and the items it belongs to."""
        shift, default, length, base, two = self.shift.get, self.default, self.length, self.base, self.block == 2
        end, size = length, len(ids)
        while end <= size:
            last = ids[end - 1]
            # A word that no pattern has rules out every frame that holds it.
            if not last:
                end += length
                continue
            key = ids[end - 2] * base + last if two else last
            move = shift(key, default)
            if move:
                end += move
                continue
            start = end - length
            for pattern, owners in self.buckets[key].get(ids[start], ()):
                if pattern == tuple(ids[start:end]):
                    spans.append((start, end))
                    items |= owners
            end += 1


class Patterns:
    """All windows of a block of benchmark items, one searcher per window length."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            sequence = [self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)]
            if sequence:
                length = min(window, len(sequence))
                for start in range(len(sequence) - length + 1):
                    by_length[length][tuple(sequence[start : start + length])].add(item)
        self.searchers = [Searcher(found, length, len(self.ids) + 1) for length, found in sorted(by_length.items())]

    def search(self, sequence: list[bytes]) -> tuple[list, set]:
        """Merged spans of hit words, and the items with occurring windows."""
        known = self.ids.get
        ids = [known(w, 0) for w in sequence]
        spans, items = [], set()
        for searcher in self.searchers:
            if searcher.length <= len(ids):
                searcher.search(ids, spans, items)
        return merged(spans), items


def merged(spans: list) -> list:
    out: list = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def pattern_blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark's (item, text) rows in blocks of about ``block_bytes``, one at a time."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes) or 1
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("item"), F.lit(count)) == k) if count > 1 else rows
        yield [(row.item, row.text) for row in part.collect()]


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, hits (start, end word positions, merged) and items of every row of ``docs``.

    An item shorter than ``window`` is one window; an item or document without words matches
    nothing, and null texts have none.  Repeated items count once by item_id; a null item_id
    counts as the empty id.  Repeated documents and null doc_ids keep their rows; an empty
    benchmark gives rows without hits.  Other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text string, n_words long, hits array<struct<start int, end int>>, items array<string>"
    found = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.lit(None).cast("long").alias("n_words"),
                        F.array().cast("array<struct<start int, end int>>").alias("hits"), F.array().cast("array<string>").alias("items"))
    for block in pattern_blocks(benchmark, block_bytes):
        found = found.mapInArrow(_search_block(docs.sparkSession, block, window, schema), schema)
    return found.drop("text")


def _search_block(spark, block: list, window: int, schema: str):
    from pyspark.sql.types import StructType

    held, types = spark.sparkContext.broadcast(block), StructType.fromDDL(schema)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, tables = to_arrow_schema(types), Patterns(held.value, window)
        for batch in small_slices(batches):
            sizes, hits, items = [], [], []
            for text, before, known in zip(*(batch.column(i).to_pylist() for i in (1, 3, 4))):
                sequence = words(text)
                spans, own = tables.search(sequence)
                sizes.append(len(sequence))
                hits.append([{"start": s, "end": e} for s, e in merged(spans + [(x["start"], x["end"]) for x in before])])
                items.append(sorted(own.union(known)))
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(hits, arrow.field("hits").type), pa.array(items, arrow.field("items").type)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs."""
    place = docs.columns.index("text")
    for block in pattern_blocks(benchmark, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, held=held):
            tables = Patterns(held.value, window)
            for batch in small_slices(batches):
                yield batch.filter(pa.array([not tables.search(words(t))[0] for t in batch.column(place).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def overlap_digests(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return find_overlaps(docs, benchmark, window).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
