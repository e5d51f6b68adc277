"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within 4 bits have a common variant within 2 bits of both.  So every
distinct fingerprint emits its 2,081 variants, equal variants meet, and their owners are
linked.  Owners that meet are within 4 bits of each other, all of them, so linking each to the
smallest one loses nothing and lists no pairs within a group.

Variants are shuffled by a bucket, their leading bits.  The variants of one fingerprint that
share a bucket travel as that one fingerprint and are spelled out where they arrive, which
cuts the shuffle from 2,081 rows a fingerprint to some tens.  Buckets that would hold too
many variants are split by a linear hash of the variant: every part knows from a fingerprint's
own hash which variants fall to it.
"""

from __future__ import annotations

from functools import cache, partial
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab.llm.common import map_texts, small_slices
from scorelab.llm.components import connected
from scorelab.session import materialise

BITS, DISTANCE = 64, 4
SEED = 42
WORDS = 4
#: Fingerprints whose variants one task spells out at a time.
MEMBERS = 2048
#: Shingles in so many texts of a slice are ordered last, the most frequent ones of all slices at most so many.
OFTEN, COMMON = 3, 1_000_000
#: Rounds that compare each text with one head before all remaining pairs are listed.
ROUNDS = 2
#: Pairs held before they are handed on.
PAIRS = 1 << 17
#: Shingles whose bits are counted at a time.
STEP = 1 << 15


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bit i is set when over half of the shingles' XXH64 have it; no words give zero."""
    data = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not data:
        return 0
    n = max(1, len(data) - words + 1)
    joined = b" ".join(data)
    ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(words, len(data)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, STEP):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + STEP], stops[at : at + STEP])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long; null and empty texts have zero."""
    def rows_of(ids, texts):
        found = np.array([fingerprint(t, words) for t in texts], np.uint64)
        return {"doc_id": ids, "fp": found.view(np.int64).tolist()}

    return map_texts(docs, rows_of, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long")


def masks(bits: int, radius: int) -> np.ndarray:
    """All words with at most ``radius`` (up to 2) of the low ``bits`` bits."""
    single = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    i, j = np.triu_indices(bits, 1)
    parts = [np.zeros(1, np.uint64), single, single[i] | single[j]]
    return np.concatenate(parts[: radius + 1])


@cache
def _linear() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 16, BITS, dtype=np.uint64)


def linear_hash(values: np.ndarray) -> np.ndarray:
    """XOR of one fixed 16-bit number per set bit, so that h(a ^ b) = h(a) ^ h(b)."""
    found = np.zeros(len(values), np.uint64)
    for i, number in enumerate(_linear()):
        found ^= (values >> np.uint64(i) & np.uint64(1)) * number
    return found


def links_of_bucket(key: tuple, pdf: pd.DataFrame, prefix: int, radius: int) -> pd.DataFrame:
    """Star links among the fingerprints whose variants meet in one part of a bucket."""
    bucket, part, parts = (int(x) for x in key)
    low = BITS - prefix
    values = np.unique(pdf["fp"].to_numpy().view(np.uint64))
    left = radius - np.bitwise_count((values >> np.uint64(low)) ^ np.uint64(bucket)).astype(np.int64)
    high = np.uint64(bucket) << np.uint64(low)
    tails = values & np.uint64((1 << low) - 1)
    classes = linear_hash(tails) & np.uint64(parts - 1)
    variants, owners = [], []
    for remaining in range(radius + 1):
        spread = masks(low, remaining)
        of_mask = linear_hash(spread) & np.uint64(parts - 1)
        for c in range(parts):
            mine = np.flatnonzero((left == remaining) & ((classes ^ np.uint64(part)) == c))
            if len(mine):
                found = tails[mine][:, None] ^ spread[of_mask == c][None, :]
                variants.append(found.ravel())
                owners.append(np.repeat(mine, found.shape[1]))
    none = pd.DataFrame({"u": np.array([], np.int64), "v": np.array([], np.int64)})
    if not variants:
        return none
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variants, kind="stable")
    variants, owners = variants[order], owners[order]
    fresh = np.concatenate([[True], variants[1:] != variants[:-1]])
    starts = np.flatnonzero(fresh)
    # values are sorted, so the smallest owner is the smallest fingerprint.
    least = np.minimum.reduceat(owners, starts)[np.cumsum(fresh) - 1]
    pairs = np.unique(least[least != owners].astype(np.int64) * len(values) + owners[least != owners])
    a, b = values[pairs // len(values)], values[pairs % len(values)]
    near = np.bitwise_count(a ^ b) <= 2 * radius
    return pd.DataFrame({"u": b[near].view(np.int64), "v": a[near].view(np.int64)})


def links(distinct: DataFrame, distance: int = DISTANCE, members: int = MEMBERS) -> DataFrame:
    """(u, v): links that connect all fingerprints within ``distance`` (even, up to 4) bits of each other.

    ``distinct`` holds each fingerprint once.  Bucket sizes come from counts per leading bits, at
    most a few thousand times fewer than fingerprints and never more than 65,536 numbers.
    """
    radius = distance // 2
    total = distinct.count()
    # About ``members`` fingerprints have their home in a bucket.
    prefix = min(max((max(total, 1) - 1).bit_length() - (members - 1).bit_length(), 2), 30)
    head = F.shiftrightunsigned("fp", BITS - prefix)
    coarse = min(prefix, 16)
    counts = np.zeros(1 << coarse, np.int64)
    for row in distinct.groupBy(F.shiftrightunsigned("fp", BITS - coarse).alias("head")).count().collect():
        counts[row["head"]] = row["count"]
    # Variants that a bucket gets, in units of a home member's variants: its own members count
    # most, those of neighbours in one leading bit less.
    low = BITS - prefix
    load = counts.astype(float) / (1 << (prefix - coarse))
    for bit in range(coarse):
        load += counts[np.arange(1 << coarse) ^ (1 << bit)] / (1 << (prefix - coarse)) * (low + 1) / len(masks(low, 2))
    parts = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(load / (2 * members), 1))).astype(int))
    crowded = [(int(b), int(parts[b])) for b in np.flatnonzero(parts > 1)]
    flips = F.array(*[F.lit(int(m)) for m in masks(prefix, radius)])
    spread = distinct.select("fp", F.explode(F.transform(flips, lambda m: head.bitwiseXOR(m))).alias("bucket"))
    number = F.lit(1)
    if crowded:
        split = distinct.sparkSession.createDataFrame(crowded, "coarse long, parts int")  # at most 65,536 rows
        spread = spread.withColumn("coarse", F.shiftrightunsigned("bucket", prefix - coarse)).join(F.broadcast(split), "coarse", "left")
        number = F.coalesce("parts", F.lit(1))
    spread = spread.select("fp", "bucket", number.alias("parts")).select("fp", "bucket", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    run = partial(links_of_bucket, prefix=prefix, radius=radius)
    return spread.groupBy("bucket", "part", "parts").applyInPandas(lambda key, pdf: run(key, pdf), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, root, component_id) of every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``distance`` bits, the
    row itself included; ``root`` names the component by a fingerprint.  Copies share a
    fingerprint and take part once.  Null ids take part but are no component's id unless it has
    no other (then null); repeated rows keep their rows; other columns are ignored.
    """
    marked = materialise(fingerprints(docs, words), "fingerprints")
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected(links(distinct.select("fp"), distance))
    rooted = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of so many words; of the whole text if it has fewer."""
    data = (text or "").lower().split()
    if not data:
        return np.array([], np.uint64)
    of_word = {w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), SEED) for w in set(data)}
    marks, n = np.fromiter(map(of_word.__getitem__, data), np.uint64, len(data)), max(1, len(data) - words + 1)
    found = np.zeros(n, np.uint64)
    for i in range(min(words, len(data))):
        found = found * np.uint64(0x9E3779B97F4A7C15) + marks[i : i + n]
    found = (found ^ found >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.unique(found ^ found >> np.uint64(29))


def distinct_texts(batches):
    """Lists of (node, text) per slice, every node once in a task, so that copies cost no more than one."""
    seen: set = set()
    for batch in small_slices(batches):
        fresh = [(n, t) for n, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if not (n in seen or seen.add(n))]
        if fresh:
            yield fresh


def common_shingles(noded: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts have, sorted, and their ranks from rare to frequent.

    They only decide which order the prefixes follow.  Every order finds the same pairs, so what
    a slice of texts misses or what lies beyond ``COMMON`` costs time and loses nothing.
    """
    def run(batches):
        for rows in distinct_texts(batches):
            values, counts = np.unique(np.concatenate([shingle_hashes(t, words) for _, t in rows]), return_counts=True)
            often = counts >= OFTEN
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["token", "n"])

    found = noded.select("node", "text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    table = found.orderBy(F.desc("n"), "token").limit(COMMON).toArrow()  # at most COMMON pairs of numbers
    values = table.column("token").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], (len(values) - order).astype(np.int64)


def prefix_of(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles in the global order, so many that two similar sets have one of them in common."""
    values, ranks = common
    if len(values) and len(hashes):
        at = np.minimum(np.searchsorted(values, hashes), len(values) - 1)
        hit = values[at] == hashes
        hashes = np.concatenate([hashes[~hit], hashes[hit][np.argsort(ranks[at[hit]], kind="stable")]])
    return hashes[: len(hashes) - ceil(similarity * len(hashes) - 1e-9) + 1]


def prefixes(noded: DataFrame, words: int, similarity: float) -> DataFrame:
    """(token, node, size, place): the prefix shingles of every text.  Texts without words share token 0."""
    held = noded.sparkSession.sparkContext.broadcast(common_shingles(noded, words))

    def run(batches):
        for rows in distinct_texts(batches):
            sets = [shingle_hashes(t, words) for _, t in rows]
            heads = [prefix_of(s, held.value, similarity) if len(s) else np.zeros(1, np.uint64) for s in sets]
            lengths = np.array([len(h) for h in heads])
            columns = [np.concatenate(heads).view(np.int64), np.repeat(np.array([n for n, _ in rows], np.int64), lengths),
                       np.repeat(np.array([len(s) for s in sets], np.int32), lengths), np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "node", "size", "place"])

    return noded.select("node", "text").mapInArrow(run, "token long, node long, size int, place int")


def whole_groups(batches):
    """Columns of batches sorted by their first one, cut where its value changes."""
    held: list = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        cut = int(np.searchsorted(columns[0], columns[0][-1]))
        if cut or held and held[0][0][-1] != columns[0][0]:
            done = [*held, [c[:cut] for c in columns]]
            yield [np.concatenate(c) for c in zip(*done)]
            held = []
        held.append([c[cut:] for c in columns])
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def crowds(tokens: DataFrame) -> DataFrame:
    """The rows of tokens that two nodes or more have, each node once."""
    def run(batches):
        for columns in whole_groups(batches):
            token, node = columns[:2]
            fresh = np.ones(len(token), bool)
            fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            columns = [c[fresh] for c in columns]
            same = columns[0][1:] == columns[0][:-1]
            shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            yield pa.RecordBatch.from_arrays([pa.array(c[shared]) for c in columns], names=["token", "node", "size", "place"])

    return tokens.repartition("token").sortWithinPartitions("token", "node").mapInArrow(run, tokens.schema)


def pairs_across(rows: DataFrame, similarity: float) -> DataFrame:
    """(u, v) of all nodes of different roots that have a token in common and can be similar.

    Sizes bound the similarity, and so does what follows the first common token in either set.
    """
    def run(batches):
        for token, size, node, place, root in whole_groups(batches):
            left = np.arange(len(token) - 1)
            step, held, n = 1, [], 0
            while len(left):
                left = left[left + step < len(token)]
                right = left + step
                near = (token[left] == token[right]) & (size[left] >= similarity * size[right] - 1e-9)
                left, right = left[near], right[near]
                most = np.minimum(size[left] - place[left], size[right] - place[right])
                kept = (root[left] != root[right]) & (most * (1 + similarity) >= similarity * (size[left].astype(np.int64) + size[right]) - 1e-6)
                held.append(np.column_stack([np.maximum(node[left[kept]], node[right[kept]]), np.minimum(node[left[kept]], node[right[kept]])]))
                n, step = n + len(held[-1]), step + 1
                if n >= PAIRS or not len(left):
                    found = np.unique(np.concatenate(held), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])
                    held, n = [], 0

    rows = rows.select("token", "size", "node", "place", "root").repartition("token").sortWithinPartitions("token", "size", "node")
    return rows.mapInArrow(run, "u long, v long").distinct()


def similar(pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(u, v) of the rows (u, v, a, b) whose texts a and b share enough of their shingles."""
    def run(batches):
        held, own = None, np.array([], np.uint64)
        for batch in small_slices(batches, "b"):
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if held is None or a != held:
                    held, own = a, shingle_hashes(a, words)
                other = shingle_hashes(b, words)
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(both >= similarity * (len(own) + len(other) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def fingerprint_pairs(texts: DataFrame) -> DataFrame:
    """(u, v) of the nodes of ``texts`` (node, text), each once, that fingerprints link: to the smallest node with
    the same fingerprint, and these nodes by ``links``."""
    marked = materialise(fingerprints(texts.select(F.col("node").alias("doc_id"), "text")), "fingerprints")
    heads = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("head")), "heads")
    same = marked.join(heads, "fp").where("doc_id <> head").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    found = links(heads.select("fp")).join(heads.select(F.col("fp").alias("u"), F.col("head").alias("a")), "u").join(heads.select(F.col("fp").alias("v"), F.col("head").alias("b")), "v")
    return same.unionAll(found.select("a", "b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, node, root, component_id) as ``near_duplicates`` gives, for similarity of word shingles.

    Copies are one node, the hash of the text.  Texts whose fingerprints are near are compared first, and
    what is similar is contracted.  An exact join finds what fingerprints miss: in any one order of
    all shingles, two sets with ``similarity`` in common share one of their first few, here the rare
    ones first.  Some rounds compare each node with one head of its crowds and contract what is similar; then all
    pairs that share a prefix shingle, can reach the similarity by their sizes and places and
    are not yet in one component are compared by their whole texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    noded = docs.select("doc_id", F.xxhash64(text).alias("node"), text.alias("text"))
    marked = materialise(noded.select("doc_id", "node"), "marks")
    nodes = materialise(marked.groupBy("node").agg(F.min("doc_id").alias("first")), "nodes")
    rows = materialise(crowds(prefixes(noded, words, similarity)), "crowds")
    # Texts of candidates only, each once.
    wanted = rows.select("node").distinct()
    texts = materialise(noded.select("node", "text").join(wanted, "node", "left_semi").dropDuplicates(["node"]), "texts")

    def verified(edges):
        pairs = edges.join(texts.select(F.col("node").alias("u"), F.col("text").alias("b")), "u").join(texts.select(F.col("node").alias("v"), F.col("text").alias("a")), "v")
        return materialise(similar(pairs, words, similarity), "links")

    # Texts that share no prefix shingle with another are similar to none, so candidates' fingerprints are enough.
    linked = verified(materialise(fingerprint_pairs(texts), "candidates"))
    rows = rows.join(connected(linked).withColumnRenamed("u", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = materialise(rows.select("token", "node", "size", "place", "root"), "crowds")
    for turn in range(ROUNDS):
        # First the most ordinary text of each crowd, whose first shingles are nearly all shared, as an
        # unedited original's are; then any one.
        shared = rows.groupBy("node").agg(F.count("*").alias("shared")) if turn == 0 else rows.select("node", F.lit(0).alias("shared")).distinct()
        ranked = rows.join(shared.withColumn("draw", F.struct(-F.col("shared"), F.xxhash64("node", F.lit(turn)))), "node")
        heads = ranked.groupBy("token").agg(F.min(F.struct("draw", "node", "root", "size")).alias("head"))
        tried = rows.join(heads, "token").where("root <> head.root").where(F.least("size", "head.size") >= similarity * F.greatest("size", "head.size") - 1e-9)
        edges = materialise(tried.groupBy("node").agg(F.min("head").alias("head")).select(F.greatest("node", "head.node").alias("u"), F.least("node", "head.node").alias("v")).distinct(), "candidates")
        linked = linked.unionAll(verified(edges))
        roots = connected(linked)
        rooted = rows.drop("root").join(roots.withColumnRenamed("u", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
        rows = materialise(rooted.join(apart, "token", "left_semi").select("token", "node", "size", "place", "root"), "crowds")
    edges = materialise(pairs_across(rows, similarity), "candidates")
    roots = connected(linked.unionAll(verified(edges)))
    rooted = nodes.join(roots.withColumnRenamed("u", "node"), "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.join(least, "root").select("node", "root", "component_id"), "node").select("doc_id", "node", "root", "component_id")


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """``docs``, all columns, with one row of each component of ``near_copies``: the smallest doc_id.

    The decision is joined by doc_id.  Rows whose id is null or repeated are told apart by their
    texts' hashes, and one of those that could stay does.
    """
    found = materialise(near_copies(docs, **how), "components")
    rows = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.col("doc_id") == F.col("component_id")).alias("first"))
    once = rows.where("doc_id IS NOT NULL AND n = 1")
    columns = {name: f"column_{i}_" for i, name in enumerate(docs.columns)}
    own, renamed = columns["doc_id"], docs.toDF(*columns.values())
    sure = renamed.join(once.where("first").select(F.col("doc_id").alias(own)), own, "left_semi")
    doubtful = renamed.join(once.select(F.col("doc_id").alias(own)), own, "left_anti").withColumn("node_", F.xxhash64(F.coalesce(F.col(columns["text"]).cast("string"), F.lit(""))))
    repeated = rows.where("doc_id IS NOT NULL AND n > 1").select("doc_id")
    firsts = found.where("component_id IS NULL").unionAll(found.where("doc_id = component_id").join(repeated, "doc_id", "left_semi").select(*found.columns))
    firsts = firsts.select(F.col("node").alias("node_"), F.col("root").alias("root_"), F.col("component_id").alias("first_")).distinct()
    kept = doubtful.join(firsts, "node_").where(F.col(own).eqNullSafe(F.col("first_"))).dropDuplicates(["root_"])
    names = [F.col(temp).alias(name) for name, temp in columns.items()]
    return sure.select(*names).unionAll(kept.select(*names))
