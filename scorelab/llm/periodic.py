"""Periodic runs of words: scale-tiled search, stitched per document and period.

A run with period q is a stretch of positions i with word i = word i + q.  Periods are taken by
octaves s <= q < 2s.  For each octave a document falls into overlapping tiles of some times s
words; a tile is solved without its neighbours.  Aligned boundaries whose window of words occurs
again one period later (by hashes of windows, so none is missed) are examined: a Z-function of
what follows the boundary and one of what precedes it, reversed, say how far each period of the
octave holds to the right and to the left.  What a tile finds are fragments, cut at its edges.
They are shuffled by document and period, and neighbours that meet are stitched.

Short documents are tiled and solved where they are; the tiles of longer ones are dealt to all
tasks.  The fragments differ, the stitched runs do not.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scorelab.llm.common import reachable, small_slices
from scorelab.session import materialise

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Shortest run in words.
LEAST = 12
#: Documents of more words are dealt to all tasks tile by tile.
IN_PLACE = 1 << 17
#: Words in the core of a tile: at least this, and eight times the octave.
CORE = 8192
#: Window comparisons made at once.
BLOCK = 1 << 20

PARTS = "doc_id long, key string, text string, digest string, found array<struct<period: int, x: long, y: long>>, octave long, low long, core long, core_end long, ids binary"
RUN = "struct<start: long, length: long, period: long>"


def matches_needed(q: int, least: int) -> int:
    """Positions i with word i = word i + q in the shortest run of period q."""
    return max(least - q, q)


def gate_of(s: int, least: int) -> tuple[int, int]:
    """(step, window): every stretch that a run of this octave needs holds a whole window at a multiple of step."""
    turns = {s, 2 * s - 1, *(min(max(x, s), 2 * s - 1) for x in (least // 2, (least + 1) // 2))}
    needed = min(matches_needed(q, least) for q in turns)
    step = 1 << (((needed + 1) // 2).bit_length() - 1)
    return step, needed - step + 1


def reach(s: int, least: int) -> int:
    """Words that a tile looks beyond its core, so that a fragment cut there is surely long enough."""
    return max(2 * s, least)


class Windows:
    """Hashes of all windows of a given length, doubled from those of half the length."""

    def __init__(self, ids: np.ndarray):
        self.powers = {1: ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)}

    def mixed(self, size: int, apart: int) -> np.ndarray:
        half = self.powers[size]
        both = half[: len(half) - apart] * np.uint64(0xC2B2AE3D27D4EB4F) + half[apart:]
        return both ^ (both >> np.uint64(29))

    def of(self, length: int) -> np.ndarray:
        size = 1
        while 2 * size <= length:
            if 2 * size not in self.powers:
                self.powers[2 * size] = self.mixed(size, size)
            size *= 2
        return self.powers[size] if size == length else self.mixed(size, length - size)


def repeats(windows: Windows, n: int, s: int, least: int, start: int, end: int) -> Iterator[tuple[int, list[int]]]:
    """(b, periods): boundaries in [start, end) whose window occurs again a period of the octave later."""
    step, length = gate_of(s, least)
    hashes = windows.of(length)
    first = -(-start // step) * step
    # Rows of boundaries times the periods s .. 2s - 1; the last boundaries have fewer periods.
    rows = max(1, BLOCK // s)
    whole = min(end, len(hashes) - 2 * s + 1)
    if s >= 8 and whole > first:
        stride = hashes.strides[0]
        count = -(-(whole - first) // step)
        for at in range(0, count, rows):
            k = min(rows, count - at)
            b = first + at * step
            ahead = np.lib.stride_tricks.as_strided(hashes[b + s :], (k, s), (step * stride, stride), writeable=False)
            equal = ahead == hashes[b : b + (k - 1) * step + 1 : step, None]
            for row in np.flatnonzero(equal.any(axis=1)).tolist():
                yield b + row * step, (np.flatnonzero(equal[row]) + s).tolist()
        first += count * step
    if s >= 8:
        for b in range(first, min(end, len(hashes) - s), step):
            found = np.flatnonzero(hashes[b + s : b + 2 * s] == hashes[b])
            if len(found):
                yield b, (found + s).tolist()
        return
    found: dict[int, list[int]] = {}
    for q in range(s, 2 * s):
        left = hashes[first : max(0, min(end, len(hashes) - q)) : step]
        if len(left):
            right = hashes[first + q :: step][: len(left)]
            for row in np.flatnonzero(left == right).tolist():
                found.setdefault(first + row * step, []).append(q)
    yield from sorted(found.items())


def z_function(words: list, base: int, end: int, count: int) -> list[int]:
    """How long words[base + t : end] and words[base : end] agree, for t < count; t = 0 is left 0."""
    z, left, right = [0] * count, 0, 0
    for t in range(1, count):
        k = min(right - t, z[t - left]) if t < right else 0
        while base + t + k < end and words[base + k] == words[base + t + k]:
            k += 1
        z[t] = k
        if t + k > right:
            left, right = t, t + k
    return z


@lru_cache(maxsize=4096)
def maximal_divisors(q: int) -> tuple[int, ...]:
    """q divided by each of its primes."""
    found, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            found.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1:
        found.append(q // rest)
    return tuple(found)


def solve(words: list, windows: Windows, s: int, least: int, core: int, core_end: int) -> list[tuple[int, int, int]]:
    """(period, x, y): stretches x <= i < y with word i = word i + period, cut at the tile's edges.

    Those whose block of ``period`` words is itself periodic belong to a run of a smaller period
    and are left out.
    """
    n, far = len(words), reach(s, least)
    found, covered = [], {}
    for b, periods in repeats(windows, n, s, least, core, core_end):
        fresh = [q for q in periods if covered.get(q, -1) <= b]
        if not fresh:
            continue
        end = min(n, b + 2 * s + 4 * far)
        ahead = z_function(words, b, end, min(2 * s, end - b))
        low, top = max(0, b - far), min(n, b + 2 * s - 1)
        pattern = words[low:b][::-1]
        before = pattern + [-1] + words[low:top][::-1]
        back = z_function(before, 0, len(before), len(before) - (b - low)) if pattern else []
        for q in fresh:
            right = ahead[q] if q < len(ahead) else 0
            left = back[len(pattern) + 1 + top - b - q] if pattern and b + q <= top else 0
            if left + right < matches_needed(q, least):
                continue
            x, y = b - left, b + right
            # A fragment cut on the right goes on at a boundary shortly before the cut.
            covered[q] = y - far if y + q == end and end < n else y + 1
            if all(ahead[d] < q - d for d in maximal_divisors(q)):
                found.append((q, x, y))
    return found


def stitched(fragments: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of one task, those of one period that meet made one; saves rows in the shuffle."""
    whole: list = []
    for q, x, y in sorted(fragments):
        if whole and whole[-1][0] == q and x <= whole[-1][2]:
            whole[-1][2] = max(whole[-1][2], y)
        else:
            whole.append([q, x, y])
    return [tuple(f) for f in whole]


def octaves(n: int, least: int) -> Iterator[int]:
    s = 1
    while n >= least and 2 * s <= n:
        yield s
        s *= 2


def numbered(words: list[str]) -> np.ndarray:
    """Equal words have equal numbers."""
    ids: dict[str, int] = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], np.int32)


def tiles(ids: np.ndarray, least: int) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(octave, low, core, core_end, ids) of the tiles that hold a repeated window at all."""
    n, windows = len(ids), Windows(ids)
    for s in octaves(n, least):
        far, size = reach(s, least), max(8 * s, CORE)
        last = None
        for b, _ in repeats(windows, n, s, least, 0, n):
            core = b // size * size
            if core != last:
                last, low = core, max(0, core - far)
                yield s, low, core - low, core + size - low, ids[low : min(n, core + size + far + 2 * s)]


def fragments_of(ids: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    windows, words, found = Windows(ids), ids.tolist(), []
    for s in octaves(len(ids), least):
        found += solve(words, windows, s, least, 0, len(ids))
    return stitched(found)


def sha256(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


def search(docs: DataFrame, least: int = LEAST, in_place: int = IN_PLACE) -> tuple[DataFrame, DataFrame]:
    """(parts, fragments) of ``docs``; parts has a row for each document and one for each tile on its way.

    Texts stay in parts only where something was found or is still sought.
    """
    types = StructType.fromDDL(PARTS)

    def explode(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(types)
        for batch in small_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = WORD.findall(text or "")
                key = hashlib.md5((text or "").encode()).hexdigest()
                ids = numbered(words)
                if len(words) <= in_place:
                    found = [{"period": q, "x": x, "y": y} for q, x, y in fragments_of(ids, least)]
                    rows.append((doc_id, key, text if found else None, None if found else sha256(words), found or None, *[None] * 5))
                    continue
                rows.append((doc_id, key, text, None, None, *[None] * 5))
                for *tile, part in tiles(ids, least):
                    yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, (doc_id, key, None, None, None, *tile, part.tobytes())))], schema=arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def solved(batches):
        for batch in batches:
            for doc_id, key, s, low, core, core_end, ids in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, np.int32)
                found = stitched(solve(ids.tolist(), Windows(ids), s, least, core, core_end))
                rows = [{"doc_id": doc_id, "key": key, "period": q, "x": x + low, "y": y + low} for q, x, y in found]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("period", pa.int32()), ("x", pa.int64()), ("y", pa.int64())]))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = materialise(own.mapInArrow(explode, types), "run-parts")
    near = parts.where("found IS NOT NULL").select("doc_id", "key", F.inline("found"))
    sent = parts.where("octave IS NOT NULL").select("doc_id", "key", "octave", "low", "core", "core_end", "ids").repartition("key", "octave", "low")
    far = sent.mapInArrow(solved, "doc_id long, key string, period int, x long, y long")
    return parts.where("octave IS NULL").drop("octave", "low", "core", "core_end", "ids"), near.unionAll(far)


def stitch(fragments: DataFrame) -> DataFrame:
    """(doc_id, key, start, length, period): fragments of one document and period that meet are one run.

    Of runs with the same words the one with the smallest period stays.
    """
    ordered = W.partitionBy("doc_id", "key", "period").orderBy("x", "y")
    so_far = F.max("y").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    marked = fragments.withColumn("fresh_", (so_far.isNull() | (F.col("x") > so_far)).cast("long"))
    island = marked.withColumn("island_", F.sum("fresh_").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    whole = island.groupBy("doc_id", "key", "period", "island_").agg(F.min("x").alias("start"), F.max("y").alias("y"))
    runs = whole.select("doc_id", "key", "start", (F.col("y") - F.col("start") + F.col("period")).alias("length"), F.col("period").cast("long").alias("period"))
    return runs.groupBy("doc_id", "key", "start", "length").agg(F.min("period").alias("period"))


def periodic_runs(docs: DataFrame, least: int = LEAST, in_place: int = IN_PLACE) -> DataFrame:
    """(doc_id, start, length, period) of every run in ``docs``.

    Null and empty texts have none; repeated rows (same id and text) are one document; rows of
    one id with different texts each have their runs.  Other columns are ignored.
    """
    reachable(docs.sparkSession)
    return stitch(search(docs, least, in_place)[1]).select("doc_id", "start", "length", "period")


def collapse(rows: DataFrame) -> DataFrame:
    """(doc_id, runs, runs_sha256, collapsed_sha256) of the rows (doc_id, text, runs)."""
    def run(batches):
        for batch in small_slices(batches):
            out = []
            for doc_id, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                words = WORD.findall(text)
                dropped = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    dropped[r["start"] + r["period"]] += 1
                    dropped[r["start"] + r["length"]] -= 1
                keep = np.cumsum(dropped)[:-1] == 0
                lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
                out.append((doc_id, runs, hashlib.sha256(lines.encode()).hexdigest(), sha256([w for w, k in zip(words, keep.tolist()) if k])))
            types = [pa.int64(), batch.schema.field(2).type, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["doc_id", "runs", "runs_sha256", "collapsed_sha256"])

    return rows.select("doc_id", "text", "runs").mapInArrow(run, f"doc_id long, runs array<{RUN}>, runs_sha256 string, collapsed_sha256 string")


def run_digests(docs: DataFrame, least: int = LEAST, in_place: int = IN_PLACE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the greatest run and the two digests.

    The greatest run is the longest; ties go to the smallest start, then period.  Null and empty
    texts have no run: four nulls and the digests of the empty text.  Repeated rows keep their
    rows; a null id is an id like any other; other columns are ignored.
    """
    reachable(docs.sparkSession)
    parts, fragments = search(docs, least, in_place)
    runs = stitch(fragments).groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    texts, runs = parts.where("text IS NOT NULL").alias("d"), runs.alias("r")
    joined = texts.join(runs, F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.key") == F.col("r.key")), "left")
    found = collapse(joined.select("d.doc_id", "d.text", F.coalesce("r.runs", F.expr(f"CAST(array() AS array<{RUN}>)")).alias("runs")))
    none = parts.where("text IS NULL").select("doc_id", F.expr(f"CAST(array() AS array<{RUN}>)").alias("runs"), F.sha2(F.lit("").cast("binary"), 256).alias("runs_sha256"), F.col("digest").alias("collapsed_sha256"))
    best = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"])).when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    greatest = F.get(best, 0)
    return found.unionAll(none).withColumn("best_", greatest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best_.{n}").alias(n) for n in ("start", "length", "period")),
        F.floor(F.lit(1000) * F.col("best_.length") / F.col("best_.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a periodic end where crc32 of the id as text is divisible by ten (a null id counts as the empty text)."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN), F.lit(0))
    n = F.size(words)

    def rewritten(row):
        a = row["g"] % row["n"]
        p = 1 + F.floor((row["n"] - a) / (3 + row["g"] % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), row["n"] - 1), lambda i: F.get(row["w"], place(i).cast("int"))), " ")

    held = F.array(F.struct(words.alias("w"), n.cast("long").alias("n"), g.cast("long").alias("g")))
    changed = F.get(F.transform(F.filter(held, lambda row: row["n"] > 0), rewritten), 0)
    return F.when(h % 10 == 0, F.coalesce(changed, text)).otherwise(text)
