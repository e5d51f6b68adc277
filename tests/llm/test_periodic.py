"""Periodic runs against brute force over all periods, tiles against whole documents."""

import hashlib
import random
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorelab.llm import periodic


def brute(words, least=12):
    """Sorted (start, length, period): every maximal stretch, tried period by period."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        x = None
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                x = i if x is None else x
            elif x is not None:
                if i - x + q >= max(least, 2 * q):
                    best.setdefault((x, i - x + q), q)
                x = None
    return sorted((s, n, q) for (s, n), q in best.items())


def brute_row(doc_id, text):
    words = periodic.WORD.findall(text or "")
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if top[0] is None else 1000 * top[1] // top[2]
    return (doc_id, len(runs), *top, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def tiled(words, least):
    ids = periodic.numbered(words)
    found = [(q, x + low, y + low) for s, low, core, end, part in periodic.tiles(ids, least)
             for q, x, y in periodic.solve(part.tolist(), periodic.Windows(part), s, least, core, end)]
    return periodic.stitched(found)


def runs_of(fragments):
    best = {}
    for q, x, y in fragments:
        best[x, y - x + q] = min(q, best.get((x, y - x + q), q))
    return sorted((s, n, q) for (s, n), q in best.items())


pieces = st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 9)), max_size=8)


@settings(max_examples=400, deadline=None)
@given(pieces, st.sampled_from([2, 3, 6, 12, 20]))
def test_runs_of_repeated_pieces(parts, least):
    words = [c for piece, times in parts for c in piece * times]
    assert runs_of(periodic.fragments_of(periodic.numbered(words), least)) == brute(words, least)


@pytest.mark.parametrize("core", [16, 64])
def test_tiles_give_the_same(monkeypatch, core):
    monkeypatch.setattr(periodic, "CORE", core)
    draw = random.Random(5)
    for _ in range(120):
        words = []
        while len(words) < draw.choice([30, 300, 700]):
            block = [draw.choice("abcdefgh") for _ in range(draw.choice([1, 2, 3, 5, 17, 40, 90]))]
            words += block * draw.choice([1, 1, 2, 3, 12])
        assert runs_of(tiled(words, 12)) == brute(words) == runs_of(periodic.fragments_of(periodic.numbered(words), 12))


def test_one_word_and_nested_periods():
    for words in (["a"] * 5000, list("ab") * 2000, (list("ab") * 30 + ["c"]) * 20, ["a"] * 400 + ["b"] + ["a"] * 400):
        assert runs_of(periodic.fragments_of(periodic.numbered(words), 12)) == brute(words)


def test_contract(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").where(F.length("text") < 6000)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    made = periodic.run_digests(docs.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text")))
    assert sorted(map(tuple, made.collect())) == sorted(brute_row(*r) for r in rows)
    assert made.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_dealt_tiles(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))
    whole = periodic.run_digests(docs)
    dealt = periodic.run_digests(docs, in_place=100)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, whole.collect()))


def test_long_periods(spark):
    draw = random.Random(1)
    block = [f"w{draw.randrange(10**6)}" for _ in range(40_000)]
    words = ["head"] * 3 + block * 3 + block[:100] + ["tail"]
    [row] = periodic.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string"), in_place=1000).collect()
    assert tuple(row) == (1, 3, 120_100, 40_000)


def test_odd_rows(odd, odd_rows, none):
    short = [r for r in odd_rows if r[0] != 5]
    made = periodic.run_digests(odd.where("doc_id IS NULL OR doc_id <> 5").select("*", F.lit(1).alias("period"), F.lit("k").alias("key")))
    key = lambda r: tuple(map(str, r))
    plain = [(i, *brute_row("x", t)[1:]) for i, t, *_ in short]
    assert sorted(map(tuple, made.collect()), key=key) == sorted(plain, key=key)
    assert periodic.run_digests(odd).count() == len(odd_rows)
    assert periodic.run_digests(none).count() == 0 and periodic.periodic_runs(none).count() == 0
