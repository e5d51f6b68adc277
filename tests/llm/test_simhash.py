"""Fingerprints, ball links, components and the survivors of near-dedup against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scorelab.llm import simhash
from scorelab.llm.components import connected


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if hashes and sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_roots(values, distance=4):
    values, parent = sorted(values), {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "a b c d", "The É cat\x0bsat  on THE mat", "x " * 50, "w\x85 nbsp\xa0joined a b c d e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_native_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("the é cat")).alias("h")).first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest("the é cat".encode(), 42)


@pytest.mark.parametrize("members", [4, 64, 2048])
def test_links(spark, members):
    """Random values, chains in steps of 4 bits and one crowd; small ``members`` split its bucket."""
    rng = np.random.default_rng(3)
    values = {int(x) for x in rng.integers(-(1 << 63), 1 << 63, 60)}
    chain = int(rng.integers(0, 1 << 62))
    for step in range(6):
        chain ^= 0b1111 << 8 * step
        values.add(chain)
    centre = int(rng.integers(0, 1 << 62))
    values |= {centre ^ 1 << int(b) for b in range(60)} | {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (100, 2))} | {0, -1, -(1 << 63)}
    table = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {r.u: r.root for r in connected(simhash.links(table, members=members)).collect()}
    assert {v: found.get(v, v) for v in values} == brute_roots(values)


def test_contract(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    mark = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    signed = {k: v - (1 << 64) if v >> 63 else v for k, v in mark.items()}
    roots = brute_roots(set(signed.values()))
    least = {}
    for k, v in signed.items():
        least[roots[v]] = min(k, least.get(roots[v], k))
    from __spark_entry__ import queries

    for r in queries()["op2_simhash"](spark, small).collect():
        assert r.fingerprint == f"{mark[r.doc_id]:016x}" and r.component_id == least[roots[signed[r.doc_id]]]


def test_near_copies_by_shingles(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, base = [], [rng.choice(vocabulary, 400).tolist() for _ in range(30)]
    for i, words in enumerate(base):
        rows.append((i, " ".join(words)))
        close = list(words)
        for p in rng.integers(0, 400, 4):
            close[p] = "edited"
        rows.append((100 + i, " ".join(close)))  # about 0.9 of the shingles in common
        far = list(words)
        far[::12] = ["other"] * len(far[::12])
        rows.append((200 + i, " ".join(far)))  # about 0.4
    found = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[100 + i] == i for i in range(30)) >= 29
    assert all(found[200 + i] == 200 + i for i in range(30))


def brute_similar(texts, words=5, similarity=0.8):
    """Smallest index reachable over pairs with so many shingles in common."""
    sets = [{tuple(t[i : i + words]) for i in range(max(1, len(t) - words + 1))} for t in map(str.split, texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def test_near_copies_with_passages_and_moved_parts(spark):
    """Appended, replaced and moved passages, and a crowd whose members are alike only among themselves."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    draw = lambda n: rng.choice(vocabulary, n).tolist()
    texts = []
    for base, more in [(200, 45), (200, 20), (400, 90), (1000, 200), (30, 6)]:
        for _ in range(8):
            words = draw(base)
            texts += [words, words + draw(more)]
    for base, cut in [(200, 16), (1000, 80)]:
        for _ in range(8):
            words = draw(base)
            texts += [words, words[:50] + draw(cut) + words[50 + cut :]]
    for _ in range(6):  # all of one word set; only the last two are similar
        parts = [draw(10) for _ in range(20)]
        words = sum(parts, [])
        texts += [sum((parts[i] for i in rng.permutation(20)), []) for _ in range(4)] + [words, [words[1], words[0], *words[2:]]]
    crowd = draw(120)
    for _ in range(60):
        words = list(crowd)
        for p in rng.integers(0, 120, 4):
            words[p] = str(rng.choice(vocabulary))
        texts.append(words)
    texts = [" ".join(t) for t in texts]
    found = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()}
    assert [found[i] for i in range(len(texts))] == brute_similar(texts)


def test_odd_rows(odd, odd_rows, none):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == len(odd_rows)
    assert {r.component_id for r in found if r.doc_id in (2, 3, 4)} == {2}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    # Texts without words are alike; the null id with a text of its own stays.
    assert sorted(map(str, ids)) == sorted(["1", "2", "5", "6", "7", "None"])
    assert simhash.near_duplicates(none).collect() == simhash.keep_one(none).collect() == []


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 50)] + [(7, 7), (5, 3), (3, 5)]
    found = {r.u: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 50)}


def test_stage_compares_near_fingerprints_first(spark, monkeypatch):
    """The pipeline's stage asks fingerprints for its first pairs, and an exact join finds the rest."""
    long = " ".join(f"w{i}" for i in range(400))
    texts = [long, long + " end", long, "", None, "a b", "other words entirely", long.replace("w7 ", "x ")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked, whole = [], simhash.fingerprint_pairs
    monkeypatch.setattr(simhash, "fingerprint_pairs", lambda nodes: asked.append(nodes.count()) or whole(nodes))
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [0, 3, 5, 6]
    assert asked == [3]  # texts that share a shingle with another; copies once
    nodes = spark.createDataFrame([(1, long), (2, long + " end"), (3, "a b"), (4, "a b")], "node long, text string")
    near = {(r.u, r.v) for r in whole(nodes).collect()}
    assert (4, 3) in near and all(u > v for u, v in near) and not near & {(3, 1), (3, 2)}
