"""Manifest and proofs against a plain tree, appends against whole builds."""

from hashlib import sha256
from zlib import crc32

import pytest
from hypothesis import given
from hypothesis import strategies as st

from scorelab.llm import merkle, oracle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    """All levels of the tree, by pairs."""
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return found


def path(found, i):
    siblings = []
    for level in found[:-1]:
        if i ^ 1 < len(level):
            siblings.append((i & 1, level[i ^ 1]))
        else:
            siblings.append(None)
        i //= 2
    return siblings


def fold(leaf, siblings):
    for s in siblings:
        leaf = h(leaf) if s is None else h(s[1], leaf) if s[0] else h(leaf, s[1])
    return leaf


def brute(rows):
    """Expected rows of (doc_id, text, lang, source, n_chars)."""
    def leaf(doc_id, text, lang, source, n_chars):
        return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    built = {k: levels([x[2] for x in sorted(groups[k], key=lambda x: x[:3])]) for k in names}
    top = levels([built[k][-1][0] for k in names])
    out = []
    for at, k in enumerate(names):
        for i, (_, _, digest, row) in enumerate(sorted(groups[k], key=lambda x: x[:3])):
            siblings = path(built[k], i) + path(top, at)
            shown = digest
            if crc32(b"" if row[0] is None else str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                shown = leaf(*row[:4], row[4] + 1)
            folded = fold(shown, siblings)
            out.append((row[0], digest, built[k][-1][0], top[-1][0], h(*(s[1] for s in siblings if s)), folded, folded == top[-1][0]))
    return out


@given(st.integers(1, 70), st.integers(0, 70))
def test_appends_in_batches(n, first):
    nodes = [h(str(i)) for i in range(n)]
    accumulator, found = merkle.Accumulator(), levels(nodes)
    for i, node in enumerate(nodes):
        if i and i == first:
            accumulator.closed()  # asking for a root in between changes nothing
        accumulator.append(node)
    root, witnesses = accumulator.closed()
    assert root == found[-1][0]
    assert witnesses == [[s[1] for s in path(found, i) if s] for i in range(n)]
    assert all(merkle.folded(node, i, n, iter(w)) == root for i, (node, w) in enumerate(zip(nodes, witnesses)))


def key(row):
    return tuple(map(str, row))


@pytest.mark.parametrize("height", [1, 3, 10])
def test_contract(spark, small, height):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    made = merkle.document_proofs(docs, height)
    assert sorted(map(tuple, made.collect()), key=key) == sorted(brute(rows), key=key)
    assert 0 < made.where("NOT verified").count() < len(rows) / 3


def test_odd_rows(odd, odd_rows, none):
    assert sorted(map(tuple, merkle.document_proofs(odd, 2).collect()), key=key) == sorted(brute(odd_rows), key=key)
    assert merkle.document_proofs(none).count() == 0


def test_one_kind_with_most_rows(spark):
    rows = [(i, f"t{i}", "en" if i % 50 else None, "s", i) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert sorted(map(tuple, merkle.document_proofs(docs, 5).collect())) == sorted(brute(rows))


def test_twin(spark, small):
    from compare import difference, duck

    assert difference(spark, duck(small), lambda s, d: merkle.document_proofs(s.read.parquet(f"{d}/documents.parquet")), oracle.MERKLE, small) is None
