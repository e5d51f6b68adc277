"""Wu-Manber search against a plain comparison of all windows."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from scorelab.llm import decontaminate as D

WORDS = st.lists(st.sampled_from("the a cat dog of é x1".split()), max_size=40).map(" ".join)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        sequence = words(other)
        n = min(window, len(sequence))
        for i in range(len(sequence) - n + 1) if n else ():
            for j in range(len(own) - n + 1):
                if own[j : j + n] == sequence[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(item)
    return len(own), len(hit), found


@settings(max_examples=300, deadline=None)
@given(WORDS, st.lists(WORDS, max_size=5), st.sampled_from([1, 2, 3, 10]))
def test_search(text, others, window):
    items = [(str(i), t) for i, t in enumerate(others)]
    spans, found = D.Patterns(items, window).search(D.words(text))
    n, hit, expected = brute(text, items, window)
    assert (len(D.words(text)), sum(e - s for s, e in spans), found) == (n, hit, expected)


def test_contract(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    pairs = [(str(r.item_id), r.text) for r in items.collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = D.overlap_digests(docs, items).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, found = brute(texts[r.doc_id], pairs, 10) if r.contaminated or r.doc_id % 5 == 0 else (r.n_words, r.n_hit, set())
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_many_blocks_give_the_same(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    one, many = ({r.doc_id: (r.n_words, r.hits, r.items) for r in D.find_overlaps(docs, items, block_bytes=b).collect()} for b in (1 << 22, 3000))
    assert one == many
    assert D.drop_contaminated(docs, items, block_bytes=3000).count() == sum(not hits for _, hits, _ in one.values())


def test_odd_rows(spark, odd, odd_rows, none):
    items = spark.createDataFrame([(1, "sat on the mat and looked at the very old clock"), (1, "sat on the mat"), (None, "only a text"), (3, None), (4, ""), (5, "...")], "item_id long, text string")
    found = {(r.doc_id, r.n_items) for r in D.overlap_digests(odd, items).collect()}
    assert {(1, 1), (2, 0), (3, 0), (None, 1), (None, 0)} <= found
    kept = D.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows) - 3
    nothing = items.limit(0)
    assert D.overlap_digests(odd, nothing).count() == D.drop_contaminated(odd, nothing).count() == len(odd_rows)
    assert D.overlap_digests(none, items).collect() == D.drop_contaminated(none, items).collect() == []
