"""Encoding against the library's own best-path search, chunks against whole texts, exact round trips."""

import random

import pytest

from scorelab.llm import pieces as P


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary(P.MODEL)


@pytest.fixture(scope="module")
def library(vocabulary):
    """The same pieces and scores in the library's own unigram mode; nothing is trained."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(P.MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.type == 1:
            piece.score = vocabulary.pieces[piece.piece.replace("▁", " ")][0] / P.SCALE
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def value(vocabulary, ids):
    return sum(vocabulary.pieces[vocabulary.texts[i]][0] for i in ids if i in vocabulary.texts)


def test_library_agrees(spark, small, vocabulary, library):
    texts = [r.text[:3000] for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    equal = 0
    for text in texts:
        ours, theirs = vocabulary.encode(text), library.encode(text)
        equal += ours == theirs
        # The library adds up in single precision, so equal or nearly equal paths may differ.
        assert ours == theirs or abs(value(vocabulary, ours) - value(vocabulary, theirs)) < 1e-6 * abs(value(vocabulary, ours))
    assert equal > 0.9 * len(texts)


def chunked(v, text, size):
    text = " " + text
    starts = [s for s in range(0, len(text), size) if s == 0 or len(text) - s > v.longest]
    parts = [(text[s : e + v.longest - 1], e - s) for s, e in zip(starts, [*starts[1:], len(text)])]
    matrices = [v.matrix(t, n) for t, n in parts]
    ids = []
    ahead = P.scores_ahead(matrices, P.at_start(v.longest))
    origins = [v.origins(t, n, a.tolist()) for (t, n), a in zip(parts, ahead)]
    for (t, n), (entry, leave) in zip(parts, P.states_back(origins, 0)):
        ids += v.between(t, entry, n, leave)
    total = matrices[0]
    for m in matrices[1:]:
        total = P.product(total, m)
    return ids, int(total[0, 0])


@pytest.mark.parametrize("alphabet", ["ab c", "the reation ", "aaaa", "the\n é漢▁ of", "==== ----", "    x"])
def test_chunks_give_the_same_path(vocabulary, alphabet):
    draw = random.Random(4)
    for _ in range(12):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(1, 250)))
        best = vocabulary.forward(" " + text, 0, len(text) + 1)[0][-1]
        for size in (20, 64):
            ids, score = chunked(vocabulary, text, size)
            assert score == best and vocabulary.decode(ids) == text
            assert ids == vocabulary.encode(text)


def test_products_are_associative(vocabulary):
    text = " " + "thereationofaaaa" * 12
    a, b, c = (vocabulary.matrix(text[s : s + 64 + vocabulary.longest - 1], 64) for s in (0, 64, 128))
    assert (P.product(P.product(a, b), c) == P.product(a, P.product(b, c))).all()


def test_giant_documents(spark, small, monkeypatch):
    """With small chunks and blocks most documents take the parallel path; nothing may change."""
    monkeypatch.setattr(P, "BLOCK", 3)
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    whole = {r.doc_id: r for r in P.encoding_digests(docs).collect()}
    cut = {r.doc_id: r for r in P.encoding_digests(docs, chunk=200).collect()}
    assert len(cut) == len(whole) == 60 and max(r.n_chunks for r in cut.values()) > 20
    assert all(r.round_trip for r in [*whole.values(), *cut.values()])
    assert all(whole[i].ids_hash == cut[i].ids_hash and whole[i].n_tokens == cut[i].n_tokens for i in whole)
    texts = {r.doc_id: r.text for r in docs.collect()}
    joined = {}
    for r in sorted(P.decode(P.encode(docs, chunk=200)).collect(), key=lambda r: r.chunk):
        joined[r.doc_id] = joined.get(r.doc_id, "") + r.text
    assert joined == texts


def test_odd_rows(odd, odd_rows, none):
    rows = P.encoding_digests(odd).collect()
    assert len(rows) == len(odd_rows) and all(r.round_trip for r in rows)
    assert all(r.n_tokens == 0 for r in rows if r.doc_id in (2, 3))
    assert [r.n_chunks for r in rows if r.doc_id == 5][0] > 5
    assert [r.ids for r in P.encode(odd).collect() if r.doc_id == 3] == [None]
    assert P.encoding_digests(none).collect() == []
