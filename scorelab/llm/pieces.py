"""SentencePiece encoding and decoding with a max-plus parallel scan.

A text is encoded by its best path over the pieces of a public SentencePiece vocabulary:
the segmentation with the largest sum of piece scores.  Giant documents are cut into chunks
of fixed size.  What happens at a cut is a small state, the number of characters that the
piece crossing the cut takes from the next chunk.  Each chunk yields a matrix with the best
score from every entry state to every exit state; max-plus products combine matrices in any
grouping, so products of blocks are formed in parallel, and a scan over the blocks and then
over the chunks gives the best scores with which each chunk is entered.  From these each chunk
tells where its path to every exit state comes in; such maps are combined in the same way,
backwards, and each chunk is backtraced on its own.  Scores are integers, so that the
grouping cannot change a sum.  Of equally good paths the one with the longest last piece
counts, and so on towards the front: ids do not depend on where a text is cut.

Between two characters that are neighbours in no piece every path has a boundary.  Texts
are cut at such places (word starts, mostly), and short parts are looked up once per worker.
"""

from __future__ import annotations

import re
from functools import cached_property
from math import log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab.llm.common import small_slices
from scorelab.session import materialise

#: Path of the vocabulary; pass another one to use other pieces.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Longer texts are encoded in chunks of this many characters.
CHUNK = 1 << 16
#: Chunks whose matrices one task multiplies.
BLOCK = 256
#: Parts up to this length are remembered, and so many of them.
SHORT, MEMO = 48, 250_000
SCALE = 1 << 20
NEVER = -(1 << 60)
#: Base of the polynomial hash of ids, modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
SLICE = 2 << 20


class Vocabulary:
    """Pieces with integer scores, and the regular expression that cuts at certain boundaries.

    Unigram vocabularies keep their own scores.  Those of merge vocabularies are merge ranks,
    which do not add up; the rank r then stands for the score log(1 / (r + 2.7)), less the log of
    the sum of all weights (Zipf and Mandelbrot's law).  Characters without a piece cost ten more than the worst
    piece and become byte pieces.  A space is held as a space; the escape sign itself, where a
    text has it, is spelled in bytes, so that decoding gives back every text.
    """

    def __init__(self, model: str):
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=model)
        size = loaded.get_piece_size()
        plain = [i for i in range(size) if not (loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_byte(i) or loaded.is_unused(i))]
        raw = {i: loaded.get_score(i) for i in plain}
        if all(float(v).is_integer() for v in raw.values()):
            order = {i: r for r, i in enumerate(sorted(plain, key=lambda i: (-raw[i], i)))}
            norm = log(sum(1 / (r + 2.7) for r in order.values()))
            raw = {i: -log(r + 2.7) - norm for i, r in order.items()}
        self.texts = {i: loaded.id_to_piece(i).replace("▁", " ") for i in plain}
        self.pieces = {self.texts[i]: (round(raw[i] * SCALE), i) for i in plain}
        self.unknown = round((min(raw.values()) - 10) * SCALE)
        self.bytes = [loaded.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        #: What each id spells, and what it scores.
        self.spelled = [b""] * size
        self.scores = [self.unknown] * size
        for i, text in self.texts.items():
            self.spelled[i], self.scores[i] = text.encode(), self.pieces[text][0]
        for b, i in enumerate(self.bytes):
            self.spelled[i] = bytes([b])
        self.longest = max(map(len, self.pieces))
        self.pairs = {t[i : i + 2] for t in self.pieces for i in range(len(t) - 1)}
        inside = "".join(map(re.escape, (c for c in "\n\r\t" if all(c not in p for p in self.pairs))))
        spaced = not any(p[1] == " " and p[0] != " " for p in self.pairs)
        self.parts = re.compile(rf"[{inside}]| *[^ {inside}]+| +" if inside and spaced else r" *[^ ]+| +" if spaced else r"(?s).+")

    @cached_property
    def matcher(self) -> ahocorasick.Automaton:
        """Finds all pieces in a text; built where it is used."""
        found = ahocorasick.Automaton()
        for text, (score, i) in self.pieces.items():
            found.add_word(text, (len(text), score, i))
        found.make_automaton()
        return found

    @cached_property
    def singles(self) -> frozenset:
        return frozenset(text for text in self.pieces if len(text) == 1)

    @cached_property
    def strange(self) -> re.Pattern:
        """Finds a character without a piece of its own."""
        return re.compile("[^" + "".join(map(re.escape, sorted(self.singles))) + "]")

    @cached_property
    def memo(self) -> dict:
        """Ids of short parts; lives as long as the worker."""
        return {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("matcher", "singles", "strange", "memo")}

    def forward(self, text: str, start: int, end: int, ahead: list[int] = (0,)) -> tuple[list, list, list]:
        """Best scores from ``start`` to every position, length and id (-1: none) of the last piece.

        Pieces begin before ``end``; they may reach beyond it, up to the end of the text.  Paths
        may also begin at the positions after ``start``, with the scores of ``ahead``; there the
        length is 0 as long as no piece gives more.
        """
        text = text[start : min(len(text), end + self.longest - 1)]
        size, limit = len(text), end - start
        best, back, ids = [NEVER] * (size + 1), [0] * (size + 1), [-1] * (size + 1)
        best[: len(ahead)] = ahead[: size + 1]
        strange = [i for i, c in enumerate(text) if c not in self.singles] if not self.singles.issuperset(text) else []
        strange.append(size)
        at = 0
        # By end, the longest piece first: of equal scores the longer last piece stays.
        for last, (n, score, i) in self.matcher.iter(text):
            while strange[at] < last and strange[at] < limit:
                self._unknown(strange[at], best, back, ids)
                at += 1
            begin = last + 1 - n
            if begin < limit:
                score += best[begin]
                if score > best[last + 1]:
                    best[last + 1], back[last + 1], ids[last + 1] = score, n, i
        for place in strange[at:-1]:
            if place < limit:
                self._unknown(place, best, back, ids)
        return best, back, ids

    def _unknown(self, place: int, best: list, back: list, ids: list) -> None:
        if best[place] > NEVER and best[place] + self.unknown > best[place + 1]:
            best[place + 1], back[place + 1], ids[place + 1] = best[place] + self.unknown, 1, -1

    def path(self, text: str, start: int, end: int, reach: int | None = None) -> list[int]:
        """Ids of the best path from ``start`` to ``reach`` (``end`` if not given)."""
        _, back, last = self.forward(text, start, end)
        place, ids = (end if reach is None else reach) - start, []
        while place:
            if last[place] < 0:
                ids.extend(self.bytes[b] for b in reversed(text[start + place - 1].encode("utf-8", "surrogatepass")))
            else:
                ids.append(last[place])
            place -= back[place]
        return ids[::-1]

    def part(self, part: str) -> tuple[int, ...]:
        """Ids of a part between two certain boundaries."""
        found = self.memo.get(part)
        if found is None:
            found = self.plain_path(part) if self.strange.search(part) is None else tuple(self.path(part, 0, len(part)))
            if len(part) <= SHORT and len(self.memo) < MEMO:
                self.memo[part] = found
        return found

    def plain_path(self, part: str) -> tuple[int, ...]:
        """As ``path``, for a whole part all of whose characters have a piece."""
        place = len(part)
        best, last = [NEVER] * (place + 1), [None] * (place + 1)
        best[0] = 0
        for end, piece in self.matcher.iter(part):
            end += 1
            score = best[end - piece[0]] + piece[1]
            if score > best[end]:
                best[end], last[end] = score, piece
        ids = []
        while place:
            n, _, i = last[place]
            ids.append(i)
            place -= n
        ids.reverse()
        return tuple(ids)

    def score(self, part: str) -> int:
        return self.forward(part, 0, len(part))[0][-1] if self.strange.search(part) else sum(map(self.scores.__getitem__, self.part(part)))

    def parts_ids(self, text: str) -> list[int]:
        ids: list[int] = []
        known, part_ids = self.memo.get, self.part
        for part in self.parts.findall(text):
            ids += known(part) or part_ids(part)
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, which gets a space in front."""
        return self.parts_ids(" " + text) if text else []

    def raw(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.raw(ids).decode("utf-8", "surrogatepass")[1:]

    def cuts(self, text: str, start: int, end: int) -> tuple[int, int]:
        """First and last certain boundary inside (start, end); (end, end) if there is none."""
        pairs = self.pairs
        first = next((i for i in range(start + 1, end) if text[i - 1 : i + 1] not in pairs), end)
        last = next((i for i in range(end - 1, first - 1, -1) if text[i - 1 : i + 1] not in pairs), end)
        return first, last

    def matrix(self, text: str, size: int) -> np.ndarray:
        """Best score from every entry to every exit state of a chunk of ``size`` characters.

        ``text`` also holds the characters after the chunk that a crossing piece can take.
        """
        states = self.longest
        found = np.full((states, states), NEVER, np.int64)
        first, last = self.cuts(text, 0, size)
        rows = {}
        if first < size:
            middle = sum(map(self.score, self.parts.findall(text[first:last])))
            tail = self.forward(text, last, size)[0]
            exits = {j: tail[size + j - last] for j in range(states) if size + j - last < len(tail)}
            for entry in range(min(states, first + 1)):
                head = self.forward(text[:first], entry, first)[0]
                rows[entry] = {j: head[first - entry] + middle + v for j, v in exits.items() if v > NEVER} if head[first - entry] > NEVER else {}
        else:
            for entry in range(min(states, size)):
                best = self.forward(text, entry, size)[0]
                rows[entry] = {j: best[size + j - entry] for j in range(states) if size + j - entry < len(best)}
        for entry, values in rows.items():
            for j, v in values.items():
                found[entry, j] = v
        return found

    def origins(self, text: str, size: int, ahead: list[int]) -> list[int]:
        """For every exit state of a chunk the entry state of its path, where ``ahead`` are the scores of the entries.

        A piece that comes in from the chunk before is longer than any that ends at the same
        place and begins here, so of equal scores the entry stays.
        """
        first, _ = self.cuts(text, 0, size)
        if first < size:
            # All paths meet at the first certain boundary.
            back = self.forward(text[:first], 0, first, ahead)[1]
            exits = [first] * self.longest
        else:
            back = self.forward(text, 0, size, ahead)[1]
            exits = [min(size + j, len(back) - 1) for j in range(self.longest)]
        return [_first_place(back, place) for place in exits]

    def between(self, text: str, entry: int, size: int, leave: int) -> list[int]:
        """Ids of a chunk's best path from one entry to one exit state."""
        first, last = self.cuts(text, 0, size)
        if first >= size or entry > first:
            return self.path(text, entry, size, size + leave)
        return self.path(text[:first], entry, first) + self.parts_ids(text[first:last]) + self.path(text, last, size, size + leave)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; what cannot be reached stays so."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), NEVER)


def _first_place(back: list[int], place: int) -> int:
    while back[place]:
        place -= back[place]
    return place


def scores_ahead(matrices: list[np.ndarray], ahead: np.ndarray) -> list[np.ndarray]:
    """The scores of the entry states of each factor, where ``ahead`` are those of the first."""
    found = []
    for m in matrices:
        found.append(ahead)
        ahead = np.maximum((ahead[:, None] + m).max(0), NEVER)
    return found


def at_start(states: int) -> np.ndarray:
    """The scores of the entry states of a text: nothing comes in."""
    ahead = np.full(states, NEVER)
    ahead[0] = 0
    return ahead


def states_back(origins: list[np.ndarray], leave: int) -> list[tuple[int, int]]:
    """Entry and exit state of each factor, where the last one is left in state ``leave``."""
    found = []
    for own in reversed(origins):
        found.append((int(own[leave]), leave))
        leave = int(own[leave])
    return found[::-1]


def powers(n: int) -> np.ndarray:
    steps = np.full(n, BASE, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


def checksum(ids: list[int]) -> int:
    """Sum of (id + 1) * BASE ** position modulo 2 ** 64, which adds up over chunks."""
    values = np.array(ids, np.uint64) + np.uint64(1)
    return int((values * powers(len(ids))).sum(dtype=np.uint64).astype(np.int64)) if ids else 0


#: What is made of a text and its ids: the ids themselves, or counts and a hash.
IDS = "ids array<int>, text string"
DIGEST = "n_tokens long, ids_hash long, round_trip boolean"


def _ids(vocabulary: Vocabulary, ids: list, texts: list) -> list[pa.Array]:
    return [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]


def _digests(vocabulary: Vocabulary, ids: list, texts: list) -> list[pa.Array]:
    same = [vocabulary.raw(i or []) == (t or "").encode("utf-8", "surrogatepass") for i, t in zip(ids, texts)]
    return [pa.array([len(i or []) for i in ids], pa.int64()), pa.array([checksum(i or []) for i in ids], pa.int64()), pa.array(same, pa.bool_())]


def _encoded(docs: DataFrame, model: str, chunk: int, finish, result: str) -> tuple[DataFrame, DataFrame]:
    """Texts encoded whole, and the chunks of giant ones."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(model)
    held = spark.sparkContext.broadcast(vocabulary)  # one vocabulary, some MB whatever the input
    head = f"doc_id {dict(docs.dtypes)['doc_id']}, row string, chunk int, n_chunks int"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    giant = F.coalesce(F.char_length("text"), F.lit(0)) > chunk
    whole = rows.where(~giant).mapInArrow(_encode_whole(held, finish, result), f"{head}, {result}")
    # Giant texts are written once as chunks, so that the passes below agree on them.
    chunks = materialise(rows.where(giant).mapInArrow(_cut(chunk, vocabulary.longest), f"{head}, size int, text string"), "chunks")
    matrices = materialise(chunks.select("row", "chunk", "n_chunks", "size", "text").mapInArrow(_matrices(held), "row string, block int, chunk int, matrix binary"), "matrices")
    products = matrices.groupBy("row", "block").applyInPandas(_block_product, "row string, block int, matrix binary")
    # Forwards: the scores with which blocks, then chunks, are entered.
    blocks = products.groupBy("row").applyInPandas(_block_ahead, "row string, block int, ahead binary")
    entered = matrices.join(blocks, ["row", "block"]).groupBy("row", "block").applyInPandas(_chunk_ahead, "row string, chunk int, ahead binary")
    # Backwards: where paths come in, by chunk, then by block.
    origins = materialise(chunks.join(entered, ["row", "chunk"]).select("row", "chunk", "size", "text", "ahead").mapInArrow(
        _origins(held), "row string, block int, chunk int, origins binary"), "origins")
    left = origins.groupBy("row", "block").applyInPandas(_block_origins, "row string, block int, origins binary").groupBy("row").applyInPandas(
        _block_leave, "row string, block int, leave int")
    states = origins.join(left, ["row", "block"]).groupBy("row", "block").applyInPandas(_chunk_states, "row string, chunk int, entry int, leave int")
    parts = chunks.join(states, ["row", "chunk"]).select("doc_id", "row", "chunk", "n_chunks", "size", "text", "entry", "leave").mapInArrow(
        _backtrace(held, finish, result), f"{head}, {result}")
    return whole, parts


def encode(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, row, chunk, n_chunks, ids, text): one row per text, one per chunk of a giant text.

    ``row`` tells rows with equal doc_ids apart, ``text`` is what the ids stand for, with one
    space in front of the document.  Null texts have null ids and text, empty ones no ids.  Other
    columns are ignored.
    """
    whole, parts = _encoded(docs, model, chunk, _ids, IDS)
    return whole.unionByName(parts)


def _batch(names: list[str], columns: list) -> pa.RecordBatch:
    kinds = {"chunk": pa.int32(), "n_chunks": pa.int32(), "text": pa.string(), "row": pa.string(), "matrix": pa.binary(), "block": pa.int32(), "size": pa.int32(), "origins": pa.binary()}
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[n]) for n, c in zip(names, columns)], names=names)


def _names(result: str) -> list[str]:
    return ["doc_id", "row", "chunk", "n_chunks", *(field.split()[0] for field in result.split(", "))]


def _encode_whole(held, finish, result):
    def run(batches):
        vocabulary, names = held.value, _names(result)
        task, seen = TaskContext.get().partitionId(), 0
        for batch in small_slices(batches, limit=SLICE):
            texts = batch.column(1).to_pylist()
            ids = [None if t is None else vocabulary.encode(t) for t in texts]
            rows = [f"w{task}-{seen + i}" for i in range(len(texts))]
            seen += len(texts)
            yield _batch(names, [batch.column(0), rows, [0] * len(texts), [1] * len(texts), *finish(vocabulary, ids, [t and f" {t}" for t in texts])])

    return run


def _cut(chunk: int, longest: int):
    def run(batches):
        task, seen = TaskContext.get().partitionId(), 0
        for batch in small_slices(batches):
            for doc, text in zip(batch.column(0), batch.column(1).to_pylist()):
                text = f" {text}"
                # The last chunk is longer than a piece, so that no piece jumps over it.
                starts = [s for s in range(0, len(text), chunk) if s == 0 or len(text) - s > longest]
                ends = [*starts[1:], len(text)]
                n = len(starts)
                columns = [pa.array([doc.as_py()] * n, doc.type), [f"g{task}-{seen}"] * n, list(range(n)), [n] * n, [e - s for s, e in zip(starts, ends)], [text[s : e + longest - 1] for s, e in zip(starts, ends)]]
                yield _batch(["doc_id", "row", "chunk", "n_chunks", "size", "text"], columns)
                seen += 1

    return run


def _matrices(held):
    def run(batches):
        vocabulary = held.value
        for batch in small_slices(batches, limit=SLICE):
            rows, chunks, _, sizes, texts = (c.to_pylist() for c in batch.columns)
            found = [vocabulary.matrix(t, s).tobytes() for t, s in zip(texts, sizes)]
            yield _batch(["row", "block", "chunk", "matrix"], [rows, [c // BLOCK for c in chunks], chunks, found])

    return run


def _square(data: bytes) -> np.ndarray:
    values = np.frombuffer(data, np.int64)
    side = int(len(values) ** 0.5)
    return values.reshape(side, side)


def _block_product(pdf):
    pdf = pdf.sort_values("chunk")
    total = None
    for data in pdf["matrix"]:
        total = _square(data) if total is None else product(total, _square(data))
    return pdf.head(1)[["row", "block"]].assign(matrix=[total.tobytes()])


def _block_ahead(pdf):
    pdf = pdf.sort_values("block")
    matrices = [_square(d) for d in pdf["matrix"]]
    return pdf[["row", "block"]].assign(ahead=[a.tobytes() for a in scores_ahead(matrices, at_start(len(matrices[0])))])


def _chunk_ahead(pdf):
    pdf = pdf.sort_values("chunk")
    found = scores_ahead([_square(d) for d in pdf["matrix"]], np.frombuffer(pdf["ahead"].iloc[0], np.int64))
    return pdf[["row", "chunk"]].assign(ahead=[a.tobytes() for a in found])


def _origins(held):
    def run(batches):
        vocabulary = held.value
        for batch in small_slices(batches, "text", SLICE):
            rows, chunks, sizes, texts, ahead = (c.to_pylist() for c in batch.columns)
            found = [np.array(vocabulary.origins(t, n, np.frombuffer(a, np.int64).tolist()), np.int32).tobytes() for t, n, a in zip(texts, sizes, ahead)]
            yield _batch(["row", "block", "chunk", "origins"], [rows, [c // BLOCK for c in chunks], chunks, found])

    return run


def _block_origins(pdf):
    total = None
    for data in pdf.sort_values("chunk")["origins"]:
        own = np.frombuffer(data, np.int32)
        total = own if total is None else total[own]
    return pdf.head(1)[["row", "block"]].assign(origins=[total.tobytes()])


def _block_leave(pdf):
    pdf = pdf.sort_values("block")
    found = states_back([np.frombuffer(d, np.int32) for d in pdf["origins"]], 0)
    return pdf[["row", "block"]].assign(leave=[x for _, x in found])


def _chunk_states(pdf):
    pdf = pdf.sort_values("chunk")
    found = states_back([np.frombuffer(d, np.int32) for d in pdf["origins"]], int(pdf["leave"].iloc[0]))
    return pdf[["row", "chunk"]].assign(entry=[e for e, _ in found], leave=[x for _, x in found])


def _backtrace(held, finish, result):
    def run(batches):
        vocabulary, names = held.value, _names(result)
        for batch in small_slices(batches, limit=SLICE):
            ids, shown = [], []
            for size, text, entry, leave in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6, 7))):
                ids.append(vocabulary.between(text, entry, size, leave))
                shown.append(text[entry : size + leave])
            yield _batch(names, [*batch.columns[:4], *finish(vocabulary, ids, shown)])

    return run


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, row, chunk, n_chunks, text`` from ids: each chunk's characters, the first without its space.

    Chunk texts in order make up the document; null ids give a null text.
    """
    held = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model))
    kind = dict(encoded.dtypes)["doc_id"]

    def run(batches):
        vocabulary = held.value
        for batch in small_slices(batches, "ids", SLICE):
            texts = []
            for chunk, ids in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                text = None if ids is None else vocabulary.raw(ids).decode("utf-8", "surrogatepass")
                texts.append(text[1:] if text and chunk == 0 else text)
            yield _batch(["doc_id", "row", "chunk", "n_chunks", "text"], [*batch.columns[:4], texts])

    return encoded.select("doc_id", "row", "chunk", "n_chunks", "ids").mapInArrow(run, f"doc_id {kind}, row string, chunk int, n_chunks int, text string")


def encoding_digests(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_tokens, n_chunks, ids_hash and round_trip (decoding gives the text back) of every row.

    Counts and hashes are formed per chunk and added up, so no row ever holds a giant document's ids.
    """
    whole, parts = _encoded(docs, model, chunk, _digests, DIGEST)
    whole = whole.select("doc_id", "n_tokens", "n_chunks", "ids_hash", "round_trip")
    kind = dict(parts.dtypes)["doc_id"]
    pieces = parts.groupBy("row", "doc_id").applyInPandas(_joined_hash, f"doc_id {kind}, n_tokens long, n_chunks int, ids_hash long, round_trip boolean")
    return whole.unionByName(pieces)


def _joined_hash(pdf):
    pdf = pdf.sort_values("chunk")
    total = place = 0
    for n, h in zip(pdf["n_tokens"], pdf["ids_hash"]):
        total = (total + int(h) * pow(BASE, place, 1 << 64)) % (1 << 64)
        place += int(n)
    complete = len(pdf) == int(pdf["n_chunks"].iloc[0])
    signed = total - (1 << 64) if total >> 63 else total
    return pdf.head(1)[["doc_id"]].assign(n_tokens=place, n_chunks=len(pdf), ids_hash=signed, round_trip=bool(pdf["round_trip"].all() and complete))
