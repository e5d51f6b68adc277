"""Language identification with bit-sliced Bloom filters of n-grams.

Each language owns one Bloom filter of its letter 4-grams; the filters are stored sliced, one
bit mask of languages per slot, so one probe answers for all languages at once: the AND of a
few slots is the set of languages that have the n-gram.  A text's hits per language are
corrected by the false-positive rate of that language's filter; the largest corrected share
decides.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab.llm.common import fold, map_texts, small_slices
from scorelab.session import materialise

N = 4
PROBES = 3
#: A filter holds every n-gram that the language has at least so many times; one occurrence is noise.
MIN_COUNT = 2
#: Filters have 12 slots per n-gram of the richest language, up to 2 ** 23 slots (64 MB for 64 languages).
#: Beyond, n-grams still all go in; the false-positive rate grows and is taken out.
MAX_BITS = 23
PENDING = 1 << 21

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@cache
def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, the text each belongs to, and letters per text.

    Lower case, everything but letters is a space, one space is put around each text; n-grams
    with fewer than two letters say nothing and are left out.
    """
    low = [f"  {text.lower()}  " if text else "    " for text in texts]
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    alpha = letters()[codes]
    codes = np.where(alpha, codes, 32).astype(np.uint64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
    per_text = np.bincount(owner[alpha], minlength=len(low))
    count = len(codes) - N + 1
    keep = np.ones(len(codes), bool)
    for back in range(1, N):
        keep[ends - back] = False
    keep = keep[:count]
    hashes, dense = np.zeros(count, np.uint64), np.zeros(count, np.uint8)
    for i in range(N):
        hashes += codes[i : i + count] * _MULTIPLIERS[i]
        dense += alpha[i : i + count]
    keep &= dense >= 2
    hashes = hashes[keep]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return hashes, owner[:count][keep], per_text


def ngram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows with a language: counted per task first, then summed."""
    def run(batches):
        pending: dict[str, list] = {}
        size = 0

        def rows():
            for lang, parts in pending.items():
                grams, index = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(index, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for batch in small_slices(batches):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                grams, _, _ = ngrams([t for t, own in zip(texts, langs) if own == lang])
                found = np.unique(grams, return_counts=True)
                pending.setdefault(lang, []).append(found)
                size += len(found[0])
            if size > PENDING:
                yield from rows()
                pending, size = {}, 0
        yield from rows()

    found = docs.where("lang IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def places(grams: np.ndarray, bits: int):
    """The slots of each n-gram, one array per probe."""
    mask = np.uint64((1 << bits) - 1)
    step = (grams >> np.uint64(40)) | np.uint64(1)
    for i in range(PROBES):
        yield ((grams + np.uint64(i) * step * np.uint64(0x9E3779B1)) & mask).astype(np.int64)


def size_bits(most: int) -> int:
    """Bits of a slot number, where the richest language has ``most`` n-grams."""
    return min(MAX_BITS, max(10, int(np.ceil(np.log2(4 * PROBES * max(most, 1))))))


class Filters:
    """The sliced filters (a row of 64-bit words per slot) and what is needed to read them.

    ``langs`` come in the order in which equal shares are resolved.
    """

    def __init__(self, langs: list[str], bits: int, slots: np.ndarray):
        self.langs, self.bits, self.slots = langs, bits, slots
        self.false_rate = np.array([float(np.mean(slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1))) ** PROBES for i in range(len(langs))])

    def shares(self, grams: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Per text and language the share of n-grams in the language, false positives taken out."""
        n = np.maximum(np.bincount(owner, minlength=texts), 1)
        shares = np.zeros((texts, len(self.langs)))
        first, *rest = places(grams, self.bits)
        for word in range(self.slots.shape[1]):
            column = self.slots[:, word]
            masks = column[first]
            for place in rest:
                masks &= column[place]
            for i in range(64 * word, min(64 * word + 64, len(self.langs))):
                hits = np.bincount(owner[(masks >> np.uint64(i % 64) & np.uint64(1)).astype(bool)], minlength=texts)
                shares[:, i] = np.maximum(0, hits / n - self.false_rate[i]) / (1 - self.false_rate[i] + 1e-12)
        return shares


def slot_masks(numbers: dict[str, int], bits: int):
    """(slot, word, mask) of (lang, gram) rows, as far as one batch goes; masks of a slot are to be ORed."""
    def run(batches):
        for batch in batches:
            owners = np.fromiter((numbers[x] for x in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            grams = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            slots = np.concatenate(list(places(grams, bits)))
            owners = np.tile(owners, PROBES)
            masks = (np.uint64(1) << (owners % 64).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(owners // 64), pa.array(masks)], names=["slot", "word", "mask"])

    return run


def fit(docs: DataFrame, min_count: int = MIN_COUNT) -> Filters:
    """Filters from all rows of ``docs`` with a language.

    Slots are filled by an aggregate; the driver gets one row per language and at most 2 ** ``MAX_BITS``
    slots for every 64 of them, whatever the corpus.  Languages with more n-grams come first.
    """
    counts = materialise(ngram_counts(docs), "ngrams")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count_if(F.col("n") >= min_count).alias("kept"))
    known = sorted(sizes.collect(), key=lambda r: (-r.total, r.lang))
    langs = [r.lang for r in known]
    bits = size_bits(max((r.kept for r in known), default=0))
    numbers = {lang: i for i, lang in enumerate(langs)}
    masks = counts.where(F.col("n") >= min_count).select("lang", "gram").mapInArrow(slot_masks(numbers, bits), "slot long, word long, mask long")
    table = masks.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    slots = np.zeros((1 << bits, (len(langs) + 63) // 64), np.uint64)
    place, word, mask = (table.column(n).to_numpy() for n in ("slot", "word", "mask"))
    slots[place, word] = mask.view(np.uint64)
    return Filters(langs, bits, slots)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred and score (share of the winner among all languages) of every row.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything when no
    language was learned.  Equal shares go to the language with more n-grams in training, then to
    the first by name; so does a text without any known n-gram, with score 0.  Repeated rows and
    null ids keep their rows; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(filters)

    def rows_of(ids, texts):
        filters = held.value
        grams, owner, letters_in = ngrams(texts)
        if not filters.langs:
            return {"doc_id": ids, "lang_pred": ["und"] * len(ids), "score": [0.0] * len(ids)}
        shares = filters.shares(grams, owner, len(ids))
        best = shares.argmax(1)
        total = shares.sum(1)
        score = np.where(total > 0, shares[np.arange(len(ids)), best] / np.where(total > 0, total, 1), 0.0)
        known = letters_in > 0
        return {"doc_id": ids, "lang_pred": [filters.langs[b] if k else "und" for b, k in zip(best, known)], "score": np.where(known, score, 0.0)}

    return map_texts(docs, rows_of, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def train_part(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: every fifth id, by crc32, is held out."""
    return docs.where(fold("doc_id", 5) != 0)
