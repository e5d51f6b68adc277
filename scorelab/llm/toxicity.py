"""Toxicity by class-conditional Kneser-Ney models.

Two character 5-gram models of words, one of toxic and one of ordinary labelled documents.
Each discounts its own counts and hands the freed mass to one shared lower order, the
Kneser-Ney continuation counts of both classes, so an expression that neither class knows well
says the same under both.  The larger class's counts are scaled to the smaller class's size:
rare expressions are then discounted alike, and a word that only the larger class had the
chance to show does not count against the other.  A document's evidence is the difference of
the two log-likelihoods per word: over all words, and what single words add beyond two bounds.
A logistic curve fitted on training rows turns it into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cached_property
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab.llm.common import fold, reachable, small_slices
from scorelab.session import materialise

ORDER = 5
DISCOUNT = 0.75
#: Bounds in nats beyond which a word's evidence counts once more, and words of no evidence added to every length.
BOUNDS, PRIOR = (2.0, 4.0), 10
#: Labelled rows the logistic curve is fitted on.
CURVE_ROWS = 20_000
#: Labels (some 20 bytes each) that are sent to all executors; more are shuffled with the documents.
BROADCAST_LABELS = 2_000_000
#: Words and n-grams that a task counts before it hands them on, and word values it remembers.
PENDING = 300_000
#: Most frequent n-grams and contexts that every task holds (some 20 MB); words with others are joined.
HEAD = 300_000

WORD = re.compile(r"[^\W\d_]+")
PAD = "#" * (ORDER - 1)
FEATURES = ("mean", *(f"beyond{i}" for i in range(len(BOUNDS))))


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) outside the held-out fold; a null label is no label.

    Repeated labels of one id count once; the larger one holds.
    """
    return labels.where("toxic IS NOT NULL").where(fold("doc_id", 3) != 1).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def labelled(docs: DataFrame, known: DataFrame, most: int | None = None) -> DataFrame:
    """(text, toxic, side) of the documents with a label; side is a half of the ids by hash.

    ``known`` is a written table.  A join by shuffle would move all texts, so the labels are sent
    to the tasks where they are few by count (or surely at most ``most``).  The rows are the same.
    """
    count = known.count() if most is None else most
    side = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("side")
    return docs.select("doc_id", "text").join(F.broadcast(known) if count <= BROADCAST_LABELS else known, "doc_id").select("text", "toxic", side)


def grams_of(word: str) -> list[str]:
    """Each character of the padded word with the four before it."""
    padded = f"{PAD}{word}#"
    return [padded[i : i + ORDER] for i in range(len(padded) - ORDER + 1)]


def ngram_counts(rows: DataFrame) -> DataFrame:
    """(gram, ordinary, toxic, ordinary1, toxic1) over all words of the rows (text, toxic, side); the last two are side 1 alone.

    A task counts words first, so an n-gram is taken from each distinct word once, and sends
    n-grams, of which there are far fewer than words.
    """
    names = ["ordinary", "toxic", "ordinary1", "toxic1"]

    def run(batches):
        words, grams = [Counter() for _ in names], [{} for _ in names]

        def spelled():
            for own, counted in zip(grams, words):
                for word, n in counted.items():
                    for gram in grams_of(word):
                        own[gram] = own.get(gram, 0) + n
                counted.clear()

        def sent():
            spelled()
            every = list(set().union(*grams))
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *(pa.array([own.get(g, 0) for g in every], pa.int64()) for own in grams)], names=["gram", *names])
            for own in grams:
                own.clear()

        for batch in small_slices(batches):
            for text, toxic, side in zip(*(c.to_pylist() for c in batch.columns)):
                words[bool(toxic) + 2 * side].update(WORD.findall((text or "").lower()))
                if sum(map(len, words)) > PENDING:
                    spelled()
                if sum(map(len, grams)) > PENDING:
                    yield from sent()
        yield from sent()

    found = rows.select("text", "toxic", "side").mapInArrow(run, "gram string, " + ", ".join(f"{n} long" for n in names))
    sums = found.groupBy("gram").agg(*(F.sum(n).alias(n) for n in names))
    return sums.select("gram", *((F.col(n) + F.col(f"{n}1")).alias(n) for n in names[:2]), *names[2:])


def continuation(grams: DataFrame) -> DataFrame:
    """(gram, lower): the shared Kneser-Ney probability of the last letter of each n-gram one order below the top.

    An n-gram of any lower order counts once for each letter that comes before it.  One table holds
    all orders, with what the discounts of its context free; the chain of orders is then three joins.
    """
    suffixes = grams.select(F.explode(F.array(*(F.substring("gram", i, ORDER) for i in range(1, ORDER)))).alias("gram")).distinct()
    counts = suffixes.groupBy(F.substring("gram", 2, ORDER).alias("gram")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("context", F.expr("substring(gram, 1, length(gram) - 1)"))
    contexts = counts.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    parts = materialise(counts.join(contexts, "context").select("gram", F.length("gram").alias("order"), ((F.col("n") - DISCOUNT) / F.col("total")).alias("own"), (F.lit(DISCOUNT) * F.col("kinds") / F.col("total")).alias("freed"), "kinds"), "continuation")
    table = parts.where("order = 1").select("gram", (F.col("own") + F.col("freed") / (F.col("kinds") + 1)).alias("lower"))
    for order in range(2, ORDER):
        level = parts.where(F.col("order") == order).withColumn("suffix", F.substring("gram", 2, ORDER))
        table = level.join(table.withColumnRenamed("gram", "suffix"), "suffix").select("gram", (F.col("own") + F.col("freed") * F.col("lower")).alias("lower"))
    return table


def evidence(grams: DataFrame) -> DataFrame:
    """(key, n, value): log-likelihood ratio, toxic over ordinary, of every n-gram and every known context.

    The shared lower order cancels where neither class has the n-gram, so an unseen one needs only
    its context's two back-off weights.  Contexts are a letter shorter, so keys do not clash; n
    is how often the key was counted.
    """
    sizes = [x or 0 for x in grams.agg(F.sum("ordinary"), F.sum("toxic")).first()]
    scales = [min(sizes) / size if min(sizes) else 1.0 for size in sizes]
    scaled = grams.select("gram", F.substring("gram", 1, ORDER - 1).alias("context"), F.substring("gram", 2, ORDER - 1).alias("suffix"), (F.col("ordinary") + F.col("toxic")).alias("n"),
                          *((F.col(name) * F.lit(scale)).alias(f"c{k}") for k, (name, scale) in enumerate(zip(("ordinary", "toxic"), scales))))
    contexts = scaled.groupBy("context").agg(F.sum("n").alias("times"), *(F.sum(f"c{k}").alias(f"total{k}") for k in (0, 1)), *(F.sum(F.least(f"c{k}", F.lit(DISCOUNT))).alias(f"freed{k}") for k in (0, 1)))
    contexts = materialise(contexts.select("context", "times", "total0", "total1", *(F.when(F.col(f"total{k}") > 0, F.col(f"freed{k}") / F.col(f"total{k}")).otherwise(1.0).alias(f"weight{k}") for k in (0, 1))), "contexts")

    def logs(k):
        own = F.when(F.col(f"total{k}") > 0, F.greatest(F.col(f"c{k}") - DISCOUNT, F.lit(0.0)) / F.col(f"total{k}")).otherwise(0.0)
        return F.log(own + F.col(f"weight{k}") * F.col("lower"))

    known = scaled.join(contexts, "context").join(continuation(grams).withColumnRenamed("gram", "suffix"), "suffix")
    values = known.select(F.col("gram").alias("key"), "n", (logs(1) - logs(0)).alias("value"))
    return materialise(values.unionAll(contexts.select("context", "times", F.log("weight1") - F.log("weight0"))), "evidence")


class Reader:
    """Sums up the evidence of texts from a table of keys; ``whole`` says that no key is missing."""

    def __init__(self, values: dict[str, float], whole: bool):
        self.values, self.whole, self.memo = values, whole, {}

    def word(self, word: str) -> float | None:
        """The word's evidence; None if an n-gram or context may stand in the rest of the table."""
        found, total = self.values.get, 0.0
        for gram in grams_of(word):
            value = found(gram)
            if value is None:
                if not self.whole:
                    return None
                value = found(gram[:-1], 0.0)
            total += value
        return total

    def sums(self, text: str | None) -> tuple[tuple, dict[str, int]]:
        """(words, sums of the features) over the words known here, and the others with their times."""
        if len(self.memo) > PENDING:
            self.memo.clear()
        memo, values, times, others = self.memo, [], [], {}
        counted = Counter(WORD.findall(text.lower())) if text else Counter()
        for word, n in counted.items():
            if word not in memo:
                memo[word] = self.word(word)
            if memo[word] is None:
                others[word] = n
            else:
                values.append(memo[word])
                times.append(n)
        v, n = np.array(values), np.array(times)
        return (counted.total(), float((v * n).sum()), *(float((np.maximum(v - bound, 0) * n).sum()) for bound in BOUNDS)), others


def word_values(words: DataFrame, table: DataFrame) -> DataFrame:
    """(word, value): the evidence of each word by joins; unseen n-grams count by their contexts."""
    spelled = words.select("word", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(F.concat(F.lit(PAD), F.col("word"), F.lit("#")), i, F.lit(ORDER)))).alias("key"))
    asked = spelled.select("key").distinct().join(table.select("key", "value"), "key", "left")
    short = table.select(F.col("key").alias("context"), F.col("value").alias("backed"))
    found = asked.withColumn("context", F.substring("key", 1, ORDER - 1)).join(short, "context", "left").select("key", F.coalesce("value", "backed", F.lit(0.0)).alias("value"))
    return spelled.join(found, "key").groupBy("word").agg(F.sum("value").alias("value"))


def text_keys(text) -> list:
    return [F.xxhash64(text).alias("text_"), F.xxhash64(F.lit(1), text).alias("check_")]


def held(table: DataFrame) -> Reader:
    """The most frequent keys, ``HEAD`` at most, in the order of their counts."""
    head = table.orderBy(F.desc("n"), "key").limit(HEAD + 1).toArrow()
    keys, values = head.column("key").to_pylist(), head.column("value").to_pylist()
    return Reader(dict(zip(keys[:HEAD], values)), len(keys) <= HEAD)


def rest_features(docs: DataFrame, table: DataFrame, reader: Reader) -> DataFrame:
    """(text_, check_, features): what words beyond the reader's table add to each text that has any.

    Texts go by two hashes, so copies are one; each word meets its n-grams in a join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(reader)

    def run(batches):
        own = shared.value
        for batch in small_slices(batches):
            rows = [(*key, word, n) for text, *key in zip(*(batch.column(i).to_pylist() for i in (2, 0, 1))) for word, n in own.sums(text)[1].items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.int64()))], names=["text_", "check_", "word", "times"])

    found = docs.select(*text_keys("text"), "text").mapInArrow(run, "text_ long, check_ long, word string, times long")
    found = materialise(found.dropDuplicates(["text_", "check_", "word"]), "other-words")
    valued = found.join(word_values(found.select("word").distinct(), table), "word")
    beyond = [F.sum(F.col("times") * F.greatest(F.col("value") - bound, F.lit(0.0))).alias(f"rest_beyond{i}_") for i, bound in enumerate(BOUNDS)]
    return materialise(valued.groupBy("text_", "check_").agg(F.sum(F.col("times") * F.col("value")).alias("rest_mean_"), *beyond), "other-evidence")


def with_features(docs: DataFrame, table: DataFrame) -> DataFrame:
    """``docs``, all columns, with the evidence per word of each text: of all words, and beyond each bound.

    Tasks sum up what they hold.  While that is the whole table nothing is shuffled; else the other
    words' evidence is joined by text, and every word counts, in whichever way.
    """
    reader = held(table)
    shared = docs.sparkSession.sparkContext.broadcast(reader)
    fields = docs.schema.fields
    at = docs.columns.index("text")
    renamed = docs.toDF(*(f"column_{i}_" for i in range(len(fields))))
    added = ", ".join(f"{name}_ double" for name in FEATURES)
    schema = ", ".join(f"column_{i}_ {f.dataType.simpleString()}" for i, f in enumerate(fields))

    def run(batches):
        own = shared.value
        for batch in small_slices(batches, f"column_{at}_"):
            sums = [own.sums(text)[0] for text in batch.column(at).to_pylist()]
            columns = [pa.array([s[k] for s in sums], pa.float64() if k else pa.int64()) for k in range(len(FEATURES) + 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "words_", *(f"{name}_" for name in FEATURES)])

    found = renamed.mapInArrow(run, f"{schema}, words_ long, {added}")
    sums = {name: F.col(f"{name}_") for name in FEATURES}
    if not reader.whole:
        rest = rest_features(docs, table, reader)
        found = found.withColumns({"text_": F.xxhash64(f"column_{at}_"), "check_": F.xxhash64(F.lit(1), f"column_{at}_")}).join(rest, ["text_", "check_"], "left")
        sums = {name: column + F.coalesce(f"rest_{name}_", F.lit(0.0)) for name, column in sums.items()}
    return found.select(*(F.col(f"column_{i}_").alias(f.name) for i, f in enumerate(fields)), *((column / (F.col("words_") + PRIOR)).alias(f"{name}_") for name, column in sums.items()))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton steps with a small ridge; columns of x should be of order one."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Counts of all n-grams, their evidence as a table, and the curve over it; without a table one score for all."""

    def __init__(self, weights: list[float], table: DataFrame | None = None):
        self.weights, self.table = weights, table

    @cached_property
    def reader(self) -> Reader:
        """All evidence on the client, to score single texts of a small corpus; no DataFrame is scored by it."""
        if self.table is None:
            return Reader({}, True)
        found = self.table.toArrow()
        return Reader(dict(zip(found.column("key").to_pylist(), found.column("value").to_pylist())), True)

    def score(self, text: str | None) -> float:
        n, *sums = self.reader.sums(text)[0]
        z = sum(w * x for w, x in zip(self.weights, (*(s / (n + PRIOR) for s in sums), 1.0)))
        return 1 / (1 + exp(-max(-30.0, min(30.0, z))))

    def scored(self, docs: DataFrame) -> DataFrame:
        """``docs``, all columns, with ``score_``."""
        if self.table is None:
            found = docs.withColumns({f"{name}_": F.lit(0.0) for name in FEATURES})
        else:
            found = with_features(docs, self.table)
        z = sum((F.col(f"{name}_") * w for name, w in zip(FEATURES, self.weights)), F.lit(self.weights[-1]))
        score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
        return found.withColumn("score_", score).drop(*(f"{name}_" for name in FEATURES))


def fit(docs: DataFrame, labels: DataFrame, curve_rows: int = CURVE_ROWS) -> Model:
    """Model from the labelled rows of ``docs``; counts use all of them, the curve at most ``curve_rows``.

    Rare n-grams know the rows they were counted in, so the curve is fitted on one half of the rows
    with the evidence of the other half; only if that half has not both classes on all rows with
    the evidence of all.  Without training rows of both classes every text scores the share of toxic
    ones, 0 if none.
    """
    reachable(docs.sparkSession)
    known = materialise(training_labels(labels), "labels")
    grams = materialise(ngram_counts(labelled(docs, known)), "grams")
    table = evidence(grams)
    for apart in (True, False):
        # Chosen among the labels alone: a few bytes a row, never texts, go to the task that cuts.
        half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
        chosen = (known.where(half) if apart else known).orderBy(F.xxhash64("doc_id"), "doc_id").limit(curve_rows)
        marked = labelled(docs, materialise(chosen, "curve-labels"), curve_rows).select("toxic", "text")
        other = grams.select("gram", F.col("ordinary1").alias("ordinary"), F.col("toxic1").alias("toxic")).where("ordinary + toxic > 0")
        sample = with_features(marked, evidence(other) if apart else table).drop("text").toArrow()  # curve_rows rows of numbers
        y = np.array(sample.column("toxic").to_pylist(), float) > 0
        if 0 < y.sum() < len(y):
            x = np.column_stack([sample.column(f"{name}_") for name in FEATURES])
            scale = x.std(0) + 1e-9
            *w, base = logistic(x / scale, y.astype(float))
            return Model([*(float(v) for v in w / scale), float(base)], table)
    return Model([0.0] * len(FEATURES) + [30.0 if len(y) and y.all() else -30.0])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row; null and empty texts have no evidence and get the curve's base value.

    Repeated rows and null ids keep their rows; other columns are ignored.
    """
    return model.scored(docs.select("doc_id", "text")).select("doc_id", F.col("score_").alias("score"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold.

    Null and empty texts stay unless the model scores every text above it; repeated rows and null
    ids are judged by their texts alone.
    """
    columns = docs.columns
    numbered = docs.toDF(*(f"c{i}" if name != "text" else name for i, name in enumerate(columns)))
    kept = model.scored(numbered).where(F.col("score_") < threshold).drop("score_")
    return kept.toDF(*columns)
