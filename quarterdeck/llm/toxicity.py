"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence with telling words scores the logistic of the weights of its distinct features
(its words and their beginnings); one without scores nothing. A document's score is the noisy-or of its sentences' scores
and of a leak: the small chance that it offends without telling words, by the logarithm of its number of sentences. This
same score is what is trained, from document labels alone, in numpy, on a bounded sample of labelled rows, whose whole texts tasks reduce to the kept features of each
sentence; the sentence scores then locate what offends.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import among_least, learnable, materialise, read_table, slices

#: The training sample: labelled rows of each class at most. Their texts are read whole.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1_500, 3_500
#: Features kept, the least labelled toxic documents that hold one, the least ratio of its rates in toxic and clean documents, and the standard errors by which it has to lie above.
FEATURES, LEAST_DOCS, LEAST_RATIO, SURE = 20_000, 4, 3.0, 1.64
#: Lengths of the word beginnings that count as features besides the word.
BEGINNINGS = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
SENTENCE, TOKEN = regex.compile(r"[.!?\n|]+"), regex.compile(r"\w+")
#: Words whose features a task remembers.
REMEMBERED = 100_000


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


class WordFeatures(dict):
    """The kept features of a lower-case word; remembered up to a bound."""

    def __init__(self, kept: dict[str, float]):
        super().__init__()
        self.kept = kept

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = tuple(f for f in features(word) if f in self.kept)
        return value


@dataclass
class SentenceModel:
    """A weight for each kept feature, the bias of a sentence that has some, and the log odds of the leak: at no sentence, and its slope."""

    weights: dict[str, float]
    bias: float
    leak: tuple[float, float] = (-50.0, 0.0)

    def sentence_scores(self, text: str, words: WordFeatures | None = None) -> list[tuple[str, float]]:
        """Every sentence with a word in it and its score."""
        words = WordFeatures(self.weights) if words is None else words
        out = []
        for s in SENTENCE.split(text):
            if found := set(TOKEN.findall(s.lower())):
                own = {f for w in found for f in words[w]}
                out.append((s.strip(), _logistic(self.bias + math.fsum(map(self.weights.__getitem__, own))) if own else 0.0))
        return out

    def document_score(self, found: list[tuple[str, float]]) -> float:
        return noisy_or([_logistic(self.leak[0] + self.leak[1] * math.log1p(len(found))), *(s for _, s in found)])


def _logistic(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def noisy_or(scores: list[float]) -> float:
    """1 - prod(1 - s), as a sum of logarithms."""
    return -math.expm1(sum(math.log1p(-min(s, 1 - 1e-12)) for s in scores))


def text_features(text: str) -> set[str]:
    """The distinct features of a whole text."""
    return set().union(*map(features, set(TOKEN.findall(text.lower()))))


def sentence_features(text: str, number: dict[str, int]) -> Counter[tuple[int, ...]]:
    """How many sentences with a word in them hold which of the numbered features."""
    out = Counter()
    for s in SENTENCE.split(text):
        if words := set(TOKEN.findall(s.lower())):
            out[tuple(sorted({number[f] for w in words for f in features(w) if f in number}))] += 1
    return out


def train(texts: list[str], toxic: list[int], clean_weight: float = 1.0) -> SentenceModel:
    """The model of these texts. ``clean_weight`` restores the class ratio."""
    n1, n0 = sum(toxic), len(toxic) - sum(toxic)
    with1, with0 = Counter(), Counter()
    for label in (1, 0):  # of clean texts only what toxic ones hold is counted
        for text, y in zip(texts, toxic):
            if y == label:
                own = text_features(text)
                (with1 if y else with0).update(own if y else own & with1.keys())
    sure = lambda a, b: math.exp(-SURE * math.sqrt(1 / a + 1 / b))
    ratio = {f: (c / max(n1, 1)) / ((with0[f] + 0.5) / max(n0, 1)) * sure(c, with0[f] + 0.5) for f, c in with1.items() if c >= LEAST_DOCS}
    kept = sorted((f for f, r in ratio.items() if r >= LEAST_RATIO), key=lambda f: (-with1[f] * math.log(ratio[f]), f))[:FEATURES]
    number = {f: k for k, f in enumerate(kept)}
    return fit(kept, [sentence_features(t, number) for t in texts], toxic, clean_weight)


def loss_and_gradient(params: np.ndarray, bags: tuple[np.ndarray, ...], y: np.ndarray, cost: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """The cross entropy of the documents' noisy-or, with a penalty on the weights, and its gradient.

    ``params`` are the features' weights, a sentence's bias and the leak's two numbers. ``bags`` says of each document the
    logarithm of its sentences, of sentences alike their document and number, and (row, feature) of what they hold.
    """
    length, doc_of, times, rows, cols = bags
    w, b, a, c = params[:-3], params[-3], params[-2], params[-1]
    z, leak = b + np.bincount(rows, w[cols], len(doc_of)), a + c * length
    p, base = (1 / (1 + np.exp(-np.clip(v, -50, 50))) for v in (z, leak))
    log_clear = np.bincount(doc_of, -np.logaddexp(0, z) * times, len(y)) - np.logaddexp(0, leak)  # the chance that nothing offends
    clear = np.exp(log_clear)
    offends = np.maximum(1 - clear, 1e-9)
    pull = np.where(y > 0, -clear / offends, 1.0) * cost
    gz = pull[doc_of] * p * times
    loss = float((cost * np.where(y > 0, -np.log(offends), -log_clear)).sum() + penalty / 2 * (w * w).sum())
    return loss, np.concatenate([np.bincount(cols, gz[rows], len(w)) + penalty * w, [gz.sum(), (pull * base).sum(), (pull * base * length).sum()]])


def fit(kept: list[str], bags: list[Counter[tuple[int, ...]]], toxic: list[int], clean_weight: float = 1.0, rounds: int = 300, rate: float = 0.1, penalty: float = 5e-5) -> SentenceModel:
    """Fit weights, bias and leak by Adam; sentences alike count by their number."""
    alike = [(d, mine, n) for d, bag in enumerate(bags) for mine, n in sorted(bag.items()) if mine]
    length = np.log1p(np.array([sum(bag.values()) for bag in bags], float))
    doc_of = np.array([d for d, _, _ in alike], np.int64)
    times = np.array([n for _, _, n in alike], float)
    rows = np.repeat(np.arange(len(alike)), [len(mine) for _, mine, _ in alike]).astype(np.int64)
    cols = np.array([c for _, mine, _ in alike for c in mine], np.int64)
    y = np.array(toxic, float)
    cost = np.where(y > 0, 1.0, clean_weight)
    cost /= cost.sum()
    params = np.append(np.zeros(len(kept)), [-4.0, -4.0, 0.0])
    m, v = np.zeros(len(params)), np.zeros(len(params))
    for step in range(1, rounds + 1):
        _, g = loss_and_gradient(params, (length, doc_of, times, rows, cols), y, cost, penalty)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return SentenceModel(dict(zip(kept, params[:-3].tolist())), float(params[-3]), (float(params[-2]), float(params[-1])))


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int], float]:
    """doc_id, text (whole) and toxic of a bounded sample, its rows of each class, and the weight of a clean row that restores the ratio of the classes.

    Each class gives its rows of smallest hashed id, among rows that may be learned from; equal texts count once.
    """
    own = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learnable(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    counts = {r[0]: r[1] for r in own.groupBy("toxic").count().collect()}
    h = F.xxhash64("doc_id")
    part = [own.where((F.col("toxic") == t) & among_least(h, n, counts.get(t, 0))).orderBy(h, "doc_id").limit(n) for t, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    chosen = F.broadcast(part[0].unionByName(part[1]))  # at most the two limits
    rows = materialise(docs.select("doc_id", "text").join(chosen, "doc_id").where("text is not null").dropDuplicates(["text", "toxic"]), "labelled")
    drawn = {0: 0, 1: 0} | {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    rate = {t: counts.get(t, 0) / max(drawn[t], 1) for t in (0, 1)}
    return rows, drawn, rate[0] / (rate[1] or 1.0)


def telling_features(rows: DataFrame, drawn: dict[int, int]) -> list[str]:
    """The features that ``train`` keeps, counted in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            count = {0: Counter(), 1: Counter()}
            for t, y in zip(batch.column(0), batch.column(1).to_pylist()):
                count[y].update(text_features(t.as_py()))
            found = list(count[0].keys() | count[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *(pa.array([count[y][f] for f in found], pa.int64()) for y in (1, 0))], ["f", "n1", "n0"])

    counted = rows.select("text", "toxic").mapInArrow(run, "f string, n1 long, n0 long").groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where(F.col("n1") >= LEAST_DOCS)
    sure = F.exp(-SURE * F.sqrt(1 / F.col("n1") + 1 / (F.col("n0") + 0.5)))
    ratio = (F.col("n1") / F.lit(float(max(drawn[1], 1)))) / ((F.col("n0") + 0.5) / F.lit(float(max(drawn[0], 1)))) * sure
    best = counted.withColumn("r", ratio).where(F.col("r") >= LEAST_RATIO).orderBy((-F.col("n1") * F.log("r")), "f").limit(FEATURES)
    return [r["f"] for r in best.select("f").collect()]


def bags_of(rows: DataFrame, kept: list[str]) -> tuple[list[Counter[tuple[int, ...]]], list[int]]:
    """What ``fit`` needs of every row, made in tasks: its sentences' kept features, sentences alike as one; and its label."""
    shared = rows.sparkSession.sparkContext.broadcast({f: k for k, f in enumerate(kept)})  # at most FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in slices(batches, 1):
            bags = [sentence_features(t.as_py(), number) for t in batch.column(1)]
            sets = pa.array([list(map(list, b)) for b in bags], pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), sets, pa.array([list(b.values()) for b in bags], pa.list_(pa.int64()))], ["doc_id", "toxic", "sets", "times"])

    made = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic").mapInArrow(run, "doc_id long, toxic int, sets array<array<int>>, times array<long>")
    # Ordered here, for the same sums at every run.
    out = sorted((r["doc_id"], r["toxic"], sorted(zip(map(tuple, r["sets"]), r["times"]))) for r in made.toLocalIterator())
    return [Counter(dict(b)) for _, _, b in out], [y for _, y, _ in out]


def score(docs: DataFrame, model: SentenceModel) -> DataFrame:
    """doc_id, score, n_sentences, n_offending, worst_sentence, worst_score of every row, from its whole text.

    A text that is null or has no word has no sentences and scores the leak at no sentence. A sentence offends if its own score
    is at least the threshold. Repeated rows are scored alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words = WordFeatures(model.weights)
        for batch in slices(batches, 1):
            out = []
            for t in batch.column(1):
                found = model.sentence_scores(t.as_py() or "", words)
                worst = max(found, key=lambda s: s[1], default=(None, 0.0))
                out.append((model.document_score(found), len(found), sum(s >= THRESHOLD for _, s in found), *worst))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", "score", "n_sentences", "n_offending", "worst_sentence", "worst_score"])

    schema = "doc_id long, score double, n_sentences long, n_offending long, worst_sentence string, worst_score double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def fitted(docs: DataFrame, labels: DataFrame) -> SentenceModel:
    """The model for these tables; without labelled rows of both classes, one that rejects nothing."""
    rows, drawn, weight = training_sample(docs, labels)
    if not drawn[0] or not drawn[1]:
        return SentenceModel({}, -50.0)
    kept = telling_features(rows, drawn)
    return fit(kept, *bags_of(rows, kept), weight)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from labels of rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = score(docs, fitted(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic")))
    return found.select(
        "doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_sentences", "n_offending", "worst_sentence", "worst_score",
    )


def drop_toxic(docs: DataFrame, model: SentenceModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text scores below the threshold. A null or wordless text stays."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words = WordFeatures(model.weights)
        for batch in slices(batches, at):
            clean = [model.document_score(model.sentence_scores(t.as_py() or "", words)) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
