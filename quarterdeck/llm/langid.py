"""Language identification by a byte convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over a fixed-length window and classified by
softmax. The network is trained in numpy on windows of a bounded sample of labelled rows; every window of every whole
text is then classified, in batches, and a text takes the mean of its windows' log probabilities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import among_least, broadcast_if_small, learnable, materialise, read_table

#: Window length in bytes; embedding size; filter widths and filters of each.
WINDOW, EMBED, WIDTHS, FILTERS = 128, 6, (2, 3, 4), 8
#: The training sample: texts of each language, and windows of each text, at most.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 400, 10
#: Share of the training windows cut short at random, as short texts and last windows are.
SHORT = 0.4
LETTER = regex.compile(r"\p{L}")
#: Windows classified at a time.
BATCH = 2_048


def windows_of(data: bytes, length: int = WINDOW) -> np.ndarray:
    """The bytes as rows of one length, the last one padded with zeros; one row of zeros for no bytes."""
    n = max(1, -(-len(data) // length))
    out = np.zeros(n * length, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, length)


@dataclass
class ByteCNN:
    """embed (256 x e), filters (widest * e x all filters; narrow ones are zero at their end), dense layer."""

    langs: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def columns(self, x: np.ndarray) -> np.ndarray:
        """The embedded bytes of every position and the next ones, side by side."""
        widest = max(WIDTHS)
        e = self.embed[np.pad(x, ((0, 0), (0, widest - 1)))]
        n, length, size = x.shape[0], x.shape[1], self.embed.shape[1]
        view = np.lib.stride_tricks.as_strided(e, (n, length, widest * size), (e.strides[0], e.strides[1], e.strides[2]))
        return view.reshape(n * length, widest * size)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cols = self.columns(x)
        h = (cols @ self.filters).reshape(x.shape[0], x.shape[1], -1)
        return np.maximum(h.max(1) + self.bias, 0), h, cols

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.langs)), np.float64)
        for k in range(0, len(x), BATCH):
            z = self.pooled(x[k : k + BATCH])[0] @ self.dense + self.offset
            z = z - z.max(1, keepdims=True)
            out[k : k + BATCH] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out


def drawn_windows(text: str) -> np.ndarray:
    """At most SAMPLE_WINDOWS windows, drawn from the whole text by its own bytes, some of them cut short."""
    data = text.encode("utf-8", "replace")
    rng = np.random.default_rng(zlib.crc32(data))
    w = windows_of(data)
    w = w[np.sort(rng.permutation(len(w))[:SAMPLE_WINDOWS])].copy()
    for r in np.flatnonzero(rng.random(len(w)) < SHORT):
        w[r, int(rng.integers(4, WINDOW)) :] = 0
    return w


def train(texts: list[str], langs: list[str], **settings) -> ByteCNN:
    """Fit the network on windows drawn from the texts."""
    return fit([drawn_windows(t) for t in texts], langs, **settings)


def fit(xs: list[np.ndarray], langs: list[str], epochs: int = 8, seed: int = 5, rate: float = 0.01) -> ByteCNN:
    """Fit the network on each text's windows by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    ys = [names.index(lang) for w, lang in zip(xs, langs) for _ in range(len(w))]
    x, y = np.concatenate(xs), np.array(ys)
    widest, many = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.concatenate([np.repeat((np.arange(widest) < w).astype(np.float32), EMBED)[:, None].repeat(FILTERS, 1) for w in WIDTHS], 1)
    net = ByteCNN(
        names, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), (rng.normal(0, 0.3, (widest * EMBED, many)) * mask).astype(np.float32),
        np.zeros(many, np.float32), rng.normal(0, 0.3, (many, len(names))).astype(np.float32), np.zeros(len(names), np.float32),
    )
    params = [net.embed, net.filters, net.bias, net.dense, net.offset]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), 64):
            at = order[k : k + 64]
            xb, yb, n = x[at], y[at], len(at)
            p, h, cols = net.pooled(xb)
            z = p @ net.dense + net.offset
            g = np.exp(z - z.max(1, keepdims=True))
            g /= g.sum(1, keepdims=True)
            g[np.arange(n), yb] -= 1
            g /= n
            gp = (g @ net.dense.T) * (p > 0)
            best = h.argmax(1)  # the position that each pooled filter saw
            rows = np.arange(n)[:, None] * WINDOW + best
            seen = cols[rows.ravel()].reshape(n, many, -1)
            gf = np.einsum("nf,nfc->cf", gp, seen) * mask
            back = (gp[:, :, None] * net.filters.T[None]).reshape(n, many, widest, EMBED)
            ge = np.zeros_like(net.embed)
            padded = np.pad(xb, ((0, 0), (0, widest - 1)))
            for o in range(widest):
                np.add.at(ge, padded[np.arange(n)[:, None], best + o].ravel(), back[:, :, o].reshape(-1, EMBED))
            step += 1
            for i, d in enumerate((ge, gf, gp.sum(0), p.T @ g, g.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                params[i] -= (rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def training_sample(docs: DataFrame, per_lang: int = SAMPLE_TEXTS) -> tuple[list[np.ndarray], list[str]]:
    """Windows of at most ``per_lang`` texts of each language, in order of a hash of the id, from rows that may be learned from.

    Only ids whose hash is low enough for a few times that number are ranked, so that no task ranks a whole language.
    Tasks draw the windows, from whole texts; the driver gets SAMPLE_WINDOWS of each.
    """
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    may = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & learnable(F.col("doc_id"))).select("doc_id", "lang", F.xxhash64("doc_id").alias("_h"))
    counts = materialise(may.groupBy("lang").count(), "languages")
    rows = may.join(broadcast_if_small(counts), "lang").where(among_least(F.col("_h"), per_lang, F.col("count"))).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_lang).select("doc_id", "lang", "_n")
    chosen = materialise(rows, "chosen")
    found = docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text").join(broadcast_if_small(chosen), ["doc_id", "lang"]).select("lang", "_n", "text")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [drawn_windows(t.as_py()).tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.binary())], ["lang", "n", "windows"])

    got = found.mapInArrow(draw, "lang string, n int, windows binary").orderBy("lang", "n", "windows").collect()
    return [np.frombuffer(r["windows"], np.uint8).reshape(-1, WINDOW) for r in got], [r["lang"] for r in got]


def identify(docs: DataFrame, net: ByteCNN) -> DataFrame:
    """doc_id, lang_pred, score for every row, from every window of its whole text.

    A text that is null or has no letter is ``und`` with score 0. Repeated rows are scored alike.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(net)  # a few KB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            pred, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            rows, parts, held = [], [], 0

            def flush():
                lp = model.log_probs(np.concatenate(parts))
                at = np.cumsum([0, *map(len, parts)])
                sums = np.add.reduceat(lp, at[:-1], axis=0)
                mean = sums / np.diff(at)[:, None]
                best = mean.argmax(1)
                p = np.exp(mean - mean.max(1, keepdims=True))
                p = p.max(1) / p.sum(1)
                for r, b, s in zip(rows, best.tolist(), p.tolist()):
                    pred[r], score[r] = model.langs[b], min(1.0, max(0.0, s))

            for r, t in enumerate(batch.column(1)):
                text = t.as_py()
                if not text or not LETTER.search(text):
                    continue
                rows.append(r)
                parts.append(windows_of(text.encode("utf-8", "replace")))
                held += len(parts[-1])
                if held >= 4 * BATCH:
                    flush()
                    rows, parts, held = [], [], 0
            if rows:
                flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned from labelled rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    windows, langs = training_sample(docs)
    if not windows:
        return docs.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    found = identify(docs, fit(windows, langs))
    return found.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")
