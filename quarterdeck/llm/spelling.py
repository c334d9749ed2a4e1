"""Spelling variants: words one edit apart, by dense prefix-suffix tiling.

Two words, the longer of length M, are one insertion, deletion or replacement apart exactly if they differ and their common
prefix and common suffix together reach M - 1. The place of the edit, the length of the common prefix, lies in one of a few
windows of M; words whose edit lies in the window from ``lo`` to ``hi`` agree in their first ``lo`` and their last
``M - 1 - hi`` code points. Such words are a block: a word stands in the blocks of M = its length and of one more. Within
blocks, padded matrices of code points are compared pair by pair: the counts of equal leading and of equal trailing code
points decide. A pair is reported by the one block whose window holds its common prefix, so once only.

Blocks of more than ``TILE`` words are cut into chunks, and each pair of chunks is a task of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import broadcast_if_small, materialise, read_table, slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Places in a window, windows of a long word, and words of a chunk.
WINDOW, WINDOWS, TILE = 3, 8, 1_024
#: Code points up to which words are compared in matrices; distinct words that a task counts before it passes them on.
WIDE, HELD = 64, 300_000
#: Pairs of a batch of small blocks.
PAIRS = 100_000
LEAST_LENGTH, LEAST_COUNT, TIMES, DELETE = 7, 2, 10, 31


def words_of(doc_id: int | None, text: str | None, least: int = LEAST_LENGTH, delete: int = DELETE) -> Counter:
    """The counted words of a text, those shorter than ``least`` left out."""
    runs = Counter(RUN.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    out: Counter = Counter()
    start = b"" if doc_id is None else str(doc_id).encode()
    start = zlib.crc32(start + b":")
    for run, n in runs.items():
        if len(run) < least:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % delete == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        out[run] += n
    return out


def counted(docs: DataFrame) -> DataFrame:
    """word, n: the occurrences of every word of the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for part in slices([batch], 1):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    for word, n in words_of(doc_id, text.as_py()).items():
                        held[word] += n
                    if len(held) > HELD:
                        yield out()
        if held:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def blocks(words: DataFrame) -> DataFrame:
    """block, m, lo, hi, word, n: each word in its blocks. Two blocks of one hash only share tasks: their m, lo and hi differ."""
    size = F.char_length("word")
    each = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m"))
    width = F.greatest(F.lit(WINDOW), F.ceil(F.col("m") / WINDOWS).cast("int"))
    each = each.withColumn("width", width).withColumn("lo", F.explode(F.sequence(F.lit(0), F.col("m") - 1, F.col("width"))))
    each = each.withColumn("hi", F.least(F.col("lo") + F.col("width"), F.col("m")) - 1)
    tail = F.col("m") - 1 - F.col("hi")
    first, last = F.substring("word", 1, F.col("lo")), F.when(tail > 0, F.substring("word", F.char_length("word") - tail + 1, tail)).otherwise("")
    return each.select(F.xxhash64("m", "lo", first, last).alias("block"), "m", "lo", "hi", "word", "n")


def _common(a: str, b: str) -> tuple[int, int]:
    """The lengths of the common prefix and the common suffix."""
    n = min(len(a), len(b))
    p = next((k for k in range(n) if a[k] != b[k]), n)
    return p, next((k for k in range(n) if a[-1 - k] != b[-1 - k]), n)


class Words:
    """Rows of blocks as padded matrices: code points from the left, and from the right."""

    def __init__(self, words: list[str], m, lo, hi, mine):
        self.words, self.m, self.lo, self.hi, self.mine = words, m, lo, hi, mine
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        width = int(min(WIDE, self.size.max(initial=1)))
        short = self.size <= WIDE
        flat = np.frombuffer("".join(w if s else "" for w, s in zip(words, short)).encode("utf-32-le", "surrogatepass"), np.int32)
        row = np.repeat(np.arange(len(words)), np.where(short, self.size, 0))
        ends = np.cumsum(np.where(short, self.size, 0))
        at = np.arange(len(flat)) - (ends - np.where(short, self.size, 0))[row]
        # The two sides of a comparison are padded differently, so that padding is never equal.
        self.left = np.full((2, len(words), width), -1, np.int32)
        self.left[1] = -2
        self.right = self.left.copy()
        self.left[:, row, at] = flat
        self.right[:, row, self.size[row] - 1 - at] = flat

    def near(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs (of one block each) are one edit apart and belong to the block and, if it is cut, to this task."""
        m = self.m[x]
        fit = (np.maximum(self.size[x], self.size[y]) == m) & (self.m[y] == m) & (self.lo[x] == self.lo[y]) & ((self.mine[x] < 0) | (self.mine[x] != self.mine[y]))
        out = np.zeros(len(x), bool)
        at = np.flatnonzero(fit & (m <= WIDE))
        x_, y_ = x[at], y[at]
        width = self.left.shape[2]
        prefix = _leading(self.left[0, x_] == self.left[1, y_], width)
        suffix = _leading(self.right[0, x_] == self.right[1, y_], width)
        out[at] = (prefix + suffix >= m[at] - 1) & (prefix >= self.lo[x_]) & (prefix <= self.hi[x_])
        for k in np.flatnonzero(fit & (m > WIDE)).tolist():  # long words, of which there are few
            p, s = _common(self.words[x[k]], self.words[y[k]])
            out[k] = p + s >= m[k] - 1 and self.lo[x[k]] <= p <= self.hi[x[k]]
        return out & (x != y)


def _leading(same: np.ndarray, width: int) -> np.ndarray:
    return np.where(same.all(1), width, same.argmin(1)) if width else np.zeros(len(same), np.int64)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by block: both directions of every near pair. A block here has at most two chunks."""

    def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
        block = table["block"].to_numpy()
        of = Words(table["word"].to_pylist(), *(table[c].to_numpy().astype(np.int64) for c in ("m", "lo", "hi", "mine")))
        cut = np.flatnonzero(block[1:] != block[:-1]) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(block)]))
        several = np.flatnonzero(ends - starts > 1)
        # A row is paired with every later one of its block; rows are taken in runs of about PAIRS pairs.
        rows = np.concatenate([np.arange(s, e) for s, e in zip(starts[several], ends[several])]) if len(several) else np.zeros(0, np.int64)
        left = np.repeat(ends[several], (ends - starts)[several]) - rows - 1
        upto = np.cumsum(left)
        k = 0
        while k < len(rows):
            e = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + PAIRS, "right")))
            n = left[k:e]
            x = np.repeat(rows[k:e], n)
            y = x + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            near = of.near(x, y)
            x, y = x[near], y[near]
            if len(x):
                yield pa.RecordBatch.from_arrays([table["word"].take(a).combine_chunks() for a in (np.concatenate([x, y]), np.concatenate([y, x]))] + [table["n"].take(np.concatenate([y, x])).combine_chunks()], ["word", "other", "other_n"])
            k = e

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < 20_000:
            continue
        table = pa.Table.from_batches(held)
        block = table["block"].to_numpy()
        full = int(np.searchsorted(block, block[-1]))  # the last block may go on in the next batch
        if full:
            yield from emit(table.slice(0, full).combine_chunks())
        held = table.slice(full).combine_chunks().to_batches()
    if held:
        yield from emit(pa.Table.from_batches(held).combine_chunks())


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, other, other_n: both directions of every pair of distinct words (word, n) one edit apart."""
    each = blocks(words)
    crowded = broadcast_if_small(materialise(each.groupBy("block").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile), "crowded"))
    rows = each.join(crowded, "block", "left").withColumn("parts", F.coalesce(F.ceil(F.col("size") / tile), F.lit(1)))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("word", F.lit(3)), F.col("parts"))).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    # Pairs within a chunk are compared in the task of the chunk with itself alone.
    a, b = F.least("mine", "part"), F.greatest("mine", "part")
    task = F.when(F.col("parts") == 1, F.col("block")).otherwise(F.xxhash64("block", a, b))
    rows = rows.select(task.alias("block"), "m", "lo", "hi", "word", "n", F.when(a != b, F.col("mine")).otherwise(-1).alias("mine"))
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "block").sortWithinPartitions("block").mapInArrow(_compared, "word string, other string, other_n long")


def variants(words: DataFrame, times: int = TIMES, tile: int = TILE) -> DataFrame:
    """word, n, n_near, form, form_n, root of every row of ``words`` (word, n: distinct words and their counts).

    A word's form is its near word of largest count, ties to the first in code-point order, if that count is at least
    ``times`` the word's; else null. Its root is the last form that forms lead to, as counts grow at each step at least
    ``times``-fold in a few steps.
    """
    words = materialise(words, "words")
    near = near_words(words, tile).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    found = words.join(near, "word", "left")
    often = -F.col("best.minus") >= times * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(often, F.col("best.other")).alias("form"), F.when(often, -F.col("best.minus")).alias("form_n"))
    found = materialise(found, "forms")
    step = found.where("form is not null").select("word", F.col("form").alias("root"))
    # Each round doubles the steps taken, until no root has a form.
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = materialise(step.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if not step.where("moved").limit(1).count():
            break
        step = step.drop("moved")
    return found.join(step.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT, times: int = TIMES, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of ``docs`` (doc_id, text) that occur often enough.

    A null text has no words; a null doc_id counts as an empty one where letters are deleted by hash. Every row counts,
    repeated ones too. An empty table gives an empty result.
    """
    return variants(counted(docs).where(F.col("n") >= least_count), times, tile).select("word", "form", "root", "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their near words' number, their form and the root of their forms."""
    return spelling_variants(read_table(spark, sf_dir, "documents", "doc_id", "text"))
