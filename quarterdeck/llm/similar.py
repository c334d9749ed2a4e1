"""Near copies by the Jaccard similarity of five-word shingles, for the pipeline.

Candidates are found by SimHash: all pairs whose 64-bit fingerprints of the shingles differ in at most ``RADIUS`` bits. Those
are the nearest copies; most pairs about the least similarity, 0.8, differ in more bits, so that candidates also share one of
``BANDS`` keys of ``ROWS`` minwise hashes each: such a pair does with a chance of 0.999, a nearer one more surely. What
candidates connect is then compared by the shingles themselves: only pairs that are that similar are linked. Equal sets of shingles are merged first. Groups of much text are cut into chunks,
and each pair of chunks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import materialise, slices
from quarterdeck.llm.simhash import components, keep_first, majority, near_links

#: Words of a shingle and the least similarity of a near copy.
WIDTH, LEAST = 5, 0.8
RADIUS = 3
BANDS, ROWS = 24, 6
#: Shingles of a chunk, as far as single texts allow.
CHUNK_SHINGLES = 200_000
_draw = np.random.default_rng(5)
XOR, ODD = (_draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64) for _ in range(2))
ODD |= np.uint64(1)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct XXH64 of the word shingles; of all words if they are fewer; empty without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    stops = (ends[width - 1 :] - 1).tolist() if len(tokens) >= width else [len(joined)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(stops)))


def band_keys(own: np.ndarray) -> list[int]:
    """The hash of each band's least values; none of an empty set."""
    if not len(own):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for k in range(0, len(own), 512):  # blocks, so that a very long text needs no large table
        least = np.minimum(least, ((own[k : k + 512, None] ^ XOR) * ODD).min(0))
    return [xxhash.xxh64_intdigest(row.tobytes(), b) for b, row in enumerate(least.reshape(BANDS, ROWS))]


def _digest(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), 7)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, same (a hash of the set of shingles), n (its size), fp (its fingerprint), bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            same, size, prints, bands = [], [], [], []
            for t in part.column(1):  # one text's shingles at a time
                own = shingles(t.as_py())
                same.append(_digest(own))
                size.append(len(own))
                prints.append(majority(own))
                bands.append(np.array(band_keys(own), np.uint64).view(np.int64))
            columns = pa.array(np.array(same, np.uint64).view(np.int64)), pa.array(size, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(bands, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "same", "n", "fp", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, same long, n long, fp long, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, same, own (the shingles) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            sets = [shingles(t.as_py()) for t in part.column(1)]
            same = np.array([_digest(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(same), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "same", "own"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, same long, own array<long>")


def similar_links(rep: np.ndarray, sets: list[np.ndarray], least: float = LEAST) -> list[tuple[int, int]]:
    """Links (of reps) that connect all pairs of sets at least that similar."""
    sizes = np.array([len(s) for s in sets])
    links, rest = [], np.arange(len(rep))
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            flat = np.concatenate([sets[i] for i in rest])
            at = np.minimum(np.searchsorted(sets[x], flat), sizes[x] - 1)
            common = np.add.reduceat((sets[x][at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum(sizes[rest])[:-1])))
            hit = common >= least * (sizes[x] + sizes[rest] - common)
            links += [(int(rep[x]), int(rep[i])) for i in rest[hit]]
            todo += rest[hit].tolist()
            rest = rest[~hit]
    return links


def _verify(table: pa.Table) -> pa.Table:
    rep = table["rep"].to_numpy()
    sets = [s.values.to_numpy().view(np.uint64) for s in table["own"]]
    links = [(min(x), max(x)) for x in similar_links(rep, sets) if x[0] != x[1]]
    return pa.table({k: pa.array([x[c] for x in links], pa.int64()) for c, k in enumerate(("u", "v"))})


def candidates(distinct: DataFrame) -> DataFrame:
    """u, v: links between the reps of ``distinct`` (rep, n, fp, bands) that connect all candidates. Empty sets have none."""
    prints = materialise(distinct.where("n > 0").groupBy("fp").agg(F.min("rep").alias("head")), "prints")
    equal = distinct.where("n > 0").join(prints, "fp").where("head <> rep").select(F.col("head").alias("u"), F.col("rep").alias("v"))
    near = near_links(prints.select("fp", F.col("head").alias("rep")), RADIUS)
    keyed = distinct.select("rep", F.posexplode("bands").alias("band", "key"))
    heads = keyed.groupBy("band", "key").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return near.unionByName(equal).unionByName(keyed.join(heads, ["band", "key"]).select(F.col("head").alias("u"), F.col("rep").alias("v")))


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, component_id of every row: the smallest doc_id that links of similar texts reach.

    Rows of equal sets of shingles, texts without words among them, are linked. A row whose doc_id is null stays alone
    (its component is null). An empty table gives an empty result.
    """
    own = materialise(sketches(docs), "sketches")
    distinct = materialise(own.where("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "distinct")
    loose = components(candidates(distinct))
    loose = loose.unionByName(loose.select(F.col("component").alias("node"), "component").distinct())  # the smallest nodes too
    held = materialise(distinct.drop("fp", "bands").join(loose, distinct.rep == loose.node).select("same", "rep", "n", "component"), "held")
    parts = held.groupBy("component").agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).alias("parts"))
    dealt = held.join(parts, "component").withColumn("mine", F.pmod(F.xxhash64("same", F.lit(3)), F.col("parts")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    group = dealt.select("same", "rep", F.xxhash64("component", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(held.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = shingle_sets(texts).join(held.select("same", F.col("rep").alias("doc_id")), ["same", "doc_id"], "left_semi").dropDuplicates(["same", "doc_id"])
    rows = group.join(sets.select("same", "own"), "same").select("group", "rep", "own")
    links = rows.groupBy("group").applyInArrow(_verify, "u long, v long")
    near = components(links)
    to = distinct.join(near, distinct.rep == near.node, "left").select("same", F.coalesce("component", "rep").alias("component_id"))
    return own.join(materialise(to, "classes"), "same", "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with one row of each group of near copies: the one of the smallest doc_id.

    Of several rows with that doc_id the one of the least text stays. Rows whose doc_id is null all stay.
    """
    return keep_first(docs, near_copies(docs))
