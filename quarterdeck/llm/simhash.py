"""SimHash near-duplicates by covering locality-sensitive hashing.

Each text has a 64-bit fingerprint. The bits are mapped at random, evenly, to the nonzero vectors of F2^(radius + 1);
table ``v`` keeps the bits whose vector has an odd inner product with ``v``. At most ``radius`` differing bits span a
proper subspace, so that some nonzero ``v`` is orthogonal to all of them and its table ignores them: every pair within
the radius collides in one of the ``2^(radius + 1) - 1`` tables, without exception.

Equal fingerprints are merged first. Within a bucket no list of all pairs is made: the links of a spanning forest are
enough. Buckets of more than ``CHUNK`` fingerprints are cut into chunks, and each pair of chunks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import broadcast_if_small, fresh_names, materialise, read_table

CHUNK = 2_048


def majority(h: np.ndarray) -> int:
    """64 bits; a bit is set if it is set in over half the hashes. No hashes: 0."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):  # blocks, so that a very long text needs no large table of bits
        ones += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 bits; a bit is set if it is set in over half the XXH64 (seed 42) of the word shingles. No words: 0."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= width:
        h = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
        starts = np.concatenate(([0], ends[:-width])).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())), np.uint64, len(starts))
    return majority(h)


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (the bits as a signed long) of every row; a null text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), width) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int = 3, bits: int = 64, seed: int = 11) -> list[int]:
    """One mask for each nonzero vector of F2^(radius + 1)."""
    nonzero = np.arange(1, 2 ** (radius + 1))
    vector = np.random.default_rng(seed).permutation(np.resize(nonzero, bits))
    return [sum(1 << i for i in range(bits) if bin(int(vector[i]) & int(v)).count("1") % 2) for v in nonzero]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fp: np.ndarray, rep: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (of reps) that connect what is within the radius, one for each row but the first of a component."""
    links, rest = [], np.arange(len(fp))
    while len(rest):
        todo, rest = rest[:1], rest[1:]
        while len(todo) and len(rest):
            near = np.bitwise_count(fp[rest][None, :] ^ fp[todo[:64]][:, None]) <= radius
            hit = near.any(0)
            links += zip(rep[todo[near.argmax(0)[hit]]].tolist(), rep[rest[hit]].tolist())
            todo, rest = np.concatenate([todo[64:], rest[hit]]), rest[~hit]
    return links


def _verify(radius: int):
    """Over rows sorted by bucket: the links of each bucket. A bucket here has at most two chunks."""

    def emit(bucket, fp, rep):
        cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(bucket)]))
        two = starts[ends - starts == 2]
        near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
        a, b = rep[near].tolist(), rep[near + 1].tolist()
        for s, e in zip(starts, ends):
            if e - s > 2:
                for x, y in _forest(fp[s:e], rep[s:e], radius):
                    a.append(x)
                    b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b).astype(np.int64)), pa.array(np.maximum(a, b).astype(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            if len(cols[0]):
                full = np.searchsorted(cols[0], cols[0][-1])  # the last bucket may go on in the next batch
                held = [c[full:] for c in cols]
                if full:
                    yield emit(cols[0][:full], cols[1][:full].view(np.uint64), cols[2][:full])
        if held is not None and len(held[0]):
            yield emit(held[0], held[1].view(np.uint64), held[2])

    return run


def near_links(distinct: DataFrame, radius: int = 3, chunk: int = CHUNK) -> DataFrame:
    """u < v, links between the reps of ``distinct`` (fp, rep: unique each) that connect all that lie within the radius."""
    masks = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for k, m in enumerate(covering_masks(radius))])
    keyed = distinct.select("fp", "rep", F.explode(masks).alias("m")).select("fp", "rep", F.xxhash64("m.t", "m.k").alias("bucket"))
    # Two keys of one hash only share a bucket: every pair in it is verified.
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / chunk)
    mine = F.pmod(F.xxhash64("fp", F.lit(3)), F.col("parts"))
    pairs = (
        keyed.join(shared, "bucket")
        .withColumn("parts", parts)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(F.when(F.col("parts") == 1, F.col("bucket")).otherwise(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other"))).alias("bucket"), "fp", "rep")
    )
    n = distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return pairs.repartition(int(n), "bucket").sortWithinPartitions("bucket").mapInArrow(_verify(radius), "u long, v long").distinct()


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each batch as stars around the smallest of what they connect."""
    for b in batches:
        up: dict[int, int] = {}

        def root(x):
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        stars = [(root(x), x) for x in list(up) if root(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([s[k] for s in stars], pa.int64()) for k in (0, 1)], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) of every node of the links u, v, by alternating large and small stars.

    Each round is a few joins and aggregates that Spark splits as it likes, written to the shared folder; rounds end
    when the links are stars, after a number of rounds that grows with the logarithm of a component's size.
    """
    links = materialise(links.select("u", "v").where("u <> v").mapInArrow(_contract, "u long, v long").distinct(), "links")
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b")).where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
        links = materialise(small, "links")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))
        seen = now


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id of every row: the smallest doc_id that links of at most ``radius`` differing bits reach.

    Rows of equal fingerprints, repeated rows and texts without words among them, are linked. A row whose doc_id is
    null stays alone (its component is null). An empty table gives an empty result.
    """
    own = materialise(fingerprints(docs, width, key, text), "fingerprints")
    distinct = materialise(own.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    parts = components(near_links(distinct, radius))
    to = distinct.join(parts, distinct.rep == parts.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return own.join(materialise(to, "classes"), "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; three-word shingles, links at 3 or fewer differing bits."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """``docs``, all columns, with one row of each component: the one of the smallest doc_id.

    Of several rows with that doc_id the one of the least text stays. Rows whose doc_id is null all stay.
    """
    return keep_first(docs, near_duplicates(docs, width, radius))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of ``found`` (doc_id, component_id), as ``keep_one`` says."""
    id_, place, spread = fresh_names(docs, "kept", "place", "spread")
    found = materialise(found.where("doc_id is not null"), "components")
    kept = materialise(found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(id_)).agg(F.count(F.lit(1)).alias("rows")), "kept")
    once, often = (broadcast_if_small(kept.where(c).select(id_)) for c in ("rows = 1", "rows > 1"))
    same = F.col("doc_id") == F.col(id_)
    out = docs.join(once, same, "left_semi")
    if kept.where("rows > 1").limit(1).count():
        plain = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() in ("string", "long", "integer") and f.name not in ("doc_id", "text")]
        first = [F.col("text").asc_nulls_last(), *plain]
        # The least row of each part of a repeated id's rows, then of all: no task has all rows of an id.
        several = docs.join(often, same, "left_semi").withColumn(spread, F.pmod(F.xxhash64("text"), F.lit(64)))
        for keys in (["doc_id", spread], ["doc_id"]):
            several = several.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*first))).where(F.col(place) == 1)
        out = out.unionByName(several.drop(place, spread))
    return out.unionByName(docs.where("doc_id is null"))
