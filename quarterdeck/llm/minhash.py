"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A set of word shingles has ``VALUES`` minwise hashes, of each of which 16 bits are kept. The signature distance is the
number of values that differ. Signatures are cut into ``CHUNKS`` chunks; of two signatures within ``RADIUS`` some chunk has
at most one differing value, by pigeonhole, as ``RADIUS < 2 * CHUNKS``. Every chunk is therefore keyed once for each of its
values, with that value left out: signatures whose chunks differ in that value alone share the key. So every pair within the
radius meets, without exception. Pairs that meet are filtered by the whole signature and confirmed on the whole sets.

A pair at a similarity of 0.85 lies beyond the radius of 23 of 64 values with a chance of 1e-5, a nearer pair more rarely.

Equal sets are merged first. No bucket makes all of its pairs: each member first meets the head of one bucket; what that
links is one class, and only pairs between different classes of a bucket are looked at afterwards, tile by tile: first by
signatures, then, for the rows that are within the radius of another, by their sets in the same task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import materialise, read_table, slices
from quarterdeck.llm.similar import shingles
from quarterdeck.llm.simhash import components

#: Words of a shingle; a link's least intersection in hundredths of the union.
WIDTH, LEAST = 3, 85
#: Values of a signature, chunks that it is cut into, and the signature distance up to which every pair is found.
VALUES, CHUNKS = 64, 12
RADIUS = 2 * CHUNKS - 1
#: Members of one side of a tile, and shingles of their sets, as far as single sets allow.
TILE, TILE_SHINGLES = 2_048, 2_000_000
_draw = np.random.default_rng(23)
XOR, ODD, SALT, SPOT = (_draw.integers(0, 1 << 64, VALUES, np.uint64) for _ in range(4))
ODD |= np.uint64(1)
#: The chunk of each value.
OF = np.arange(VALUES) * CHUNKS // VALUES
STARTS = np.searchsorted(OF, np.arange(CHUNKS))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on all."""
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> np.uint64(31))


def signature(own: np.ndarray) -> np.ndarray:
    """16 bits of each minwise hash of a set of 64-bit hashes that isn't empty."""
    least = np.full(VALUES, np.iinfo(np.uint64).max)
    for k in range(0, len(own), 512):  # blocks, so that a very long text needs no large table
        least = np.minimum(least, ((own[k : k + 512, None] ^ XOR) * ODD).min(0))
    return (least >> np.uint64(12)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each row and value: the key of the value's chunk without that value."""
    each = _mixed(signatures.astype(np.uint64) + SALT)
    return _mixed((np.add.reduceat(each, STARTS, axis=1)[:, OF] - each) ^ SPOT)


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, node (a hash of the set), n (its size), sig (null for an empty set) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            node, size, sig = [], [], []
            for t in part.column(1):  # one text's shingles at a time
                own = shingles(t.as_py(), width)
                node.append(xxhash.xxh64_intdigest(own.tobytes(), 7))
                size.append(len(own))
                sig.append(signature(own).tobytes() if len(own) else None)
            columns = pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(size, pa.int64()), pa.array(sig, pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "node", "n", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, node long, n long, sig binary")


def sets_of(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """node, own (the hashes of the shingles, sorted) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            sets = [shingles(t.as_py(), width) for t in part.column(0)]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "own"])

    return docs.select("text").mapInArrow(run, "node long, own array<long>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


def keyed(distinct: DataFrame) -> DataFrame:
    """bucket, spot (the value left out), node: a row for each value of each signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 2_000):
                part = batch.slice(k, 2_000)
                keys = chunk_keys(_matrix(part.column(1)))
                spot = np.tile(np.arange(VALUES, dtype=np.int32), len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(spot), pa.array(np.repeat(part.column(0).to_numpy(), VALUES))], ["bucket", "spot", "node"])

    return distinct.select("node", "sig").mapInArrow(run, "bucket long, spot int, node long")


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            near = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(1) <= RADIUS
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(near))


def within_radius(pairs: DataFrame, distinct: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs whose signatures are within the radius and whose sets' sizes allow a link."""
    u, v = (distinct.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"sig_{k}")) for k in "uv")
    sized = pairs.join(u, "u").join(v, "v").where(100 * F.least("n_u", "n_v") >= least * F.greatest("n_u", "n_v"))
    return sized.select("u", "v", "sig_u", "sig_v").mapInArrow(_within, "u long, v long")


def confirmed(pairs: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs of nodes whose whole sets (node, own) are similar enough."""
    u, v = (sets.select(F.col("node").alias(k), F.col("own").alias(f"own_{k}")) for k in "uv")
    common = F.size(F.array_intersect("own_u", "own_v"))
    return pairs.join(u, "u").join(v, "v").where(100 * common >= least * (F.size("own_u") + F.size("own_v") - common)).select("u", "v")


class Tile:
    """The rows of one tile: nodes with their classes, signatures and, to confirm, sets."""

    def __init__(self, spot, node, component, left, right, sig, sets=None):
        self.node, self.component, self.sets = node, component, sets
        self.a, self.b = np.flatnonzero(left), np.flatnonzero(right)
        self.spot, self.sig = spot, sig

    def close(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Left and right rows within the radius, of different classes, that are to be compared here; a block at a time.

        A pair meets at up to ``VALUES`` spots. It is compared in the first chunk with at most one differing value: at that
        value's spot, or at the chunk's first if none differs.
        """
        for spot in np.unique(self.spot).tolist():
            a, b = (x[self.spot[x] == spot] for x in (self.a, self.b))
            step = max(1, (1 << 21) // max(1, len(a)))
            for k in range(0, len(b), step):
                c = b[k : k + step]
                errors = np.zeros((len(c), len(a)), np.uint8)
                for v in range(STARTS[1]):
                    errors += self.sig[c, v][:, None] != self.sig[a, v]
                y, x = np.nonzero((self.component[c][:, None] != self.component[a]) & (errors > 1 if OF[spot] else errors <= 1))
                x, y = a[x], c[y]
                for j in range(1, OF[spot]):
                    at = slice(STARTS[j], STARTS[j + 1])
                    later = (self.sig[x, at] != self.sig[y, at]).sum(1) > 1
                    x, y = x[later], y[later]
                if spot != STARTS[OF[spot]]:
                    differ = self.sig[x, spot] != self.sig[y, spot]
                    x, y = x[differ], y[differ]
                near = [(self.sig[x[j : j + 65_536]] != self.sig[y[j : j + 65_536]]).sum(1) <= RADIUS for j in range(0, len(x), 65_536)]
                near = np.concatenate(near) if near else np.zeros(0, bool)
                yield x[near], y[near]

    def taking_part(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether each row is the left, and the right, of any close pair."""
        out = np.zeros((2, len(self.node)), bool)
        for x, y in self.close():
            out[0, x] = out[1, y] = True
        return out[0], out[1]

    def links(self, least: int) -> Iterator[tuple[int, int]]:
        """Links that connect all close pairs whose whole sets are similar enough: none between what is connected already."""
        size = np.fromiter(map(len, self.sets), np.int64, len(self.sets))
        shingle, number = np.unique(np.concatenate(self.sets), return_inverse=True)
        ends = np.cumsum(size)
        up = {c: c for c in self.component.tolist()}

        def root(c):
            while up[c] != c:
                up[c] = c = up[up[c]]
            return c

        mark = np.zeros(len(shingle), bool)
        for xs, ys in self.close():
            for y, mine in zip(*_grouped(ys, xs)):
                own, top = number[ends[y] - size[y] : ends[y]], root(self.component[y])
                mine = np.array([x for x in mine.tolist() if root(self.component[x]) != top], np.int64)
                if not len(mine):
                    continue
                mark[own] = True
                n = size[mine]
                starts = np.cumsum(n) - n
                common = np.add.reduceat(mark[number[np.repeat(ends[mine] - n - starts, n) + np.arange(n.sum())]], starts, dtype=np.int64)
                mark[own] = False
                for x in mine[100 * common >= least * (n + size[y] - common)].tolist():
                    if (other := root(self.component[x])) != root(self.component[y]):
                        up[other] = root(self.component[y])
                        yield int(self.node[x]), int(self.node[y])


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The distinct keys, and the values of each."""
    order = np.argsort(keys, kind="stable")
    each, at = np.unique(keys[order], return_index=True)
    return each.tolist(), np.split(values[order], at[1:]) if len(each) else []


def _by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Tile]]:
    """The tiles of rows that are sorted by them; a tile may go on in the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = batch.column(0).to_numpy()
        at = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), len(tile)]
        for s, e in zip(at, at[1:]):
            if held and held[0].column(0)[0].as_py() != tile[s]:
                yield _tile(held)
                held = []
            held.append(batch.slice(s, e - s))
    if held:
        yield _tile(held)


def _tile(batches: list[pa.RecordBatch]) -> tuple[int, Tile]:
    table = pa.Table.from_batches(batches).combine_chunks()
    plain = [table[c].to_numpy() for c in ("spot", "node", "component", "left", "right")]
    sets = [x.values.to_numpy() for x in table["own"]] if "own" in table.column_names else None
    return table["tile"][0].as_py(), Tile(*plain, _matrix(table["sig"]), sets)


def _taking_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, tile in _by_tile(batches):
        left, right = tile.taking_part()
        at = np.flatnonzero(left | right)
        if len(at):
            columns = np.full(len(at), number), tile.spot[at], tile.node[at], tile.component[at], left[at], right[at]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tile", "spot", "node", "component", "left", "right"])


def _linked(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tile in _by_tile(batches):
            found = np.sort(np.array(list(tile.links(least)), np.int64).reshape(-1, 2), axis=1)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])

    return run


def in_tiles(members: DataFrame, classes: DataFrame, distinct: DataFrame, tile: int = TILE, shingles: int = TILE_SHINGLES) -> DataFrame:
    """tile, spot, node, component, left, right: rows of ``members`` (bucket, spot, node) with a partner of another class in reach.

    The members of a bucket that aren't of its first member's class (the minor ones) are cut into chunks, all members too,
    and each pair of a chunk of minor ones (right) and one of all (left) is a tile of its own.
    """
    own = members.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = own.groupBy("bucket").agg(F.min_by("component", "node").alias("major"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    live = own.join(open_.select("bucket", "major"), "bucket").withColumn("minor", F.col("component") != F.col("major")).drop("major")
    live = materialise(live.join(distinct.select("node", "n"), "node"), "live")
    parts = lambda count, size: F.ceil(F.greatest(count / tile, size / shingles))
    sizes = live.groupBy("bucket").agg(parts(F.count(F.lit(1)), F.sum("n")).alias("all_parts"), parts(F.count_if("minor"), F.sum(F.when(F.col("minor"), F.col("n")))).alias("minor_parts"))
    dealt = live.join(sizes, "bucket")
    part = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    same = ["bucket", "spot", "node", "component"]
    lefts = dealt.select(*same, F.lit(True).alias("left"), F.lit(False).alias("right"), part("all_parts", 3).alias("i"), upto("minor_parts").alias("j"))
    rights = dealt.where("minor").select(*same, F.lit(False).alias("left"), F.lit(True).alias("right"), upto("all_parts").alias("i"), part("minor_parts", 5).alias("j"))
    rows = lefts.unionByName(rights).select(F.xxhash64("bucket", "i", "j").alias("tile"), *same[1:], "left", "right")
    columns = "tile long, spot int, node long, component long, left boolean, right boolean"
    return sorted_by_tile(rows.join(distinct.select("node", "sig"), "node")).mapInArrow(_taking_part, columns)


def sorted_by_tile(rows: DataFrame) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["tile", "spot", "node", "component", "left", "right", "sig", *(c for c in rows.columns if c == "own")]
    return rows.select(*columns).repartition(n, "tile").sortWithinPartitions("tile")


def near_sets(docs: DataFrame, width: int = WIDTH, least: int = LEAST, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row: the smallest doc_id that links of similar sets reach.

    Rows of equal sets are linked; sets are told apart by 64-bit hashes, of the shingles and of the set. A row without words
    is linked with nothing: its component is its own doc_id. A row whose doc_id is null stays alone (its component is null)
    and is kept. An empty table gives an empty result.
    """
    own = materialise(sketches(docs, width), "sketches")
    distinct = materialise(own.where("doc_id is not null and n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "distinct")
    keys = keyed(distinct)
    buckets = materialise(keys.groupBy("bucket").agg(F.min("node").alias("u"), F.max("node").alias("v"), F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    members = materialise(keys.join(buckets.where("size > 2").select("bucket", F.col("u").alias("head")), "bucket"), "members")
    stars = members.groupBy("node").agg(F.min("head").alias("u")).select("u", F.col("node").alias("v")).where("u <> v")
    first = materialise(within_radius(buckets.where("size = 2").select("u", "v").unionByName(stars).distinct(), distinct, least), "pairs")

    def sets(some: DataFrame) -> DataFrame:
        nodes = materialise(some.distinct().join(distinct.select("node", "first_id"), "node"), "nodes")
        texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text").join(nodes.select("first_id").distinct(), "first_id", "left_semi")
        return materialise(sets_of(texts, width).join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")

    links = materialise(confirmed(first, sets(first.select(F.explode(F.array("u", "v")).alias("node"))), least), "confirmed")
    classes = materialise(components(links), "classes")
    # The smallest node of a class is no row of its components.
    classes = classes.unionByName(classes.select(F.col("component").alias("node"), "component").distinct())
    rest = materialise(in_tiles(members.select("bucket", "spot", "node"), classes, distinct, tile), "tiles")
    held = rest.join(sets(rest.select("node")), "node").join(distinct.select("node", "sig"), "node")
    links = links.unionByName(sorted_by_tile(held).mapInArrow(_linked(least), "u long, v long"))
    near = materialise(components(links), "near")
    labelled = materialise(distinct.select("node", "first_id").join(near, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled")
    named = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    to = materialise(labelled.join(named, "component").select("node", "component_id"), "named")
    found = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return own.join(to, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), found).alias("component_id"), F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept")
    )


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document; three-word shingles, links at a similarity of 0.85 or more."""
    return near_sets(read_table(spark, sf_dir, "documents", "doc_id", "text"))
