"""Exact top-k inner products over an impact-ordered index, score at a time.

The vectors' integer components are dealt into blocks of bounded size. A block's postings (row, dimension) are cut into
segments by descending quantised impact. A group of queries takes the segments in that order, each for all its queries at
once. After a segment, a row's score differs from what it has gathered by no more than the quantisation error and the
product of the lengths of the query and of the row's unread postings. A query stops only when this proves that few rows
may still belong to its k best; those are rescored exactly. Otherwise it reads all segments, as it mostly must on dense
vectors, whose impacts differ little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import materialise, read_table

#: Components of a block, which bound its rows; queries that meet a block in one task; queries that go through the segments side by side.
CELLS, GROUP, ASIDE = 1 << 20, 65_536, 128
#: Levels of an impact; shares of the postings, by descending impact, at which segments end; rows that may be left when a query stops; queries that try each proof first.
LEVELS, SEGMENTS, FEW, TRIED = 64, (0.125, 0.25, 0.5, 1.0), 256, 4


class ImpactIndex:
    """Postings of one block: ``ids`` (n) and integer vectors ``x`` (n x dimensions)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], np.ascontiguousarray(x[order])
        size = np.abs(self.x)
        self.step = max(1, -(-int(size.max(initial=0)) // LEVELS))
        level = size // self.step
        impact = np.sign(self.x) * level
        held = np.bincount(level.ravel(), minlength=LEVELS + 1)[::-1].cumsum()  # postings of a level or higher ones
        ends = [LEVELS - int(np.searchsorted(held, share * held[-1])) for share in SEGMENTS] if level.size else [0]
        #: For each segment its impacts (others are 0), and the lengths of each row's postings in later ones.
        self.segments: list[tuple[np.ndarray, np.ndarray]] = []
        above = LEVELS + 1
        for least in sorted({max(e, 1) for e in ends[:-1]} | {0}, reverse=True):
            rest = np.where(level < least, level, 0).astype(np.float64) * self.step
            self.segments.append((np.where((level >= least) & (level < above), impact, 0).astype(np.float32), np.sqrt((rest * rest).sum(1))))
            above = least
        self.read = 0

    def search_all(self, w: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query of ``w`` (queries x dimensions) the ids and exact scores of the k best rows, best first, ties to the smaller id."""
        n, many = len(self.ids), len(w)
        total = np.abs(w).sum(1).astype(np.float64)
        most = total.max(initial=0.0) * LEVELS
        kind = np.float32 if most < 1 << 24 else np.float64  # sums of whole numbers below that are exact
        error = total * (self.step - 1) + (0 if most * self.step < 1 << 50 else total * LEVELS * self.step * 2.0**-40)
        length = np.sqrt((w.astype(np.float64) ** 2).sum(1))
        q, got = w.astype(kind), np.zeros((many, n), kind)
        out: list = [(self.ids[:0], self.ids[:0])] * many
        left = np.arange(many)
        for last, (impact, rest) in zip([False] * (len(self.segments) - 1) + [True], self.segments):
            if not len(left) or not n:
                break
            self.read += len(left)
            got[left] += q[left] @ impact.T.astype(kind)
            done = []
            for tried in [left] if last else [left[:TRIED], left[TRIED:]]:  # where none of the first few can stop, none of the others tries
                far = (length[tried][:, None] * rest[None, :] * (1 + 1e-6) if rest.any() else 0.0) + error[tried][:, None]
                score = got[tried].astype(np.float64) * self.step
                kth = np.partition(score - far, n - k, axis=1)[:, n - k] if n > k else np.full(len(tried), -np.inf)
                possible = score + far >= kth[:, None]
                stops = np.flatnonzero((possible.sum(1) <= max(FEW, 2 * k)) | last).tolist()
                for j in stops:
                    rows = np.flatnonzero(possible[j])
                    exact = self.x[rows] @ w[tried[j]]
                    best = np.lexsort((self.ids[rows], -exact))[:k]
                    out[tried[j]] = (self.ids[rows][best], exact[best])
                    done.append(tried[j])
                if not stops:
                    break
            left = np.setdiff1d(left, done)
        return out

    def search(self, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for one query."""
        return self.search_all(w[None, :], k)[0]


def _search(k: int):
    """Over rows sorted by block and kind (0: vector of the block, 1: query): each query's k best of the block."""

    def components(batch: pa.RecordBatch, dims: int) -> np.ndarray:
        lists = batch.column(4)
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        out = np.zeros((batch.num_rows, max(dims, int(size.max(initial=0)))), np.int64)
        out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
        return out

    def indexed(held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> tuple[pa.Array, np.ndarray, ImpactIndex]:
        """The block's ids and row keys by ascending id, null last, and the index of their places."""
        width = max(x.shape[1] for _, _, x in held)
        ids, rows = pa.concat_arrays([i for i, _, _ in held]), np.concatenate([r for _, r, _ in held])
        order = np.lexsort((rows, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
        x = np.concatenate([np.pad(x, ((0, 0), (0, width - x.shape[1]))) for _, _, x in held])[order]
        return ids.take(pa.array(order)), rows[order], ImpactIndex(np.arange(len(order)), x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, index = None, [], None
        for batch in batches:
            key = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            cut = np.flatnonzero(key[1:] != key[:-1]) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(key)]):
                part = batch.slice(a, b - a)
                if a == b:
                    continue
                if key[a] // 2 != block:
                    block, held, index = key[a] // 2, [], None
                if key[a] % 2 == 0:
                    held.append((part.column(2), part.column(3).to_numpy(), components(part, 0)))
                    continue
                if not held and index is None:
                    continue
                if index is None:
                    ids, rows, index = indexed(held)
                    plain, held = ids.fill_null(0).to_numpy(), []
                for c in range(0, part.num_rows, ASIDE):
                    some = part.slice(c, ASIDE)
                    own, row = some.column(2).fill_null(0).to_numpy(), some.column(3).to_numpy()
                    found = index.search_all(components(some, index.x.shape[1])[:, : index.x.shape[1]], k + 1)
                    keep = [np.flatnonzero((rows[at] != r) | (plain[at] != q))[:k] for q, r, (at, _) in zip(own, row, found)]
                    asked = pa.array(np.repeat(np.arange(len(own)), [len(x) for x in keep]))
                    places = pa.array(np.concatenate([at[x] for x, (at, _) in zip(keep, found)]))
                    scores = pa.array(np.concatenate([s[x] for x, (_, s) in zip(keep, found)]))
                    yield pa.RecordBatch.from_arrays([some.column(2).take(asked), some.column(3).take(asked), ids.take(places), scores], ["query_id", "query_row", "vec_id", "score"])

    return run


def integer_vectors(df: DataFrame, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, row, x: floor(scale * component) of every vector that is not null and has only finite components.

    Each row takes part by itself, those of one vec_id or none too. ``row`` tells the rows of a vec_id apart: it is a hash of
    the vec_id, the vector and its number among equal ones, so that it is the same at every run.
    """
    finite = ~F.exists(F.col(vector), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    x = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("long"))
    valid = df.where(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    alike = valid.select(F.col(key).cast("long").alias("vec_id"), x.alias("x")).groupBy("vec_id", "x").agg(F.count(F.lit(1)).alias("n"))
    each = alike.select("vec_id", "x", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    return each.select("vec_id", F.xxhash64("vec_id", "x", "copy").alias("row"), "x")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, block: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best vectors by integer inner product, its own row left out.

    Both inputs have vec_id, row, x, as ``integer_vectors`` gives them; equal vec_id and row are one row. Rows that share a
    vec_id are candidates and queries each by itself. Vectors of different lengths are compared over the shorter one's, so
    that empty ones have score 0 with all. Ties go to the smaller vec_id, null last. Every query meets every block; a task is one block of
    ``block`` rows (CELLS components, if not given) and one group of queries. Empty inputs give an empty result.
    """
    n, dims = vectors.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    blocks = max(1, -(-n // (block or max(1, CELLS // max(dims or 1, 1)))))
    groups = max(1, -(-queries.count() // GROUP))
    whole = lambda x: F.lit(x).cast("long")
    deal = lambda seed, many: F.pmod(F.xxhash64("row", F.lit(seed)), whole(many))
    every = lambda many: F.explode(F.sequence(whole(0), whole(many - 1)))
    own = vectors.select(deal(1, blocks).alias("b"), every(groups).alias("g"), whole(0).alias("kind"), "vec_id", "row", "x")
    asked = queries.select(every(blocks).alias("b"), deal(2, groups).alias("g"), whole(1).alias("kind"), "vec_id", "row", "x")
    tiles = own.unionByName(asked).select((F.col("b") * groups + F.col("g")).alias("tile"), "kind", "vec_id", "row", "x")
    dealt = tiles.repartitionById(blocks * groups, F.col("tile").cast("int")).sortWithinPartitions("tile", "kind")
    found = dealt.mapInArrow(_search(k), "query_id long, query_row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all embeddings for every embedding whose vec_id is divisible by 20."""
    vectors = materialise(integer_vectors(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")), "vectors")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


OP8_SQL = """
with e as materialized (select row_number() over () as r, vec_id, embedding from embeddings),
v as materialized (
  select r, vec_id, list_transform(embedding, lambda c: cast(floor(64.0 * cast(c as double)) as bigint)) as x
  from e
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
n as (select generate_series as d from generate_series(1, (select coalesce(max(len(x)), 0) from v))),
c as materialized (select v.r, v.vec_id, n.d, v.x[n.d] as x from v join n on n.d <= len(v.x)),
s as (select q.r as query, c.r, sum(q.x * c.x) as score from c as q join c on q.d = c.d where q.vec_id % 20 = 0 group by all),
p as (select q.r as query, q.vec_id as query_id, v.vec_id, cast(coalesce(s.score, 0) as bigint) as score
      from v as q join v on q.r <> v.r left join s on s.query = q.r and s.r = v.r where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query order by score desc, vec_id nulls last) as rank from p)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""
