"""Removal of repeated substrings by a suffix sort with hashed comparisons.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document of a smaller id, or
earlier in the same one. The steps:

1. Anchors. Every window of LENGTH bytes picks the byte run of length ``GRAM`` in it with the least hash, so that equal
   windows pick the same run at the same place; about one position in 35 is an anchor. The anchor's context is all that
   windows with this anchor can reach. Texts are hashed some hundred KB at a time; each block of texts then merges its
   contexts that are equal byte by byte, so that one of each goes on, and a task those that it has met in earlier blocks.
2. One shuffle by anchor hash, of narrow rows: anchors that occur once are done with.
3. Suffix sort. The contexts of all other anchors are fetched from the texts and sorted by what follows the anchor: a
   mergesort whose comparisons find the common extension of two suffixes by binary search over prefix polynomial hashes,
   so in a logarithmic number of steps; neighbours are checked byte by byte, and a collision sends the block to a plain
   sort. Runs of neighbours with a common extension, split by the hash of what precedes the anchor, are the equal windows.
   A group of more rows than a task should hold goes through the sort in chunks, of which only distinct contexts are kept.
4. An anchor with very many different contexts (``HOT`` in one block, or ``LARGE`` in all) is not one group: its contexts
   are sorted where they are, some thousands at a time, and the windows that are first there, all their bytes, are
   grouped with Spark's partial aggregation.
5. The covered intervals are merged for each document and its bytes are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import materialise, read_table

LENGTH, GRAM = 100, 32
#: How far a context reaches on either side of the anchor.
REACH = LENGTH - GRAM
#: Bytes hashed at a time; bytes of a block; distinct contexts of an anchor in one block, or in all, from which its windows are grouped one by one.
STEP, BLOCK, HOT, LARGE = 128 << 10, 2 << 20, 64, 20_000
#: Frequent contexts that a task remembers from its earlier blocks; contexts sorted at a time; bytes of a batch of results.
REMEMBERED, CHUNK, EMIT = 30_000, 6_000, 4 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
U = np.uint64
_powers: dict[int, np.ndarray] = {}


def powers(of: int, n: int) -> np.ndarray:
    """The powers 0 .. n - 1 modulo 2^64."""
    if len(_powers.get(of, ())) < n:
        _powers[of] = np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(n - 1, of, U)]))
    return _powers[of][:n]


class PrefixHashes:
    """Polynomial hashes of all substrings of ``data``; equal strings have equal hashes wherever they are.

    ``place`` is each byte's place in its own piece, where data is made of pieces and no substring crosses them.
    """

    def __init__(self, data: np.ndarray, place: np.ndarray | None = None):
        n = len(data)
        self.place = np.arange(n + 1) if place is None else place
        most = int(self.place.max(initial=0)) + 1
        self.sums = np.zeros(n + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(INVERSE, most)[self.place[:n]], out=self.sums[1:])
        self.shift = powers(BASE, most)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.shift[self.place[start]]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


def anchors(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions of the windows that start where ``valid`` holds, and their hashes."""
    n = len(data)
    if n < LENGTH or not valid.any():
        return np.zeros(0, np.int64), np.zeros(0, U)
    h = mixed(PrefixHashes(data).of(np.arange(n - GRAM + 1), GRAM))
    low = U((1 << 25) - 1)  # blocks are shorter than that
    least, width, span = (h & ~low) | np.arange(len(h), dtype=U), 1, REACH + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    at = np.unique(least[valid[: len(least)]] & low).astype(np.int64)
    return at, h[at]


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of intervals, for each row its maximal runs; intervals that touch are one run."""
    if not len(row):
        return row, start, end
    order = np.lexsort([start, row])
    row, start, end = row[order], start[order], end[order]
    # running maximum of the end within a row: rows are shifted apart
    apart = int(end.max()) + 2
    base = (np.cumsum(np.concatenate(([0], row[1:] != row[:-1])))).astype(np.int64) * apart
    reach = np.maximum.accumulate(end + base)
    new = np.concatenate(([True], (start + base)[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return row[first], start[first], np.maximum.reduceat(end, first)


# Kinds of rows: a covered interval [a, b); the first occurrence of a context; the same of a hot anchor; a mark that an anchor is hot.
COVER, FIRST, HOT_FIRST, MARK = 0, 1, 2, 3
ROWS = "part long, h long, c long, doc long, twin long, v long"


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, not copied, and where each value starts in them (and the last one ends)."""
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), off


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a : a + size] is data[b : b + size], for each row."""
    out = np.zeros(len(a), bool)
    for k in range(0, len(a), 4096):
        n = size[k : k + 4096, None]
        step = np.arange(int(n.max()))[None, :]
        inside = step < n
        last = np.maximum(n - 1, 0)
        step = np.minimum(step, last)
        out[k : k + 4096] = ((data[a[k : k + 4096, None] + step] == data[b[k : k + 4096, None] + step]) | ~inside).all(1)
    return out


class Seen:
    """Frequent contexts of a task's earlier blocks: the earliest place of each, and its bytes. Bounded, so that it may forget."""

    def __init__(self):
        self.known: dict[int, tuple[int, int, bytes]] = {}

    def later(self, key: np.ndarray, doc: np.ndarray, pos: np.ndarray, data, start: np.ndarray, end: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        """Which contexts have been met at an earlier place; the frequent ones of this block are remembered."""
        out = np.zeros(len(key), bool)
        keys = key.tolist()
        for k in [k for k, x in enumerate(keys) if x in self.known]:
            d, p, own = self.known[keys[k]]
            if own == data[start[k] : end[k]]:
                here = (int(doc[k]), int(pos[k]))
                out[k] = here > (d, p)
                if here < (d, p):
                    self.known[keys[k]] = (*here, own)
        for k in np.flatnonzero(frequent).tolist():
            if keys[k] not in self.known:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[keys[k]] = (int(doc[k]), int(pos[k]), bytes(data[start[k] : end[k]]))
        return out


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From doc, twin, text as bytes: the covers, first contexts and hot anchors of each block."""
    seen = Seen()
    for batch in batches:
        doc, twin = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        data, off = flat_bytes(batch.column(2))
        for lo in range(int(off[0]), int(off[-1]), BLOCK):
            yield _block_rows(data, off, lo, min(lo + BLOCK, int(off[-1])), doc, twin, seen)


def _block_anchors(data: np.ndarray, off: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``data`` and hashes of the anchors of all windows that start from lo to hi and stay within their text."""
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for a in range(lo, hi, STEP):
        b = min(a + STEP, hi)
        first, last = np.searchsorted(off, a, "right") - 1, np.searchsorted(off, b, "left")
        ends, starts = off[first + 1 : last + 1], off[first:last]  # texts that have bytes from a to b
        out = np.zeros(b - a + 1, np.int32)  # where windows would cross the end of their text
        np.add.at(out, np.clip(np.maximum(ends - LENGTH + 1, starts), a, b) - a, 1)
        np.add.at(out, np.clip(ends, a, b) - a, -1)
        at, h = anchors(data[a : min(b + LENGTH - 1, int(off[-1]))], np.cumsum(out[:-1]) == 0)
        places.append(at + a)
        hashes.append(h)
    at, index = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[index]


def _block_rows(data: np.ndarray, off: np.ndarray, lo: int, hi: int, doc: np.ndarray, twin: np.ndarray, seen: Seen) -> pa.RecordBatch:
    at, h = _block_anchors(data, off, lo, hi)
    row = np.searchsorted(off, at, "right") - 1
    pos = at - off[row]
    left, right = np.minimum(REACH, pos), np.minimum(REACH, off[row + 1] - at - GRAM)
    digest, view = xxhash.xxh3_64_intdigest, memoryview(data)
    c = np.fromiter((digest(view[s:e], k) for s, e, k in zip((at - left).tolist(), (at + GRAM + right).tolist(), left.tolist())), U, len(at))
    h, c = h.view(np.int64), c.view(np.int64)
    order = np.lexsort([pos, doc[row], c, h])
    at, h, c, row, pos, left, right = (x[order] for x in (at, h, c, row, pos, left, right))
    n = len(h)
    same = np.concatenate(([False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])))[:n]
    first = np.maximum.accumulate(np.where(same, 0, np.arange(n))) if n else np.zeros(0, np.int64)
    same &= (left == left[first]) & (right == right[first])
    check = np.flatnonzero(same)
    same[check] = same_bytes(data, (at - left)[check], (at - left)[first[check]], (left + GRAM + right)[check])
    many = np.bincount(first[same], minlength=n)
    met = np.zeros(n, bool)
    firsts = np.flatnonzero(~same)
    met[firsts] = seen.later((h ^ c)[firsts], doc[row[firsts]], pos[firsts], view, (at - left)[firsts], (at + GRAM + right)[firsts], many[firsts] > 0)
    # A repeat of one document at one place is a row of a repeated id: neither covers the other.
    later = met | (same & ((doc[row] != doc[row[first]]) | (pos != pos[first])))
    cr, cs, ce = merged(row[later], (pos - left)[later], (pos + GRAM + right)[later])
    keep = ~later
    h, c, row, pos, left, right = (x[keep] for x in (h, c, row, pos, left, right))
    fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))[: len(h)]
    ids, times = np.unique(h[fresh], return_counts=True)
    hot = ids[times >= HOT]
    is_hot = np.isin(h, hot)
    kind = np.where(is_hot, HOT_FIRST, FIRST)
    v = (pos << 18) | (left << 10) | (right << 2) | kind
    cover = (ce << 2) | COVER
    none, lowest = np.zeros(len(hot), np.int64), np.full(len(hot), np.iinfo(np.int64).min)
    columns = (
        np.concatenate([h ^ np.where(is_hot, c, 0), doc[cr], hot]), np.concatenate([h, cs, hot]), np.concatenate([c, np.zeros_like(cs), lowest]),
        np.concatenate([doc[row], doc[cr], none]), np.concatenate([twin[row], twin[cr], none]), np.concatenate([v, cover, none | MARK]),
    )
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["part", "h", "c", "doc", "twin", "v"])


def _meet(rows: DataFrame) -> DataFrame:
    """Over all blocks: covers (hot null, h 0), and the contexts of anchors that occur again (hot says whether they are hot).

    Columns doc, twin, a, b, h, hot; a cover is [a, b), a context has its anchor at a.
    """
    whole = Window.partitionBy("part", "h")
    order = whole.orderBy("c")
    is_context = F.col("kind").isin(FIRST, HOT_FIRST)
    same = F.col("c") == F.lag("c").over(order)
    df = (
        rows.withColumn("kind", F.col("v").bitwiseAND(F.lit(3)))
        .withColumn("first", is_context & ~F.coalesce(same, F.lit(False)))
        .withColumn("times", F.sum(is_context.cast("int")).over(whole))
        .withColumn("many", F.sum(F.col("first").cast("int")).over(whole))
        .withColumn("marked", F.max((F.col("kind") == MARK).cast("int")).over(whole) == 1)
    )
    hot = (F.col("kind") == HOT_FIRST) | F.col("marked") | (F.col("many") > LARGE)
    cover = F.col("kind") == COVER
    return df.where(cover | (is_context & (hot | (F.col("times") > 1)))).select(
        "doc", "twin", F.when(cover, F.col("h")).otherwise(F.shiftright("v", 18)).alias("a"), F.when(cover, F.shiftright("v", 2)).otherwise(0).cast("long").alias("b"),
        F.when(is_context, F.col("h")).otherwise(0).cast("long").alias("h"), F.when(is_context, hot).alias("hot"),
    )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From doc, twin, text as bytes and its wanted (h, a): h, doc, twin, pos, left and the bytes of each context."""
    for batch in batches:
        data, off = flat_bytes(batch.column(2))
        wanted = batch.column(3)
        row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
        h, pos = (x.to_numpy() for x in wanted.flatten().flatten())
        doc, twin = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for k in range(0, len(row), 10_000):
            r, p = row[k : k + 10_000], pos[k : k + 10_000]
            left = np.minimum(REACH, p)
            start = off[r] + p - left
            size = np.minimum(off[r] + p + GRAM + REACH, off[r + 1]) - start
            ends = np.cumsum(size)
            flat = data[np.repeat(start - ends + size, size) + np.arange(ends[-1])]
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            own = pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (h[k : k + 10_000], doc[r], twin[r], p, left)), own], ["h", "doc", "twin", "pos", "left", "bytes"])


class Suffixes:
    """Contexts of anchors, to be sorted by what follows the anchor; ``group`` is in order, and groups do not mix."""

    def __init__(self, group: np.ndarray, left: np.ndarray, contexts: list[bytes]):
        self.group, self.left, self.contexts = group, left, contexts
        size = np.fromiter(map(len, contexts), np.int64, len(contexts))
        self.data = np.frombuffer(b"".join(contexts) + bytes(8), np.uint8)
        begin = np.cumsum(size) - size
        place = np.zeros(len(self.data) + 1, np.int16)
        place[: len(self.data) - 8] = np.arange(len(self.data) - 8) - np.repeat(begin, size)
        self.hashes = PrefixHashes(self.data, place)
        self.anchor = begin + left
        self.after = self.anchor + GRAM
        self.right = size - left - GRAM
        #: the next eight bytes, where there are as many
        self.head = np.zeros(len(contexts), U)
        for k in range(8):
            self.head = (self.head << U(8)) | self.data[self.after + k].astype(U)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many bytes agree behind the anchors, by binary search over prefix hashes."""
        lo, hi = np.zeros(len(x), np.int64), np.minimum(self.right[x], self.right[y])
        a, b = self.after[x], self.after[y]
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.hashes.of(a, mid) == self.hashes.of(b, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def compare(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as x sorts before, with or behind y."""
        out = np.sign(self.group[x] - self.group[y])
        full = (self.right[x] >= 8) & (self.right[y] >= 8)
        quick = (out == 0) & full & (self.head[x] != self.head[y])
        out[quick] = np.where(self.head[x[quick]] < self.head[y[quick]], -1, 1)
        at = np.flatnonzero((out == 0) & ~quick)
        x, y = x[at], y[at]
        k = self.common(x, y)
        ended = k == np.minimum(self.right[x], self.right[y])
        byte = np.sign(self.data[self.after[x] + k].astype(np.int64) - self.data[self.after[y] + k])
        out[at] = np.where(ended, np.sign(self.right[x] - self.right[y]), byte)
        return out

    def sorted(self) -> np.ndarray:
        """A bottom-up mergesort; every element finds its place in the other run by binary search, all side by side."""
        n = len(self.group)
        order, at, width = np.arange(n), np.arange(n), 1
        # an element's place in another run lies among those of its group: groups lie in order, in every run
        begins, ends = np.searchsorted(self.group, self.group, "left"), np.searchsorted(self.group, self.group, "right")
        while width < n:
            start = at // (2 * width) * (2 * width)
            mid = np.minimum(start + width, n)
            in_left = at < mid
            base, end = np.where(in_left, mid, start), np.where(in_left, np.minimum(start + 2 * width, n), mid)
            lo, hi = np.clip(begins, base, end), np.clip(ends, base, end)
            todo = np.flatnonzero(lo < hi)
            while len(todo):
                m = (lo[todo] + hi[todo]) // 2
                sign = self.compare(order[m], order[todo])
                up = np.where(in_left[todo], sign < 0, sign <= 0)
                lo[todo], hi[todo] = np.where(up, m + 1, lo[todo]), np.where(up, hi[todo], m)
                todo = todo[lo[todo] < hi[todo]]
            fresh = np.empty(n, np.int64)
            fresh[at + (lo - base) - np.where(in_left, 0, mid - start)] = order
            order, width = fresh, 2 * width
        return order

    def checked(self) -> tuple[np.ndarray, np.ndarray]:
        """The order, and the bytes that each suffix shares with the one before it (-1: another group), verified on the bytes."""
        order = self.sorted()
        x, y = order[:-1], order[1:]
        shared = np.where(self.group[x] == self.group[y], self.common(x, y), -1)
        span = np.maximum(shared, 0)
        step = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        alike = (self.data[np.repeat(self.after[x], span) + step] == self.data[np.repeat(self.after[y], span) + step]).all()
        more = (shared < self.right[x]) & (shared < self.right[y]) & (shared >= 0)
        ordered = (self.data[self.after[x[more]] + span[more]] < self.data[self.after[y[more]] + span[more]]).all()
        if not (alike and ordered):  # two strings of one hash: sort the bytes themselves
            tail = [c[k + GRAM :] for c, k in zip(self.contexts, self.left.tolist())]
            order = np.array(sorted(range(len(tail)), key=lambda i: (self.group[i], tail[i])), np.int64)
            pairs = zip(order[:-1].tolist(), order[1:].tolist())
            shared = np.array([_shared(tail[a], tail[b]) if self.group[a] == self.group[b] else -1 for a, b in pairs], np.int64)
        return order, np.concatenate(([-1], shared))


def _shared(a: bytes, b: bytes) -> int:
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def repeated(group: np.ndarray, doc: np.ndarray, pos: np.ndarray, left: np.ndarray, contexts: list[bytes], fresh: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which contexts hold windows that another context of the group has earlier, and the interval these cover.

    All other windows go to ``fresh``: pairs of a reach before the anchor and the contexts whose window it is.
    """
    s = Suffixes(group, left, contexts)
    order, shared = s.checked()
    rank = np.empty(len(doc), np.int64)
    by_place = np.lexsort([pos, doc])
    rank[by_place] = np.arange(len(doc))
    place = rank[order]  # sorted suffixes, as ranks
    to = np.argsort(place)  # rank -> index in the sort
    low, high = np.full(len(doc), REACH + 1), np.full(len(doc), -1)
    seen_low, seen_high = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    for before in range(REACH + 1):
        need = REACH - before
        run = np.cumsum(shared < need)[to]
        i = by_place[(s.left[by_place] >= before) & (s.right[by_place] >= need)]
        if len(i) < 2:
            if fresh is not None:
                fresh.append((before, i))
            continue
        key = s.hashes.of(s.anchor[i] - before, before) * U(INVERSE) + mixed(run[rank[i]].astype(U) + U(1))
        o = np.argsort(key, kind="stable")  # equal windows side by side, the earliest first
        same = np.concatenate(([False], key[o][1:] == key[o][:-1]))
        first = i[o[np.maximum.accumulate(np.where(same, 0, np.arange(len(o))))]]
        mine = i[o]
        hit = same & ((doc[mine] != doc[first]) | (pos[mine] != pos[first]))
        mine, first = mine[hit], first[hit]
        if fresh is not None:  # no window is left out for a hash alone
            sure = (group[mine] == group[first]) & same_bytes(s.data, s.anchor[mine] - before, s.anchor[first] - before, np.full(len(mine), LENGTH))
            mine, first = mine[sure], first[sure]
            fresh.append((before, np.setdiff1d(i, mine)))
        new = low[mine] > before
        low[mine[new]], seen_low[mine[new]] = before, first[new]
        high[mine], seen_high[mine] = before, first
    found = np.flatnonzero(high >= 0)
    for i in found.tolist():
        for b, j in ((low[i], seen_low[i]), (high[i], seen_high[i])):
            a = contexts[i][left[i] - b : left[i] - b + LENGTH]
            if group[i] != group[j] or a != contexts[j][left[j] - b : left[j] - b + LENGTH]:
                low[i], high[i] = _plainly(i, group, doc, pos, left, contexts)
                break
    found = np.flatnonzero(high >= 0)
    return found, pos[found] - high[found], pos[found] + LENGTH - low[found]


def _plainly(i, group, doc, pos, left, contexts) -> tuple[int, int]:
    """The least and greatest reach before the anchor of the windows of context i that are earlier elsewhere; for a hash collision."""
    hits = [
        b for b in range(REACH + 1) if b <= left[i] and len(contexts[i]) - left[i] - GRAM >= REACH - b
        and any(group[j] == group[i] and (doc[j], pos[j]) < (doc[i], pos[i]) and b <= left[j] and contexts[j][left[j] - b : left[j] - b + LENGTH] == contexts[i][left[i] - b : left[i] - b + LENGTH] for j in range(len(doc)))
    ]
    return (min(hits), max(hits)) if hits else (REACH + 1, -1)


SORTED = ["h", "doc", "twin", "pos", "left", "bytes"]


def _distinct(table: pa.Table) -> pa.Table:
    """The earliest row of each context's bytes."""
    least: dict[bytes, tuple[int, int, int]] = {}
    for k, (d, p, b) in enumerate(zip(table["doc"].to_pylist(), table["pos"].to_pylist(), table["bytes"].to_pylist())):
        if b not in least or (d, p) < least[b][:2]:
            least[b] = (d, p, k)
    return table.take(pa.array(sorted(k for _, _, k in least.values()), pa.int64()))


def _sort_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by h: the covers of each group; about CHUNK rows at a time, larger groups in several chunks.

    Of a group that goes on, each chunk leaves the earliest row of every distinct context to the next one: LARGE at most.
    """

    def covers(table: pa.Table) -> pa.RecordBatch:
        h, doc, twin, pos, left = (table.column(k).to_numpy() for k in range(5))
        group = np.cumsum(np.concatenate(([0], h[1:] != h[:-1])))
        found, a, b = repeated(group, doc, pos, left, table.column(5).to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[found], twin[found], a, b)], ["doc", "twin", "a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        for k in range(0, batch.num_rows, CHUNK):
            part = pa.Table.from_batches([batch.slice(k, CHUNK)])
            held = part if held is None else pa.concat_tables([held, part]).combine_chunks()
            if held.num_rows < CHUNK:
                continue
            h = held.column(0).to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # the last group may go on
            if cut:
                yield covers(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
            if held.num_rows >= CHUNK:
                yield covers(held)
                held = _distinct(held)
    if held is not None and held.num_rows:
        yield covers(held)


def _sort_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by h within their partition: the covers of each CHUNK of rows (w null), and each window that is the first one there.

    Columns w (the window's bytes), doc, twin, a, b.
    """
    for batch in batches:
        for k in range(0, batch.num_rows, CHUNK):
            part = batch.slice(k, CHUNK)
            h, doc, twin, pos, left = (part.column(c).to_numpy() for c in range(5))
            fresh: list[tuple[int, np.ndarray]] = []
            found, a, b = repeated(np.cumsum(np.concatenate(([0], h[1:] != h[:-1]))), doc, pos, left, part.column(5).to_pylist(), fresh)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(found), pa.binary()), *(pa.array(x) for x in (doc[found], twin[found], a, b))], ["w", "doc", "twin", "a", "b"])
            data, off = flat_bytes(part.column(5))
            for before, i in fresh:
                flat = np.ascontiguousarray(data[(off[i] + left[i] - before)[:, None] + np.arange(LENGTH)])
                own = pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer((np.arange(len(i) + 1) * LENGTH).astype(np.int32)), pa.py_buffer(flat)])
                start = pos[i] - before
                yield pa.RecordBatch.from_arrays([own, *(pa.array(x) for x in (doc[i], twin[i], start, start + LENGTH))], ["w", "doc", "twin", "a", "b"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From doc_id, text as bytes and its covers: the result rows and the bytes that are left."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        out: list[list] = [[] for _ in kinds]
        held = 0
        for doc, text, covers in zip(*batch.columns):
            data, runs, kept, at = text.as_buffer(), [], [], 0
            for a, b in sorted((c["a"], c["b"]) for c in covers.as_py() or ()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            view = memoryview(data)
            for a, b in runs:
                kept.append(view[at:a])
                at = b
            left = b"".join([*kept, view[at:]])
            for o, x in zip(out, (doc.as_py(), len(view), len(view) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left)):
                o.append(x)
            held += len(left)
            if held > EMIT:
                yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names)
                out, held = [[] for _ in kinds], 0
        yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left) of every row.

    A null text counts as empty. A null doc_id counts as larger than any other. Rows of one doc_id are one document's:
    neither is earlier than the other at the same start, so that a repeated row has the same result as its twin.
    A text shorter than LENGTH loses nothing. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), data.alias("text"))
    twins = materialise(keyed.groupBy("doc").count().where("count > 1").select("doc"), "twins")
    if twins.limit(1).count():
        twin = F.when(F.col("mark").isNotNull(), F.xxhash64("text")).otherwise(0).cast("long")
        keyed = keyed.join(twins.withColumn("mark", F.lit(1)), "doc", "left").select("doc_id", "doc", twin.alias("twin"), "text")
    else:
        keyed = keyed.select("doc_id", "doc", F.lit(0).cast("long").alias("twin"), "text")
    rows = keyed.select("doc", "twin", "text").mapInArrow(_find_anchors, ROWS)
    met = materialise(_meet(rows), "met")

    def fetched(which: Column) -> DataFrame:
        wanted = met.where(which).groupBy("doc", "twin").agg(F.collect_set(F.struct("h", "a")).alias("want"))
        found = keyed.select("doc", "twin", "text").join(wanted, ["doc", "twin"])
        return found.mapInArrow(_contexts, "h long, doc long, twin long, pos long, left long, bytes binary")

    spans = "doc long, twin long, a long, b long"
    sorted_covers = materialise(fetched(~F.col("hot")).repartition(parts, "h").sortWithinPartitions("h").mapInArrow(_sort_contexts, spans), "sorted-covers")
    covers = met.where("hot is null").select("doc", "twin", "a", "b").unionByName(sorted_covers)
    if met.where("hot").limit(1).count():
        found = materialise(fetched(F.col("hot")).sortWithinPartitions("h").mapInArrow(_sort_hot, "w binary, doc long, twin long, a long, b long"), "windows")
        windows = found.where("w is not null").distinct()
        earliest = windows.groupBy("w").agg(F.min(F.struct("doc", "a")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        later = windows.join(earliest, "w").where(F.struct("doc", "a") > F.col("first"))
        covers = covers.unionByName(found.where("w is null").select("doc", "twin", "a", "b")).unionByName(later.select("doc", "twin", "a", "b"))
    per_doc = covers.groupBy("doc", "twin").agg(F.collect_list(F.struct("a", "b")).alias("covers"))
    joined = keyed.join(per_doc, ["doc", "twin"], "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "covers")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without bytes that 100-byte strings repeat."""
    return remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text")).drop("kept")
