"""Alignment of two tokenizers over the same texts, with an identity map as the fast path.

Byte offsets where tokens of A and of B both end cut them into groups. ``identity`` maps each id of A to the id of B with the
same bytes. Links of an id to its identity are counted in vectors as long as A's vocabulary; only the other links, of irregular
groups, enter the shuffle of pairs.

Both tokenizers start anew at a space that follows something other than white space, so texts are cut there into chunks, each
of whole groups. A task cuts its texts, encodes the distinct chunks side by side and remembers them up to a bound. It writes
its texts in blocks: a row a text, with its distinct pairs, and one with those of the block. A block's pairs go through the
shuffle once each, with the number of its documents that hold them, so that no pair has more rows than there are blocks. The
sums come back to the block, and each document's are taken from them, one block at a time.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import materialise, read_table, slices

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text in a block and in a slice of it; chunks that a worker remembers.
BLOCK_BYTES, SLICE_BYTES, REMEMBERED = 8 << 20, 1 << 20, 150_000
#: Bytes of chunks that are encoded in one call.
CALL_BYTES = 200_000
#: Links of a group up to which they are listed one by one.
LISTED = 4_096
MARK = "▁"
CUT = re.compile(r"(?<=\S)(?= )")
TIGHT = re.compile(r"\s(?= )|^ ")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it is printable, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


@dataclass
class Tokenizers:
    """The vocabularies of both as bytes, and the map from A to B; the encoders themselves are loaded where they are used."""

    a_file: str
    b_file: str
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    identity: np.ndarray

    @classmethod
    def load(cls, a_file: str = A_FILE, b_file: str = B_FILE) -> Tokenizers:
        import sentencepiece
        import tokenizers

        a, b = tokenizers.Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
        letter = byte_letters()
        named = {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}
        special = set(a.get_added_tokens_decoder())
        a_bytes = [b"" if i in special or i not in named else bytes(letter[c] for c in named[i]) for i in range(max(named) + 1)]
        ids = range(b.get_piece_size())
        b_bytes = [b"" if b.is_control(i) or b.is_unknown(i) else bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace(MARK, " ").encode() for i in ids]
        # Of a byte and a piece with the same bytes the piece is the identity.
        of = {b_bytes[i]: i for i in sorted(ids, key=lambda i: not b.is_byte(i)) if b_bytes[i]}
        return cls(a_file, b_file, a_bytes, b_bytes, np.array([of.get(t, -1) if t else -1 for t in a_bytes], np.int64))


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[k], start[k] + 1, ..., n[k] of them, for all k in turn."""
    ends = np.cumsum(n)
    return np.repeat(start - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


def _among(x: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are among others, which ascend."""
    return ascending[np.minimum(np.searchsorted(ascending, x), len(ascending) - 1)] == x


class Aligner:
    """Aligns texts, chunk by chunk, remembering chunks and their distinct pairs up to a bound."""

    def __init__(self, both: Tokenizers):
        import sentencepiece
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.both = both
        self.a, self.b = tokenizers.Tokenizer.from_file(both.a_file), sentencepiece.SentencePieceProcessor(model_file=both.b_file)
        self.a.encode_special_tokens = True
        self.b_space = self.b.encode("a ")[len(self.b.encode("a")) :]
        self.said = [f"{i}{sign}" for n, end in ((len(both.a_bytes), "|"), (len(both.b_bytes), ";")) for i in range(n) for sign in ("," + end)]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (both.a_bytes, both.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        #: n_a, n_b, n_groups, n_links and whether the bytes are those of the chunk, of each chunk.
        self.counts = np.zeros((5, 0), np.int64)
        self.pairs, self.times, self.start = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        #: Texts that had each chunk.
        self.seen = np.zeros(0, np.int64)

    def forget_rare(self) -> None:
        """Forgets the chunks that one text at most has had since the last time; all, if that leaves too many."""
        keep = np.flatnonzero(self.seen[: len(self.groups)] > 1)
        if 2 * len(keep) > REMEMBERED:
            self.forget()
            return
        n = self.start[keep + 1] - self.start[keep]
        at = _runs(self.start[keep], n)
        chunks, groups = list(self.number), self.groups
        self.number, self.groups = {chunks[k]: j for j, k in enumerate(keep.tolist())}, [groups[k] for k in keep.tolist()]
        self.counts, self.pairs, self.times = self.counts[:, keep], self.pairs[at], self.times[at]
        self.start, self.seen = np.concatenate(([0], np.cumsum(n))), np.zeros(len(keep), np.int64)

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]] | None:
        """Ids of the chunks (each without its leading space), if both give their bytes and start anew at every chunk.

        Chunks are joined to a text up to one that ends in white space, which is the end of its text.
        """
        texts: list[list[str]] = [[]]
        for c in chunks:
            texts[-1].append(c)
            if not c or c[-1].isspace():
                texts.append([])
        joined = [" ".join(t) for t in texts if t]
        a = np.concatenate([np.array(e.ids, np.int64) for e in self.a.encode_batch_fast([" " + t for t in joined], add_special_tokens=False)])
        # B adds no space to an empty text; that chunk is a text's last space.
        b = np.concatenate([np.array(e if t else self.b_space, np.int64) for t, e in zip(joined, self.b.encode(joined, num_threads=1))])
        sent = [b" " + c.encode() for c in chunks]
        want = b"".join(sent)
        a_bytes, b_bytes = self.both.a_bytes, self.both.b_bytes
        if b"".join([a_bytes[i] for i in a.tolist()]) != want or b"".join([b_bytes[i] for i in b.tolist()]) != want:
            return None
        ends = np.cumsum([len(c) for c in sent])
        return (a, b, sent) if all(_among(ends, np.cumsum(size[ids])).all() for size, ids in ((self.a_size, a), (self.b_size, b))) else None

    def _learn(self, chunks: list[str]) -> None:
        """Adds chunks; where joined ones don't give their bytes, each half is tried on its own."""
        found = None if any(MARK in c for c in chunks) else self._encoded(chunks)
        if found:
            self._add(*found)
        elif len(chunks) > 1:
            half = len(chunks) // 2
            self._learn(chunks[:half])
            self._learn(chunks[half:])
        else:
            self.groups.append("")
            self.counts = np.concatenate([self.counts, np.zeros((5, 1), np.int64)], axis=1)
            self.start = np.append(self.start, self.start[-1])

    def _add(self, a: np.ndarray, b: np.ndarray, sent: list[bytes]) -> None:
        ends = np.cumsum([len(c) for c in sent])
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cut = a_end[_among(a_end, b_end)]
        # Tokens without bytes don't occur here; a token belongs to the first group that ends where it ends or later.
        a_of, b_of = np.searchsorted(cut, a_end), np.searchsorted(cut, b_end)
        n_a, n_b = np.bincount(a_of, minlength=len(cut)), np.bincount(b_of, minlength=len(cut))
        chunk = np.searchsorted(ends, cut)
        many = len(sent)
        counts = [np.bincount(chunk, w, many).astype(np.int64) for w in (n_a, n_b, np.ones(len(cut)), n_a * n_b)]
        self.counts = np.concatenate([self.counts, [*counts, np.ones(many, np.int64)]], axis=1)
        # All links of small groups, those of large ones by distinct ids.
        a_first, b_first = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        small = np.flatnonzero(n_a * n_b <= LISTED)
        tokens = _runs(a_first[small], n_a[small])
        of = np.repeat(small, n_a[small])
        left, right = np.repeat(a[tokens], n_b[of]), b[_runs(b_first[of], n_b[of])]
        parts = [(np.repeat(chunk[of], n_b[of]), left << 32 | right, np.ones(len(left), np.int64))]
        for g in np.flatnonzero(n_a * n_b > LISTED).tolist():
            (x, n), (y, m) = (np.unique(t[s : s + k], return_counts=True) for t, s, k in ((a, a_first[g], n_a[g]), (b, b_first[g], n_b[g])))
            for u, k in zip(x.tolist(), n.tolist()):
                parts.append((np.full(len(y), chunk[g]), u << 32 | y, k * m))
        where, pair, times = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order = np.lexsort((pair, where))
        where, pair, times = where[order], pair[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], (where[1:] != where[:-1]) | (pair[1:] != pair[:-1]))))
        self.pairs = np.concatenate([self.pairs, pair[first]])
        self.times = np.concatenate([self.times, np.add.reduceat(times, first)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.bincount(where[first], minlength=many))])
        # The written form of a token ends in the sign that follows it: , within a side, | after A's side, ; after a group.
        last_a, last_b = (np.concatenate((of[1:] != of[:-1], [True])) for of in (a_of, b_of))
        written = np.concatenate([2 * a + last_a, 2 * (len(self.a_size) + b) + last_b])[np.argsort(np.concatenate([2 * a_of, 2 * b_of + 1]), kind="stable")]
        parts = list(map(self.said.__getitem__, written.tolist()))
        stop = np.cumsum(counts[0] + counts[1]).tolist()
        self.groups += ["".join(parts[s:e]) for s, e in zip([0, *stop], stop)]

    def chunks(self, text: str) -> list[str]:
        """Of a space and the text: the chunks, each without the space in front of it."""
        return [c[1:] for c in CUT.split(" " + text)] if TIGHT.search(text) else text.split(" ")

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """The chunks of each text by number; none of a null or empty text."""
        if len(self.number) > REMEMBERED:
            self.forget_rare()
        known, at, fresh, size = self.number, [], [], 0
        said = []
        for text in texts:
            mine = self.chunks(text) if text else []
            said.append(mine)
            for c in mine:
                if c not in known:
                    known[c] = len(known)
                    fresh.append(c)
        call: list[str] = []
        for c in fresh:
            call.append(c)
            size += len(c)
            if size > CALL_BYTES:
                self._learn(call)
                call, size = [], 0
        if call:
            self._learn(call)
        at = [np.fromiter((known[c] for c in mine), np.int64, len(mine)) for mine in said]
        return at

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """Counts and the digest of each text; row, pair, times: each text's distinct pairs and the links of each."""
        at = self.numbers(texts)
        size = np.array([len(x) for x in at], np.int64)
        row = np.repeat(np.arange(len(at)), size)
        flat = np.concatenate(at) if at else np.zeros(0, np.int64)
        good = np.bincount(row, self.counts[4, flat] == 0, len(at)) == 0
        keep = good[row]
        row, flat = row[keep], flat[keep]
        groups = self.groups
        out: dict = {k: np.bincount(row, self.counts[j, flat], len(at)).astype(np.int64) for j, k in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
        out["groups_sha256"] = [hashlib.sha256("".join([groups[k] for k in x.tolist()])[:-1].encode()).hexdigest() if ok and len(x) else "" for x, ok in zip(at, good)]
        # Distinct chunks of each text, then the distinct pairs of these.
        both, often = np.unique(row * len(self.groups) + flat, return_counts=True)
        row, flat = both // max(1, len(self.groups)), both % max(1, len(self.groups))
        self.seen = np.bincount(flat, minlength=len(self.groups)) + np.pad(self.seen, (0, len(self.groups) - len(self.seen)))
        n = self.start[flat + 1] - self.start[flat]
        where = _runs(self.start[flat], n)
        row, pair, times = np.repeat(row, n), self.pairs[where], self.times[where] * np.repeat(often, n)
        order = np.lexsort((pair, row))
        row, pair, times = row[order], pair[order], times[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(row)), bool), (row[1:] != row[:-1]) | (pair[1:] != pair[:-1]))))
        out |= {"row": row[first], "pair": pair[first], "times": np.add.reduceat(times, first) if len(first) else times}
        return out


_held: dict[tuple[str, str], Aligner] = {}


def _aligner(both: Tokenizers) -> Aligner:
    """This worker's aligner: later tasks of the worker go on with its chunks."""
    key = both.a_file, both.b_file
    if key not in _held:
        _held.clear()
        _held[key] = Aligner(both)
    return _held[key]


#: A row is a document, or stands for a block and has its pairs; no row holds more, so that readers and writers, which hold many rows, stay small.
DOCUMENT = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "slot": "array<int>", "times": "array<long>"}
PAIRS = {"pairs": "array<long>", "documents": "array<long>", "same": "array<int>", "same_documents": "array<long>"}
ARROW = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _rows(number: int, n: int, values: dict) -> pa.RecordBatch:
    """n rows of a block with these values, others null."""
    columns = [values.get(k, pa.nulls(n, ARROW[kind])) for k, kind in (DOCUMENT | PAIRS).items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, number, np.int64)), *columns], ["block", *DOCUMENT, *PAIRS])


def _block(number: int, ids: list, parts: list[dict], identity: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The block's documents and its row of pairs. ``slot`` is a place in ``pairs``, the block's irregular pairs in order, or -1 - a for the identity of id a."""
    names = ("n_a", "n_b", "n_groups", "n_links")
    pair = np.concatenate([p["pair"] for p in parts])
    size = np.concatenate([np.bincount(p["row"], minlength=len(p["n_a"])) for p in parts])  # rows ascend in each part
    a = pair >> 32
    regular = identity[a] == pair & 0xFFFFFFFF
    pairs, place, documents = np.unique(pair[~regular], return_inverse=True, return_counts=True)
    slot = np.empty(len(a), np.int32)
    slot[regular], slot[~regular] = -1 - a[regular], place
    vector = np.bincount(a[regular], minlength=len(identity))
    same = np.flatnonzero(vector)
    ends = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32())
    own = {k: pa.array(np.concatenate([p[k] for p in parts])) for k in names}
    lists = {"slot": pa.ListArray.from_arrays(ends, pa.array(slot)), "times": pa.ListArray.from_arrays(ends, pa.array(np.concatenate([p["times"] for p in parts])))}
    yield _rows(number, len(ids), {"doc_id": pa.array(ids, pa.int64()), **own, "groups_sha256": pa.array([x for p in parts for x in p["groups_sha256"]], pa.string()), **lists})
    of_block = {"pairs": pairs, "documents": documents, "same": same, "same_documents": vector[same]}
    yield _rows(number, 1, {k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, ARROW[PAIRS[k]].value_type)) for k, v in of_block.items()})


def blocks(docs: DataFrame, both: Tokenizers) -> DataFrame:
    """A row for each document: its counts and distinct pairs; and one for each block of texts: its pairs, and in how many of its documents each is."""
    shared = docs.sparkSession.sparkContext.broadcast(both)  # as large as the vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = shared.value
        aligner, number = _aligner(both), TaskContext.get().partitionId() << 32
        ids: list = []
        parts: list[dict] = []
        size = 0
        for part in slices(batches, 1, SLICE_BYTES):
            ids += part.column(0).to_pylist()
            parts.append(aligner.align(part.column(1).to_pylist()))
            size += part.nbytes
            if size > BLOCK_BYTES:
                yield from _block(number, ids, parts, both.identity)
                number, ids, parts, size = number + 1, [], [], 0
        if ids:
            yield from _block(number, ids, parts, both.identity)

    schema = ", ".join(f"{k} {kind}" for k, kind in ({"block": "long"} | DOCUMENT | PAIRS).items())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _vector(rows: DataFrame, key: str, value: str, size: int) -> np.ndarray:
    """The values of rows, one for each id of a vocabulary at most, as a vector."""
    out = np.zeros(size, np.int64)
    for r in rows.collect():
        out[r[key]] = r[value]
    return out


def _summed(docs: pa.Table, found: pa.Table, regular: np.ndarray, best: np.ndarray) -> pa.Table:
    """A block's documents, from its irregular pairs and in how many documents of all each is."""
    pairs, count = (found.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pairs)
    pairs, count = pairs[order], count[order]
    slots, times = (docs.column(c).combine_chunks() for c in ("slot", "times"))
    row = np.repeat(np.arange(docs.num_rows), slots.value_lengths().to_numpy(zero_copy_only=False))
    slot, times = slots.flatten().to_numpy(), times.flatten().to_numpy()
    a = np.where(slot < 0, -1 - slot, pairs[np.maximum(slot, 0)] >> 32 if len(pairs) else 0)
    each = np.where(slot < 0, regular[a], count[np.maximum(slot, 0)] if len(pairs) else 0)
    total, top = np.zeros((2, docs.num_rows), np.int64)
    np.add.at(total, row, times * each)
    np.add.at(top, row, times * (each == best[a]))
    counts = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]).append_column("n_best", pa.array(top)).append_column("count_sum", pa.array(total))
    return counts.append_column("groups_sha256", docs.column("groups_sha256"))


def aligned(docs: DataFrame, both: Tokenizers) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text).

    A null or empty text, and one whose tokens' bytes differ from a space and the text (one that holds U+2581), has no
    tokens: zeros and an empty digest. Every row counts as a document, repeated ones too. An empty table gives an empty
    result. Sums are exact up to 2^63.
    """
    spark, size = docs.sparkSession, len(both.identity)
    own = materialise(blocks(docs, both), "blocks")
    local = own.select("block", F.explode(F.arrays_zip("pairs", "documents")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.documents").alias("n"))
    counts = materialise(local.groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    # Vectors as long as A's vocabulary: documents that hold each identity, and the highest count of each id.
    same = own.select(F.explode(F.arrays_zip("same", "same_documents")).alias("x")).groupBy(F.col("x.same").alias("a")).agg(F.sum("x.same_documents").alias("n"))
    regular = _vector(same, "a", "n", size)
    best = np.maximum(regular, _vector(counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("n")), "a", "n", size))
    found = local.select("block", "pair").join(counts, "pair")
    texts = own.where("pairs is null").select(F.col("block").alias("of"), *DOCUMENT)
    vectors = spark.sparkContext.broadcast((regular, best))

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        return _summed(docs, found, *vectors.value)

    return texts.groupBy("of").cogroup(found.groupBy("block")).applyInArrow(run, RESULT)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Every document's tokens by both tokenizers, how they align, and how usual its links are in all documents."""
    return aligned(read_table(spark, sf_dir, "documents", "doc_id", "text"), Tokenizers.load(a_file, b_file))
