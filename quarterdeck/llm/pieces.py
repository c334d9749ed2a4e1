"""SentencePiece encoding and decoding with a unigram Viterbi search over a double-array trie of pieces.

A text gets a leading space and its spaces become the whitespace marker. The best segmentation maximises the sum of the
pieces' log scores; a character without a piece is unknown and falls back to its UTF-8 bytes. No piece holds a marker
behind another character, so that the search splits exactly into chunks (markers and what follows up to the next one);
the distinct chunks of a block of texts are searched side by side, in numpy. Ties go to the piece that starts first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import read_table, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CHUNK = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: What an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Bytes of a block of texts; chunks that a task remembers; chunk bytes up to which chunks are searched side by side.
BLOCK_BYTES, REMEMBERED, WIDE = 500_000, 100_000, 128


class DoubleArray:
    """Trie over byte strings: the child of s by byte c is base[s] + c + 1 if check there is s; value is -1 or the piece."""

    def __init__(self, words: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for word, number in words.items():
            s = 0
            for c in word:
                if c not in children[s]:
                    children[s][c] = len(children)
                    children.append({})
                    values.append(-1)
                s = children[s][c]
            values[s] = number
        size = 2 * len(children) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = bytearray(size)
        taken[0] = 1
        place, free, queue = {0: 0}, 1, [0]
        for node in queue:
            kids = children[node]
            if not kids:
                continue
            codes = sorted(kids)
            while taken[free]:
                free += 1
            at = max(1, free - codes[0] - 1)
            tries = 0
            while any(taken[at + c + 1] for c in codes):
                at += 1
                tries += 1
                if at + 258 >= size:
                    base, check, value = (np.concatenate([x, np.full(size, fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
                    taken += bytearray(size)
                    size *= 2
            if tries > 64:
                free += 1  # the front is crowded: leave its gaps
            base[place[node]] = at
            for c in codes:
                t = at + c + 1
                taken[t] = 1
                check[t], value[t] = place[node], values[kids[c]]
                place[kids[c]] = t
                queue.append(kids[c])
        pad = np.full(260, -1, np.int32)
        self.base, self.check, self.value = np.concatenate([base, pad * 0]), np.concatenate([check, pad]), np.concatenate([value, pad])


def log_scores(given: np.ndarray, plain: list[int]) -> np.ndarray:
    """Log scores of the plain pieces, 0 for the others: the given ones where they are log probabilities.

    A merge-based vocabulary gives ranks, all of them whole numbers; these take Zipf's law.
    """
    own = given[plain]
    if len(own) and (own == np.round(own)).all():
        return zipf_scores(given, plain)
    out = np.zeros(len(given))
    out[plain] = own
    return out


def zipf_scores(given: np.ndarray, plain: list[int]) -> np.ndarray:
    """Log probabilities of the plain pieces by rank, equal scores by number; 0 for the others."""
    rank = np.empty(len(plain))
    rank[np.argsort(-given[plain], kind="stable")] = np.arange(1, len(plain) + 1)
    out = np.zeros(len(given))
    out[plain] = -np.log(rank) - np.log((1 / rank).sum())
    return out


@dataclass
class PieceModel:
    trie: DoubleArray
    scores: np.ndarray
    texts: list[bytes]
    byte_ids: np.ndarray
    unknown: int
    unknown_score: float
    longest: int

    @classmethod
    def load(cls, path: str = MODEL) -> PieceModel:
        """From a model file, with the log probabilities of a unigram model.

        Files of merge-based vocabularies score a piece by its rank, which is no logarithm; there its log score follows
        Zipf's law: its probability falls as one over its rank, in the same order.
        """
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        texts = [sp.id_to_piece(i).encode() for i in ids]
        scores = log_scores(np.array([sp.get_score(i) for i in ids]), plain)
        words = {texts[i]: i for i in plain}
        byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        for b, i in enumerate(byte_ids):
            texts[i] = bytes([b])
        for i in ids:
            if sp.is_control(i) or sp.is_unknown(i):
                texts[i] = b""
        return cls(DoubleArray(words), scores, texts, byte_ids, sp.unk_id(), float(scores[plain].min()) - UNKNOWN_PENALTY, max(map(len, words)))

    def segment(self, words: list[bytes]) -> list[np.ndarray]:
        """The piece ids of each chunk, byte fallback applied."""
        out: list = [None] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        bound = 0
        for top in (8, 16, 32, 64, WIDE):
            at = np.flatnonzero((size > bound) & (size <= top))
            for k in range(0, len(at), 20_000):
                part = at[k : k + 20_000]
                for j, ids in zip(part.tolist(), self._side_by_side([words[i] for i in part], size[part])):
                    out[j] = ids
            bound = top
        for j in np.flatnonzero(size > WIDE).tolist():
            out[j] = self._alone(words[j])
        return out

    def _side_by_side(self, words: list[bytes], size: np.ndarray) -> list[np.ndarray]:
        n, length = len(words), int(size.max())
        flat = np.frombuffer(b"".join(w.ljust(length, b"\0") for w in words), np.uint8).reshape(n, length)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        back, piece = np.zeros((length + 1, n), np.int32), np.zeros((length + 1, n), np.int32)
        lead = (flat & 0xC0) != 0x80
        wide = np.select([flat < 0x80, flat < 0xE0, flat < 0xF0], [1, 2, 3], 4)
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        for i in range(length):
            rows = np.flatnonzero((size > i) & lead[:, i])
            if not len(rows):
                continue
            one = np.zeros(n, bool)
            state, at = np.zeros(len(rows), np.int32), rows
            for k in range(1, min(self.longest, length - i) + 1):
                t = base[state] + flat[at, i + k - 1] + 1
                ok = (check[t] == state) & (size[at] >= i + k)
                at, state = at[ok], t[ok]
                if not len(at):
                    break
                p = value[state]
                hit = p >= 0
                r, p = at[hit], p[hit]
                one[r[wide[r, i] == k]] = True
                new = best[i, r] + scores[p]
                up = new > best[i + k, r]
                r, p = r[up], p[up]
                best[i + k, r], back[i + k, r], piece[i + k, r] = new[up], k, p
            r = rows[~one[rows]]
            if len(r):
                k = np.minimum(wide[r, i], size[r] - i)
                new = best[i, r] + self.unknown_score
                up = new > best[i + k, r]
                r, k = r[up], k[up]
                best[i + k, r], back[i + k, r], piece[i + k, r] = new[up], k, self.unknown
        ends, marks = size.copy(), []
        rows = np.arange(n)
        while len(rows):
            p, k = piece[ends[rows], rows], back[ends[rows], rows]
            ends[rows] -= k
            marks.append((rows, p, ends[rows].copy(), k))
            rows = rows[ends[rows] > 0]
        row, p, start, k = (np.concatenate([m[x] for m in marks[::-1]]) for x in range(4))
        order = np.argsort(row, kind="stable")
        row, p, start, k = row[order], p[order], start[order], k[order]
        if (p == self.unknown).any():  # one id for each byte
            repeat = np.where(p == self.unknown, k, 1)
            step = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
            row, start, p = np.repeat(row, repeat), np.repeat(start, repeat), np.repeat(p, repeat)
            lost = p == self.unknown
            p[lost] = self.byte_ids[flat[row[lost], start[lost] + step[lost]]]
        return np.split(p.astype(np.int32), np.searchsorted(row, np.arange(1, n)))

    def _alone(self, word: bytes) -> np.ndarray:
        """The same search over one long chunk, byte by byte."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        n = len(word)
        best, back, piece = [-np.inf] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            c = word[i]
            if c & 0xC0 == 0x80:
                continue
            wide, one, here, s = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4, False, best[i], 0
            for j in range(i, min(n, i + self.longest)):
                t = int(base[s]) + word[j] + 1
                if check[t] != s:
                    break
                s, p = t, int(value[t])
                if p >= 0:
                    one = one or j + 1 - i == wide
                    if (new := here + scores[p]) > best[j + 1]:
                        best[j + 1], back[j + 1], piece[j + 1] = new, j + 1 - i, p
            if not one and here + self.unknown_score > best[min(n, i + wide)]:
                e = min(n, i + wide)
                best[e], back[e], piece[e] = here + self.unknown_score, e - i, self.unknown
        ids, e = [], n
        while e:
            s = e - back[e]
            ids += [int(self.byte_ids[b]) for b in reversed(word[s:e])] if piece[e] == self.unknown else [piece[e]]
            e = s
        return np.array(ids[::-1], np.int32)

    def decode(self, ids) -> str:
        """The text of piece ids: bytes joined, markers as spaces, the leading space dropped; bad UTF-8 as U+FFFD."""
        texts = self.texts
        out = b"".join([texts[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return out[1:] if out.startswith(" ") else out


class Encoder:
    """Encodes texts with a model, remembering chunks up to a bound."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; none for a null or empty text."""
        if len(self.number) > REMEMBERED:
            self.forget()
        known, fresh, at = self.number, [], []
        for text in texts:
            mine = []
            for w in CHUNK.findall(MARK + text.replace(" ", MARK)) if text else ():
                k = known.get(w)
                if k is None:
                    k = known[w] = len(known)
                    fresh.append(w)
                mine.append(k)
            at.append(np.array(mine, np.int64))
        if fresh:
            ids = self.model.segment([w.encode("utf-8", "replace") for w in fresh])
            self.flat = np.concatenate([self.flat, *ids])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum([len(x) for x in ids])])
        out = []
        for k in at:
            s, n = self.start[k], self.start[k + 1] - self.start[k]
            ends = np.cumsum(n)
            out.append(self.flat[np.repeat(s - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)])
        return out


def encode(docs: DataFrame, model: PieceModel, text: str = "text", digest_only: bool = False) -> DataFrame:
    """``docs`` with token_ids, n_tokens, n_byte_tokens, ids_sha256, decoded_sha256 and round_trip.

    ``ids_sha256`` is over the ids as little-endian 32-bit integers; ``decoded_sha256`` over the decoded text;
    ``round_trip`` says whether decoding gave the text back, which fails only for texts that hold the marker itself
    or lone surrogates. A null text counts as empty: no tokens. Columns of these names in ``docs`` are replaced.
    With ``digest_only`` only doc_id and the columns other than token_ids are returned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary
    added = [("n_tokens", pa.int64(), "long"), ("n_byte_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string"), ("round_trip", pa.bool_(), "boolean")]
    added = added if digest_only else [("token_ids", pa.list_(pa.int32()), "array<int>"), *added]
    kept = [c for c in docs.columns if c not in {name for name, _, _ in added} and (c == "doc_id" or not digest_only)]
    read = docs.select(*[c for c in dict.fromkeys([*kept, text])])
    at = read.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        encoder, is_byte = Encoder(model), np.zeros(len(model.texts), bool)
        is_byte[model.byte_ids] = True
        for part in slices(batches, at, BLOCK_BYTES):
            texts = part.column(at).to_pylist()
            ids = encoder.encode(texts)
            values = {
                "n_tokens": [len(x) for x in ids], "n_byte_tokens": [int(is_byte[x].sum()) for x in ids],
                "ids_sha256": [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids], "decoded_sha256": [], "round_trip": [],
            }
            for x, t in zip(ids, texts):
                d = model.decode(x.tolist())
                values["decoded_sha256"].append(hashlib.sha256(d.encode()).hexdigest())
                values["round_trip"].append(d == (t or ""))
            if not digest_only:
                offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                values["token_ids"] = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))
            own = [part.column(part.schema.get_field_index(c)) for c in kept]
            new = [v if isinstance(v := values[name], pa.Array) else pa.array(v, kind) for name, kind, _ in added]
            yield pa.RecordBatch.from_arrays([*own, *new], [*kept, *(name for name, _, _ in added)])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema if f.name in kept]
    return read.mapInArrow(run, ", ".join([*fields, *(f"{name} {sql}" for name, _, sql in added)]))


def decode(rows: DataFrame, model: PieceModel, ids: str = "token_ids", out: str = "text") -> DataFrame:
    """The other columns of ``rows`` and ``out``, the text of the ids; null ids give a null text, ids without a piece nothing."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in rows.schema if f.name not in (ids, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = range(len(model.texts))
        for batch in batches:
            texts = [None if x is None else model.decode([i for i in x if i in known]) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            own = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string())], [*(f.name for f in kept), out])

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out}` string"]))


def op2_sentencepiece(spark: SparkSession, sf_dir: str, path: str = MODEL) -> DataFrame:
    """Every document encoded and decoded: its tokens' number and digests, and whether the text came back."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return encode(docs, PieceModel.load(path), digest_only=True)
