"""Encoding of a whole corpus with a public byte-level BPE tokenizer, in numpy.

Every batch is cut into pieces by the tokenizer's pattern; its distinct pieces become rows of padded matrices,
bucketed by length. In each round every row merges its leftmost pair of minimum rank, found by hashed pair lookup,
and all rows get one column narrower; rows with nothing left to merge leave the matrix (compaction). Pieces
longer than ``WIDEST`` bytes, for which a matrix round costs too much, are merged by a heap, to the same result.

The step is narrow: no shuffle, no broadcast beyond the tokenizer's own table, which each worker reads from a
file named by a parameter. Defined results: null and empty texts give an empty list; a special token's string in
a text is ordinary text; unpaired surrogates cannot occur in Parquet strings; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Where the public tokenizers lie unless a caller says otherwise.
TOKENIZERS = "/opt/tokenizers"
RANK_FILE = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts text into pieces for this tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces of up to so many bytes go through the matrices.
WIDEST = 256
#: Pieces remembered by a worker between batches, and cells of one matrix.
REMEMBERED, CELLS = 300_000, 4_000_000
NONE = np.int64(1) << 40


class PairTable:
    """Open-addressing hash table from a pair of token ids to the id, and rank, of what they merge to."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 2.5))))
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int64)
        keys = self._key(left, right)
        waiting, at = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[at[waiting]] < 0
            self.keys[at[waiting[free]]] = keys[waiting[free]]
            placed = self.keys[at[waiting]] == keys[waiting]
            self.values[at[waiting[placed]]] = merged[waiting[placed]]
            waiting = waiting[~placed]
            at[waiting] = (at[waiting] + 1) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 20) | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, NONE where there is none or one side is padding (negative)."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(left.shape, NONE, dtype=np.int64)
        there = np.flatnonzero((left >= 0) & (right >= 0))
        keys = self._key(left[there], right[there])
        at = self._slot(keys)
        while len(there):
            held = self.keys[at]
            hit = held == keys
            out[there[hit]] = self.values[at[hit]]
            on = ~hit & (held >= 0)
            there, keys, at = there[on], keys[on], (at[on] + 1) & self.mask
        return out.reshape(shape)


class Tokenizer:
    """Byte-level BPE given by a file of ranks."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        triples = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        left, right, merged = (np.array(x, dtype=np.int64) for x in zip(*triples))
        self.pairs = PairTable(left, right, merged)
        self.merges = {(a, b): c for a, b, c in triples}
        self.byte_ids = np.array([self.ranks[bytes([x])] for x in range(256)], dtype=np.int64)
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, np.ndarray] = {}

    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Token ids of pieces of at most ``width`` bytes."""
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        tokens = np.full((len(pieces), width), -1, dtype=np.int64)
        lengths = np.array([len(p) for p in pieces])
        flat = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        tokens[np.arange(width) < lengths[:, None]] = flat
        rows = np.arange(len(pieces))
        ranks = np.full(tokens.shape, NONE, dtype=np.int64)
        ranks[:, :-1] = self.pairs.find(tokens[:, :-1], tokens[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            n = np.arange(len(rows))
            best = ranks[n, at]
            done = best == NONE
            if done.any():
                for i in np.flatnonzero(done):
                    out[rows[i]] = tokens[i][tokens[i] >= 0]
                tokens, ranks, rows, at, best = tokens[~done], ranks[~done], rows[~done], at[~done], best[~done]
                n = np.arange(len(rows))
                if not len(rows):
                    break
            tokens[n, at] = best
            keep = np.ones(tokens.shape, dtype=bool)
            keep[n, at + 1] = False
            width = tokens.shape[1] - 1
            tokens = tokens[keep].reshape(len(rows), width)
            ranks = ranks[keep].reshape(len(rows), width)
            after = np.where(at + 1 < width, tokens[n, np.minimum(at + 1, width - 1)], -1)
            ranks[n, at] = self.pairs.find(best, after)
            before = at > 0
            ranks[n[before], at[before] - 1] = self.pairs.find(tokens[n[before], at[before] - 1], best[before])
        return out

    def _heap(self, piece: bytes) -> np.ndarray:
        """Token ids of one long piece: the same merges, leftmost of minimum rank first, in n log n steps."""
        ids: list[int] = [int(x) for x in self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = [(self.merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heapq.heapify(queue)
        while queue:
            rank, i, pair = heapq.heappop(queue)
            j = after[i]
            if ids[i] != pair[0] or j >= len(ids) or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (ids[a], ids[b]) in self.merges:
                    heapq.heappush(queue, (self.merges[ids[a], ids[b]], a, (ids[a], ids[b])))
        return np.array([x for x in ids if x >= 0], dtype=np.int64)

    def pieces(self, pieces: list[str]) -> None:
        """Encode the pieces not yet known."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            raw = p.encode("utf-8", "surrogatepass")
            if raw in self.ranks:
                self.known[p] = np.array([self.ranks[raw]], dtype=np.int64)
            elif len(raw) > WIDEST:
                self.known[p] = self._heap(raw)
            else:
                buckets.setdefault(1 << (len(raw) - 1).bit_length(), []).append((p, raw))
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for k in range(0, len(members), step):
                part = members[k : k + step]
                for (p, _), ids in zip(part, self._matrix([raw for _, raw in part], width)):
                    self.known[p] = ids

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of all texts."""
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = {p for pieces in cut for p in pieces if p not in self.known}
        self.pieces(list(new))
        parts = [self.known[p] for pieces in cut for p in pieces]
        sizes = np.fromiter((len(x) for x in parts), dtype=np.int64, count=len(parts))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        counts = np.concatenate([[0], np.cumsum([len(pieces) for pieces in cut])]).astype(np.int64)
        return ends[counts].astype(np.int32), (np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)).astype(np.int32)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer per worker and file."""
    return Tokenizer(path)


def _batches(table: pa.Table, text_bytes: int = 8_000_000) -> Iterator[pa.Table]:
    """Slices of a batch that hold about ``text_bytes`` of text each."""
    sizes = np.array([len(x) if x else 0 for x in table.column("text").to_pylist()])
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > text_bytes:
            yield table.slice(start, i - start)
            start, held = i, 0
        held += n
    yield table.slice(start)


def encode(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text)."""
    path = f"{folder}/{RANK_FILE}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _batches(pa.Table.from_batches([batch])):
                offsets, ids = tokenizer(path).encode_batch(part.column("text").to_pylist())
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield from pa.table({"doc_id": part.column("doc_id"), "ids": column}).to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(docs: DataFrame, *keep: str, folder: str = TOKENIZERS) -> DataFrame:
    """The columns ``keep`` and n_tokens of every row, without the ids."""
    path = f"{folder}/{RANK_FILE}"
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _batches(pa.Table.from_batches([batch])):
                offsets, _ = tokenizer(path).encode_batch(part.column("text").to_pylist())
                yield from part.select(list(keep)).append_column("n_tokens", pa.array(np.diff(offsets).astype(np.int64))).to_batches()

    return docs.select(*keep, "text").mapInArrow(run, f"{schema}, n_tokens long")
