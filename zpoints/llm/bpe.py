"""Byte-level BPE by merge replay over the distinct pieces of a chunk of the corpus.

A text is cut into pieces by a pattern; every distinct piece new to the task
becomes one word of a symbol table. An inverted index from pair rank to word
positions is built once, and the ranks are applied in order: each step takes
the lowest rank that occurs anywhere, merges all of its positions at once and
re-ranks only the neighbours it touched. A word only ever sees its own lowest
rank next, so replaying a chunk of the corpus gives what each word alone would
give, and Spark may cut the corpus anywhere.

Texts are encoded some ``chars_at_once`` at a time; a task keeps the ids of pieces it has met, up to
``cache_pieces`` of them, then starts its table again (a bound on memory, not on results).

Defined cases: a null or empty text has no tokens; a piece that is a token by
itself is that token; rows are independent, so repeated rows and null ids are
encoded like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import BINARY, LONG, STRING, schema

NO_RANK = np.int64(1 << 40)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """Tables that follow from the ranks: ids of single bytes, and the rank of every pair of tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte_id < 0).any():
            raise ValueError("the rank file lacks single bytes")
        keys, vals = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    vals.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.vals = np.array(keys, np.int64)[order], np.array(vals, np.int64)[order]
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.vals[at], NO_RANK)


def replay(words: list[bytes], m: Merges) -> list[bytes]:
    """The ids of each non-empty word, as little-endian uint32, by replaying all merges over all words in rank order."""
    if not words:
        return []
    ends = np.cumsum([len(w) for w in words])
    sym = m.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    n = len(sym)
    nxt = np.arange(1, n + 1)
    nxt[ends - 1] = n  # n: no symbol there
    prv = np.arange(-1, n - 1)
    prv[np.concatenate([[0], ends[:-1]])] = -1
    alive = np.ones(n, bool)
    rank = np.full(n, NO_RANK)  # of the pair that starts here
    has = np.flatnonzero(nxt < n)
    rank[has] = m.pair_rank(sym[has], sym[nxt[has]])

    index: dict[int, list[np.ndarray]] = {}  # pair rank -> positions that had it when indexed
    heap: list[int] = []

    def add(at: np.ndarray) -> None:
        at = at[rank[at] < NO_RANK]
        if not len(at):
            return
        at = at[np.argsort(rank[at], kind="stable")]
        r = rank[at]
        cut = np.flatnonzero(np.diff(r)) + 1
        for part in np.split(at, cut):
            k = int(rank[part[0]])
            if k not in index:
                index[k] = []
                heapq.heappush(heap, k)
            index[k].append(part)

    add(has)
    marked = np.zeros(n + 1, bool)
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        at = np.sort(np.concatenate(parts) if len(parts) > 1 else parts[0])
        at = at[alive[at] & (rank[at] == r)]
        if not len(at):
            continue
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        marked[at] = True
        overlaps = marked[nxt[at]].any()
        marked[at] = False
        if overlaps:  # pairs of this rank that share a symbol (as in "aaa"): from the left, each symbol once
            taken, used = [], set()
            for p in at.tolist():
                if p not in used:
                    taken.append(p)
                    used.add(int(nxt[p]))
            at = np.array(taken, np.int64)
        gone = nxt[at]
        after = nxt[gone]
        sym[at], nxt[at] = r, after
        alive[gone] = False
        rank[gone] = NO_RANK
        inner = after < n
        prv[after[inner]] = at[inner]
        rank[at] = NO_RANK
        left = prv[at]
        touched = np.concatenate([at[inner], left[left >= 0]])
        if len(touched):
            rank[touched] = m.pair_rank(sym[touched], sym[nxt[touched]])
            add(touched)
    ids = sym[alive].astype("<u4").tobytes()
    stop = (4 * np.cumsum(alive)[ends - 1]).tolist()
    return [ids[i:j] for i, j in zip([0, *stop], stop)]


#: White space before a space. Elsewhere a piece never crosses the start of a space: pieces hold
#: white space only at their start, or are all white space.
RUN_OF_SPACE = re.compile(r"\s ")


class Encoder:
    """Chunks of text -> ids, with the tables of pieces and chunks met so far in this task.

    A text without runs of white space is cut before every space; no match of
    the pattern crosses such a cut, so each distinct chunk is matched once.
    """

    def __init__(self, merges: Merges, pattern: str, cache_pieces: int):
        import regex

        self.merges, self.find, self.cache_pieces = merges, regex.compile(pattern).findall, cache_pieces
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}  # without the space that they follow

    def _learn(self, cut: list[list[str]]) -> None:
        known, ranks, rest, raw = self.pieces, self.merges.ranks, [], []
        for p in set(chain.from_iterable(cut)).difference(known):
            b = p.encode("utf-8")
            whole = ranks.get(b)
            if whole is not None:
                known[p] = whole.to_bytes(4, "little")
            else:
                rest.append(p)
                raw.append(b)
        known.update(zip(rest, replay(raw, self.merges)))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of every text, as bytes."""
        if len(self.pieces) > self.cache_pieces or len(self.chunks) > self.cache_pieces:
            self.pieces.clear()
            self.chunks.clear()
        split = [[t] if RUN_OF_SPACE.search(t) else t.split(" ") for t in texts]
        fresh = list(set(chain.from_iterable(islice(x, 1, None) for x in split)).difference(self.chunks))
        heads = [x[0] for x in split]
        cut = [self.find(" " + c) for c in fresh]
        head_cut = [self.find(c) for c in heads]
        self._learn(cut)
        self._learn(head_cut)
        ids, chunks = self.pieces.__getitem__, self.chunks
        chunks.update((c, b"".join(map(ids, x))) for c, x in zip(fresh, cut))
        return [b"".join(chain(map(ids, h), map(chunks.__getitem__, islice(x, 1, None))))
                for h, x in zip(head_cut, split)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.merges.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _batches(rank_path: str, pattern: str, cache_pieces: int, chars_at_once: int,
             finish: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        encoder = None
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            encoder = encoder or Encoder(Merges(load_ranks(rank_path)), pattern, cache_pieces)
            at = chars = 0
            for i, t in enumerate(texts):
                chars += len(t)
                if chars >= chars_at_once or i == len(texts) - 1:
                    yield finish(batch.column(0).slice(at, i + 1 - at), encoder.encode_batch(texts[at:i + 1]), encoder)
                    at, chars = i + 1, 0
    return run


def _run(docs: DataFrame, out_schema, finish: Callable, rank_path: str, pattern: str, cache_pieces: int,
         chars_at_once: int) -> DataFrame:
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(_batches(rank_path, pattern, cache_pieces, chars_at_once, finish), out_schema)


def encode(docs: DataFrame, rank_path: str, pattern: str, *, cache_pieces: int = 300_000,
           chars_at_once: int = 4_000_000) -> DataFrame:
    """(doc_id, n_tokens, ids): ids are little-endian unsigned 32-bit integers. No shuffle."""
    def finish(doc_id, ids, encoder):
        return pa.RecordBatch.from_arrays(
            [doc_id, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
            ["doc_id", "n_tokens", "ids"])

    return _run(docs, schema(doc_id=LONG, n_tokens=LONG, ids=BINARY), finish, rank_path, pattern, cache_pieces,
                chars_at_once)


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """(doc_id, decoded): the bytes that the ids stand for."""
    def run(batches):
        tokens = None
        for batch in batches:
            tokens = tokens or Merges(load_ranks(rank_path)).token
            out = [b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                   for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, schema(doc_id=LONG, decoded=BINARY))


def encode_digests(docs: DataFrame, rank_path: str, pattern: str, *, cache_pieces: int = 300_000,
                   chars_at_once: int = 4_000_000) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) in the pass that encodes and decodes, so ids are never written."""
    def finish(doc_id, ids, encoder):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return pa.RecordBatch.from_arrays(
            [doc_id, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(list(map(sha, ids)), pa.string()),
             pa.array([sha(encoder.decode(x)) for x in ids], pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _run(docs, schema(doc_id=LONG, n_tokens=LONG, ids_sha256=STRING, decoded_sha256=STRING), finish,
                rank_path, pattern, cache_pieces, chars_at_once)
