"""Alignment of two tokenizers' tokens by products of sparse incidence matrices.

A text is encoded by both tokenizers, and each gives a token-byte incidence
matrix: row = token, column = byte of the text, 1 where the token covers the
byte. The matrices are kept as compressed sparse rows (``Incidence``) and
multiplied row by row after Gustavson: row i of A * B^T gathers the rows of
B^T at the columns of row i of A and adds up what falls on the same column.
Its entries are the *overlap links*, with the number of bytes shared. Byte
offsets at which tokens of both sides end cut a text into groups; with the
group-token incidence matrices G_A and G_B, the entries of G_A^T * G_B are the
*shared-group links*. Texts are aligned many at a time, as the blocks of one
block-diagonal matrix.

Neither tokenizer has a token across a single space between two other
characters, so every such space starts a group, and a text is the sequence of its *pieces*
between them. A task aligns each distinct piece once; a document's links are
the product of its document-piece counts and the piece-link matrix, and its groups
are those of its pieces in order. Vocabularies that do not allow this cut are aligned by whole texts.

The corpus-wide count of an id pair is the number of documents that hold it linked. Documents
are worked on in chunks of ``chunk_bytes`` text: a chunk lists its distinct
pairs once, with the number of its documents that hold each, counts are summed
over the chunks by a shuffle, and each chunk gets the counts of its own pairs
back by a join. So a pair that occurs in every document meets a shuffle once
per chunk, no task holds all pairs, and nothing but the plan reaches the driver.

Defined cases: texts that are null or empty have no tokens, nor have texts
whose joined token bytes on either side differ from a space and the text
(U+2581 written in a text, for instance, which side B reads as a space); they give zeros, an
empty digest and no links. Strings of special tokens inside a text are plain
text. Rows are independent: repeated rows and rows with a null doc_id count as
documents of their own; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, INT, LONG, STRING, save, schema

TASK_BITS = 36  # numbers of chunks inside one task
DOCUMENT, PAIR = 0, 1
#: A space that both tokenizers join to the characters after it.
# The words of a byte-level tokenizer, and the first character above the Latin letters.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN = "\u0250"
SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


# --------------------------------------------------------------------------- sparse matrices

class Incidence:
    """A sparse matrix as compressed rows: columns ``indices[indptr[i]:indptr[i + 1]]`` of row i, values in ``data`` (all 1 where None)."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, n_cols: int, data: np.ndarray | None = None):
        self.indptr, self.indices, self.n_cols, self.data = indptr, indices, n_cols, data

    @classmethod
    def of_runs(cls, lengths: np.ndarray) -> Incidence:
        """Row i covers the next ``lengths[i]`` columns."""
        indptr = np.concatenate([[0], np.cumsum(lengths)])
        return cls(indptr, np.arange(indptr[-1]), int(indptr[-1]))

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.indptr))

    def transpose(self) -> Incidence:
        """By a counting sort of the entries on their columns."""
        counts = np.bincount(self.indices, minlength=self.n_cols)
        rows = self.row_of_entry()
        ordered = len(self.indices) < 2 or bool((self.indices[1:] >= self.indices[:-1]).all())
        order = slice(None) if ordered else np.argsort(self.indices, kind="stable")
        return Incidence(np.concatenate([[0], np.cumsum(counts)]), rows[order], self.n_rows,
                         None if self.data is None else self.data[order])

    def __matmul__(self, other: Incidence) -> Incidence:
        """Gustavson's product: every entry (i, k) brings row k of ``other`` into row i, equal columns are added up."""
        if self.n_cols != other.n_rows:
            raise ValueError(f"{self.n_cols} columns against {other.n_rows} rows")
        width = np.diff(other.indptr)[self.indices]  # entries that each entry of this matrix brings
        rows = np.repeat(self.row_of_entry(), width)
        skip = np.cumsum(width) - width
        at = np.arange(len(rows)) - np.repeat(skip - other.indptr[self.indices], width)
        key = rows * other.n_cols + other.indices[at]
        value = np.ones(len(key), np.int64)
        if self.data is not None:
            value *= np.repeat(self.data, width)
        if other.data is not None:
            value *= other.data[at]
        if len(key) > 1 and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        data = np.add.reduceat(value, first) if len(first) else value
        key = key[first]
        counts = np.bincount(key // other.n_cols, minlength=self.n_rows) if len(key) else np.zeros(self.n_rows, np.int64)
        return Incidence(np.concatenate([[0], np.cumsum(counts)]), key % other.n_cols if len(key) else key, other.n_cols,
                         data)


# --------------------------------------------------------------------------- tokens

def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 for itself, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of every token."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = _byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode("utf-8")
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode("utf-8") for i in range(self.b.vocab_size())]
        self.a_length = np.array([len(x) for x in self.a_bytes])
        self.b_length = np.array([len(x) for x in self.b_bytes])
        # side A cuts a space off what stands before it, and no piece of B goes on after a word has begun
        model = json.loads(self.a.to_str())
        before = model["pre_tokenizer"] or {}
        self.cut_at_spaces = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not any(
            "▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.vocab_size())))

        # a byte-level vocabulary with every byte and without a normaliser gives back what it is given
        self.a_exact = (before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and model["normalizer"] is None
                        and {bytes([b]) for b in range(256)} <= set(self.a_bytes))

        vocabulary = model["model"]
        ordered = all(vocabulary["vocab"].get("".join(m)) == i + 256 for i, m in enumerate(
            m if isinstance(m, list) else m.split(" ") for m in vocabulary.get("merges", ())))
        self.ranks = None
        if self.a_exact and ordered and before.get("use_regex", True) and vocabulary["type"] == "BPE":
            import tiktoken

            special = {t["id"] for t in model["added_tokens"]}
            self.ranks = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, special_tokens={}, mergeable_ranks={
                token: i for i, token in enumerate(self.a_bytes) if i not in special})._core_bpe

    def pieces(self, text: str) -> list[str]:
        """The text cut at single spaces between other characters, without these spaces."""
        return SINGLE_SPACE.split(text) if self.cut_at_spaces else [text]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of side A. Texts of Latin letters go through a plain merge of ranks where the vocabulary is one
        (merges in the order of their ids), which takes a third of the time and gives the same ids."""
        out = [self.ranks.encode_ordinary(t) if self.ranks and max(t) < LATIN else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.a.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def encode_pieces(self, pieces: list[str], chars_at_once: int = 4000):
        """(pieces in another order, tokens of runs of them, tokens of A and of B that fall to each piece).

        Many pieces are joined by spaces at a time: no token crosses such a space, so the tokens of a joined text are
        those of its pieces in order, and fall to them by the bytes that they cover.
        """
        alone = [p for p in pieces if not self.cut_at_spaces or p[0].isspace() or p[-1].isspace()]
        odd = set(alone)
        rest = [p for p in pieces if p not in odd] if odd else pieces
        latin = [p for p in rest if max(p) < LATIN]
        order, runs, counts = [], [], []
        for kind in (latin, [p for p in rest if max(p) >= LATIN] if len(latin) < len(rest) else []):
            size = np.cumsum([len(p) + 1 for p in kind])
            edges = (np.flatnonzero(np.diff(size // chars_at_once)) + 1).tolist() if kind else []
            blocks = [kind[i:j] for i, j in zip([0, *edges], [*edges, len(kind)]) if i < j]
            joined = [" ".join(block) for block in blocks]
            for block, text, tokens in zip(blocks, joined, self.encode(joined)):
                if not tokens[0]:  # some piece of the block has no tokens
                    alone += block
                    continue
                ends = np.cumsum([len(p) + 1 for p in block] if text.isascii() else [len(p.encode("utf-8")) + 1 for p in block])
                order += block
                runs.append(tokens)
                counts.append([np.diff(np.searchsorted(np.cumsum(length[ids]), ends, side="right"), prepend=0)
                               for length, ids in zip((self.a_length, self.b_length), tokens)])
        single = self.encode(alone)
        counts.append([np.array([len(t[i]) for t in single], np.int64) for i in (0, 1)])
        return [*order, *alone], [*runs, *single], *[np.concatenate([c[i] for c in counts]) for i in (0, 1)]

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """(ids of A, ids of B) of every text; two empty lists where the text has no tokens by definition."""
        out: list[tuple[list[int], list[int]]] = [([], [])] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        ids_a = self.encode_a([" " + texts[i] for i in some])
        ids_b = self.b.encode([texts[i] for i in some], num_threads=1)
        for i, a, b in zip(some, ids_a, ids_b):
            raw = b" " + texts[i].encode("utf-8")
            if b"".join(map(self.b_bytes.__getitem__, b)) == raw and (
                    self.a_exact or b"".join(map(self.a_bytes.__getitem__, a)) == raw):
                out[i] = (a, b)
        return out


class Aligned:
    """Tokens of some texts, their overlap links and their groups, as the blocks of one block-diagonal matrix.

    ``tokens``: (ids of A, ids of B) of runs of texts; ``n_a``, ``n_b``: how many of them fall to each text (a run is
    one text where they are omitted).
    """

    def __init__(self, tokens: list[tuple[list[int], list[int]]], tokenizers: Tokenizers, n_a: np.ndarray | None = None,
                 n_b: np.ndarray | None = None):
        self.n_a = np.array([len(a) for a, _ in tokens], np.int64) if n_a is None else n_a
        self.n_b = np.array([len(b) for _, b in tokens], np.int64) if n_b is None else n_b
        self.a = np.fromiter(chain.from_iterable(a for a, _ in tokens), np.int64, int(self.n_a.sum()))
        self.b = np.fromiter(chain.from_iterable(b for _, b in tokens), np.int64, int(self.n_b.sum()))
        by_byte_a, by_byte_b = (Incidence.of_runs(tokenizers.a_length[self.a]), Incidence.of_runs(tokenizers.b_length[self.b]))
        self.links = by_byte_a @ by_byte_b.transpose()
        end_a, end_b = by_byte_a.indptr[1:], by_byte_b.indptr[1:]
        ends = np.intersect1d(end_a, end_b, assume_unique=True)  # offsets where both sides end
        self.group_a, self.group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        self.in_group_a = Incidence.of_runs(np.bincount(self.group_a, minlength=len(ends)))
        self.in_group_b = Incidence.of_runs(np.bincount(self.group_b, minlength=len(ends)))
        self.stop_a, self.stop_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        self.text_of_a = np.repeat(np.arange(len(self.n_a)), self.n_a)
        last_group = np.where(self.n_a > 0, self.group_a[np.maximum(self.stop_a - 1, 0)] + 1, 0) if len(self.a) else self.n_a
        self.stop_group = np.maximum.accumulate(last_group) if len(last_group) else last_group
        self.n_groups = np.diff(self.stop_group, prepend=0)

    def shared_group_links(self) -> Incidence:
        """A tokens against the B tokens of their group."""
        return self.in_group_a.transpose() @ self.in_group_b

    def group_strings(self, marks: list[list[str]]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for every text; ``marks``: the text of every id followed by a comma, a bar, a semicolon."""
        start_a, start_b = self.in_group_a.indptr, self.in_group_b.indptr
        n = len(self.a) + len(self.b)
        ids, mark = np.empty(n, np.int64), np.zeros(n, np.int64)
        at_a = np.arange(len(self.a)) + start_b[self.group_a]
        at_b = np.arange(len(self.b)) + start_a[self.group_b + 1]
        ids[at_a], ids[at_b] = self.a, self.b
        mark[at_a[start_a[1:] - 1]] = 1
        mark[at_b[start_b[1:] - 1]] = 2
        parts = [marks[m][i] for m, i in zip(mark.tolist(), ids.tolist())]
        stops = (self.stop_a + self.stop_b).tolist()
        return ["".join(parts[i:j])[:-1] for i, j in zip([0, *stops], stops)]


class Pieces:
    """The distinct pieces that a task has met, aligned: their sizes, group strings and links.

    Starts again when it holds ``most_chars`` characters: a bound on memory, not on results.
    """

    def __init__(self, tokenizers: Tokenizers, most_chars: int):
        self.tokenizers, self.most_chars = tokenizers, most_chars
        most = range(max(len(tokenizers.a_bytes), len(tokenizers.b_bytes)))
        self.marks = [[f"{i}{c}" for i in most] for c in ",|;"]
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.chars, self.strings = 0, []
        self.sizes = np.zeros((0, 3), np.int64)  # tokens of A, of B, groups; no tokens: not alignable
        self.stop, self.keys = np.zeros(1, np.int64), np.zeros(0, np.int64)  # rows of links, as a << 32 | b

    def learn(self, fresh: list[str]) -> None:
        fresh, *tokens = self.tokenizers.encode_pieces(fresh)
        x = Aligned(tokens[0], self.tokenizers, *tokens[1:])
        rows = x.links.row_of_entry()
        self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh))))
        self.strings += x.group_strings(self.marks)
        self.sizes = np.concatenate([self.sizes, np.column_stack([x.n_a, x.n_b, x.n_groups])])
        counts = np.bincount(x.text_of_a[rows], minlength=len(fresh))
        self.stop = np.concatenate([self.stop, self.stop[-1] + np.cumsum(counts)])
        self.keys = np.concatenate([self.keys, x.a[rows] << 32 | x.b[x.links.indices]])
        self.chars += sum(map(len, fresh))

    def align(self, texts: list[str | None]):
        """(sizes: tokens of A, of B, groups per text; links as a matrix of texts by distinct pairs with
        how often each is linked; the pairs; group strings)."""
        if self.chars > self.most_chars:
            self.clear()
        cut = [self.tokenizers.pieces(t) if t else [] for t in texts]
        every = list(chain.from_iterable(cut))
        fresh = list(set(every).difference(self.number))
        if fresh:
            self.learn(fresh)
        length = np.array([len(c) for c in cut], np.int64)
        flat = np.fromiter(map(self.number.__getitem__, every), np.int64, len(every))
        strings = list(map(self.strings.__getitem__, flat.tolist()))
        stops = np.cumsum(length).tolist()
        text = np.repeat(np.arange(len(texts)), length)
        fine = np.bincount(text, self.sizes[flat, 0] == 0, minlength=len(texts)) == 0  # one bad piece: no tokens
        keep = fine[text]
        flat, text = flat[keep], text[keep]
        sizes = np.column_stack([np.bincount(text, self.sizes[flat, i], minlength=len(texts)) for i in range(3)]).astype(np.int64)
        # documents by pieces, with counts, times the links of these pieces
        both, times = np.unique(text * max(1, len(self.number)) + flat, return_counts=True)
        here, piece = np.unique(both % max(1, len(self.number)), return_inverse=True)
        documents = Incidence(np.concatenate([[0], np.cumsum(np.bincount(both // max(1, len(self.number)), minlength=len(texts)))]),
                              piece, len(here), times)
        counts = self.stop[here + 1] - self.stop[here]
        stop = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(stop[-1]) + np.repeat(self.stop[here] - stop[:-1], counts)
        pairs, column = np.unique(self.keys[at], return_inverse=True)
        links = documents @ Incidence(stop, column, len(pairs))
        strings = [";".join(strings[i:j]) if ok else "" for i, j, ok in zip([0, *stops], stops, fine)]
        return sizes, links, pairs, strings


def _slices(batches: Iterator[pa.RecordBatch], slice_chars: int):
    """(part, doc ids, texts) of about ``slice_chars`` characters each; a longer text is a slice of its own."""
    for batch in batches:
        part, ids, texts = (batch.column(i).to_pylist() for i in range(3))
        at = chars = 0
        for i, t in enumerate(texts):
            chars += len(t or "")
            if chars >= slice_chars or i == len(texts) - 1:
                yield part[0], ids[at:i + 1], texts[at:i + 1]
                at, chars = i + 1, 0


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.spark_partition_id().cast("long").alias("part"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


# --------------------------------------------------------------------------- links and groups as rows

_INTS = T.ArrayType(INT)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, *, shared_groups: bool = False,
                 slice_chars: int = 500_000) -> DataFrame:
    """One row per document with its tokens, links and groups.

    (doc_id, a_ids, b_ids, link_a, link_b, link_bytes, group_a, group_b):
    ``link_a[i]`` and ``link_b[i]`` are token positions that overlap by
    ``link_bytes[i]`` bytes; ``group_a`` and ``group_b`` give the group number of every
    token. With ``shared_groups`` also shared_a, shared_b: all positions that
    share a group, as many as the product of its sides.
    """
    names = ["a_ids", "b_ids", "link_a", "link_b", "link_bytes", "group_a", "group_b"]
    names += ["shared_a", "shared_b"] if shared_groups else []

    def run(batches):
        both = None
        for _, ids, texts in _slices(batches, slice_chars):
            both = both or Tokenizers(a_path, b_path)
            x = Aligned(both.encode(texts), both)
            start_a, start_b = x.stop_a - x.n_a, x.stop_b - x.n_b
            first_group = x.stop_group - x.n_groups

            def pairs(m: Incidence):
                rows = m.row_of_entry()
                text = x.text_of_a[rows]
                return (np.bincount(text, minlength=len(texts)),
                        [rows - start_a[text], m.indices - start_b[text], m.data])

            def lists(counts, values):
                return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                                pa.array(values, pa.int32()))

            n_links, links = pairs(x.links)
            columns = [lists(x.n_a, x.a), lists(x.n_b, x.b), *[lists(n_links, v) for v in links],
                       lists(x.n_a, x.group_a - np.repeat(first_group, x.n_a)),
                       lists(x.n_b, x.group_b - np.repeat(first_group, x.n_b))]
            if shared_groups:
                n_shared, shared = pairs(x.shared_group_links())
                columns += [lists(n_shared, v) for v in shared[:2]]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], ["doc_id", *names])

    return _input(docs).mapInArrow(run, schema(doc_id=LONG, **dict.fromkeys(names, _INTS)))


# --------------------------------------------------------------------------- corpus counts and digests

_CHUNKED = schema(kind=INT, chunk=LONG, doc_id=LONG, n_a=LONG, n_b=LONG, n_groups=LONG, n_links=LONG, groups_sha256=STRING,
                  numbers=BINARY, times=BINARY, number=INT, a=INT, b=INT, docs=LONG)


def _chunk_run(a_path: str, b_path: str, chunk_chars: int, slice_chars: int, piece_chars: int):
    """Arrow batches (part, doc_id, text) -> rows of kind DOCUMENT and, at the end of each chunk, rows of kind PAIR.

    A document keeps the distinct pairs among its links as numbers within its chunk, with how often each is linked.
    """
    def run(batches):
        known = None
        part = number = chars = n_docs = 0
        rows, links, keys = [], [], []  # of the open chunk: per slice

        def close():
            chunk = part << TASK_BITS | number
            distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
            at, columns, counts = 0, [], []
            for m, k in zip(links, keys):  # columns of a slice -> numbers within the chunk
                columns.append(where[at:at + len(k)][m.indices])
                counts.append(np.diff(m.indptr))
                at += len(k)
            local, counts = np.concatenate(columns).astype("<i4"), np.concatenate(counts)
            times = np.concatenate([m.data for m in links])
            docs = np.bincount(local, minlength=len(distinct))
            stops = np.cumsum(counts)
            n_links = np.diff(np.concatenate([[0], np.cumsum(times)])[np.concatenate([[0], stops])])
            local, times, stops = local.tobytes(), times.astype("<i4").tobytes(), stops.tolist()
            spans = list(zip([0, *stops], stops))
            ids, sizes, shas = [i for r in rows for i in r[0]], np.concatenate([r[1] for r in rows]), [x for r in rows for x in r[2]]
            long = pa.int64()
            yield pa.RecordBatch.from_arrays([
                pa.array([DOCUMENT] * n_docs, pa.int32()), pa.array([chunk] * n_docs, long), pa.array(ids, long),
                *[pa.array(np.ascontiguousarray(sizes[:, i])) for i in range(3)], pa.array(n_links), pa.array(shas, pa.string()),
                pa.array([local[4 * i:4 * j] for i, j in spans], pa.binary()),
                pa.array([times[4 * i:4 * j] for i, j in spans], pa.binary()),
                *[pa.nulls(n_docs, t) for t in (pa.int32(), pa.int32(), pa.int32(), long)]], _CHUNKED.names)
            m = len(distinct)
            if m:
                yield pa.RecordBatch.from_arrays([
                    pa.array([PAIR] * m, pa.int32()), pa.array([chunk] * m, long), *[pa.nulls(m, long)] * 5, pa.nulls(m, pa.string()),
                    pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), pa.array(np.arange(m), pa.int32()),
                    pa.array(distinct >> 32, pa.int32()), pa.array(distinct & 0xFFFFFFFF, pa.int32()),
                    pa.array(docs, long)], _CHUNKED.names)

        for part, ids, texts in _slices(batches, slice_chars):
            known = known or Pieces(Tokenizers(a_path, b_path), piece_chars)
            sizes, matrix, pairs, strings = known.align(texts)
            rows.append((ids, sizes, [hashlib.sha256(s.encode("ascii")).hexdigest() if s else "" for s in strings]))
            links.append(matrix)
            keys.append(pairs)
            n_docs += len(ids)
            chars += sum(len(t or "") for t in texts)
            if chars >= chunk_chars:
                yield from close()
                rows, links, keys, n_docs, chars, number = [], [], [], 0, 0, number + 1
        if n_docs:
            yield from close()
    return run


def _digest(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one chunk and the corpus-wide counts of its pairs -> n_best and count_sum."""
    n = counts.num_rows
    count, best = np.zeros(n, np.int64), np.zeros(n, bool)
    at = counts["number"].to_numpy()
    count[at], best[at] = counts["count"].to_numpy(), counts["best"].to_numpy()
    n_best, count_sum = [], []
    for numbers, times in zip(documents["numbers"].to_pylist(), documents["times"].to_pylist()):
        i, t = np.frombuffer(numbers, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
        n_best.append(int(t[best[i]].sum()))
        count_sum.append(int((t * count[i]).sum()))
    out = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
    return out.append_column("groups_sha256", documents["groups_sha256"])


def pair_counts(chunked: DataFrame) -> DataFrame:
    """(a, b, count, best): documents that hold the pair linked, and whether no other b of this a has more.

    A window over one a holds at most the other vocabulary's size of rows.
    """
    counts = (chunked.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("docs").alias("count")))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def alignment_digests(docs: DataFrame, a_path: str, b_path: str, *, chunk_chars: int = 8_000_000,
                      slice_chars: int = 500_000, piece_chars: int = 8_000_000) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``."""
    chunked = save(_input(docs).mapInArrow(_chunk_run(a_path, b_path, chunk_chars, slice_chars, piece_chars), _CHUNKED), "align-chunks")
    counts = (chunked.where(F.col("kind") == PAIR).select("chunk", "number", "a", "b")
              .join(pair_counts(chunked), ["a", "b"]).select("chunk", "number", "count", "best"))
    documents = chunked.where(F.col("kind") == DOCUMENT).select(
        F.col("chunk").alias("of"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "numbers", "times")
    out = schema(doc_id=LONG, n_a=LONG, n_b=LONG, n_groups=LONG, n_links=LONG, n_best=LONG, count_sum=LONG,
                 groups_sha256=STRING)
    return documents.groupBy("of").cogroup(counts.groupBy("chunk")).applyInArrow(_digest, out)
